"""Exact duplicates by skew-safe combining, in DataFrame operations only.

Three steps: (1) every task combines its own copies (partial aggregation), (2) copies of a digest
meet in one of ``salts`` groups, (3) the few salt winners of a digest meet. In each, rows are one
group only if digest and whole normalised text agree, so a digest collision cannot merge texts.
A group's rows are never gathered: a winner and a count are all that moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.textcols import free_name, without_white

_MAX = "9223372036854775807"
#: Above any (max long - id + 1), so that the id never reaches the digits of the length.
_STEP = "20000000000000000000"


def _rank(n: Column, doc_id: Column) -> Column:
    """Larger for more code points, then for the smaller id: one fixed-width number, so that hash aggregation applies."""
    step = F.lit(_STEP).cast("decimal(38,0)")
    back = F.lit(_MAX).cast("decimal(38,0)") - doc_id.cast("decimal(38,0)") + 1  # 1 to 2^64; 0 stands for no id
    back = F.coalesce(back, F.lit(0))
    return (n.cast("decimal(10,0)").cast("decimal(38,0)") * step + back).cast("decimal(38,0)")


def _rank_id(rank: Column) -> Column:
    back = rank % F.lit(_STEP).cast("decimal(38,0)")
    return F.when(back > 0, (F.lit(_MAX).cast("decimal(38,0)") - back + 1).cast("long"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).alias("n"),
        without_white(text).alias("body"),
        *more,
    )
    return rows.withColumn("digest", F.unhex(F.sha2("body", 256))).withColumn("check", F.xxhash64("body"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. Of equal texts the row with the most code
    points in its original text stays, then the one with the smallest id.

    Null texts count as empty, and all empty texts are one group. A null id loses every tie
    against a number; a group of null ids only has a null keep_id and its rows count as kept.
    Repeated rows (same id, equal text) count in group_size and share the decision, so both are
    kept or neither. Other columns are not read, so their names cannot clash. Empty in, empty out.
    """
    rows = _keyed(docs, id_col, text_col)
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "body", "salt")
        .agg(F.max(_rank(F.col("n"), F.col("doc_id"))).alias("rank"), F.count(F.lit(1)).alias("copies"))
    )
    groups = (
        salted.groupBy("digest", "body")
        .agg(F.max("rank").alias("rank"), F.sum("copies").alias("group_size"))
        .select("digest", F.xxhash64("body").alias("check"), _rank_id(F.col("rank")).alias("keep_id"), "group_size")
    )
    # The text itself need not move a third time: 256 + 64 bits name the group found above. Splitting
    # a hot digest's rows is left to adaptive skew handling of this plain join.
    return (
        rows.drop("body", "n")
        .join(groups, ["digest", "check"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_duplicates``.

    Rows go by id and text, so another text under the same (or no) id stays.
    """
    gone = exact_duplicates(docs, id_col, text_col).filter(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("text_sha256").alias("__gone_text")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(gone["__gone_id"]) & (F.sha2(without_white(docs[text_col]), 256) == gone["__gone_text"])
    return docs.join(gone, same, "left_anti")


def keep_one_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """``docs`` with one row of each group of equal texts, with all its columns.

    The row with the most code points stays, then the one with the smallest id, null last; of rows
    that agree in these any one stays, but only one, whether they share an id or have none. Rows go
    by a key made once in a table in the shared folder. Groups are found as in ``exact_duplicates``.
    """
    row = free_name("row", docs.columns)
    keyed = scratch.written(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-rows")
    rank = _rank(F.col("n"), F.col("doc_id"))
    salted = (
        _keyed(keyed, id_col, text_col, F.col(row).alias("row"))
        .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "body", "salt")
        .agg(F.max(rank).alias("rank"), F.max_by("row", rank).alias("row"))
    )
    stay = salted.groupBy("digest", "body").agg(F.max_by("row", "rank").alias(row)).select(row)
    return keyed.join(stay, row, "left_semi").select(*[keyed[c] for c in docs.columns])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS kept,
       h AS text_sha256
FROM d
"""
