"""Mixing sources to target weights by capped water-filling, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.textcols import n_words

#: Hash ranges per source; sums over them are combined before documents are ranked inside one.
HASH_RANGES = 4096


def water_fill(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Targets for ``sizes`` (source, weight, source_size): adds ``target``.

    Sources share the sum of all sizes by weight; a source is clamped at ``max_epochs`` times its
    size and the excess goes to the others by weight, until none is above. Clamping in order of
    cap/weight reaches that fixed point: with the first k clamped, the level is
    (total - caps) / (weights left), and the next source is clamped as long as its cap is below its
    share at that level. Sums are of whole numbers, so the result does not depend on row order.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    out = sizes.withColumn("cap", F.col("source_size") * F.lit(max_epochs))
    out = (
        out.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("clamped", F.col("cap") * F.col("left_weight") <= F.col("weight") * F.col("left"))
    )
    # The first source that is not clamped sets the level; all after it take their share of it.
    first_open = Window.partitionBy().orderBy(F.col("left_weight").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    open_left = F.first(F.when(~F.col("clamped"), F.col("left")), ignorenulls=True).over(first_open)
    open_weight = F.first(F.when(~F.col("clamped"), F.col("left_weight")), ignorenulls=True).over(first_open)
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
        F.col("weight").cast("double") * open_left.cast("double") / open_weight.cast("double")
    )
    return out.withColumn("target", target).select("source", "weight", "source_size", "target")


#: Copies of a row that are written out together.
COPIES = 65_536


def _decided(docs: DataFrame, weights: Sequence[int], max_epochs: int, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """source, doc_id, size, copies, source_size, target, whole, more: rows that agree in the first three, and how often they are taken.

    Each is taken ``whole`` times, and ``more`` of the copies once more.
    """
    rows = scratch.written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(nth, F.lit(len(weights))) + 1).cast("int"))
    targets = water_fill(sizes.withColumn("weight", pick.cast("long")), max_epochs)

    # Repeated rows become one before any are ranked, so an id that very many rows share, or none, fills no window.
    groups = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    key = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    hashed = groups.withColumn("key", key).withColumn("range", F.substring("key", 1, len(f"{HASH_RANGES - 1:x}")))
    words = F.col("size") * F.col("copies")
    ranges = hashed.groupBy("source", "range").agg(F.sum(words).alias("range_size"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    targets = targets.select(F.col("source").alias("own_source"), "source_size", "target")
    ranges = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(upto), F.lit(0))).join(targets, F.col("source").eqNullSafe(F.col("own_source")))
    ranges = ranges.select("own_source", F.col("range").alias("own_range"), "range_start", "source_size", "target")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.floor(F.col("target") / F.col("source_size"))
    budget = F.col("target") - whole * F.col("source_size")
    placed = hashed.join(ranges, F.col("source").eqNullSafe(F.col("own_source")) & (F.col("range") == F.col("own_range")))
    placed = placed.withColumn("start", F.col("range_start") + F.coalesce(F.sum(words).over(inside), F.lit(0)))
    # Copy k (from 0) begins k sizes after the first; its middle word lies inside the budget if 2 (start + k size) + size < 2 budget.
    first = (2 * F.col("start") + F.col("size")).cast("double")
    fitting = F.ceil((2 * budget - first) / (2 * F.col("size")).cast("double"))
    more = F.when(~(first < 2 * budget), F.lit(0)).when((F.col("copies") == 1) | (F.col("size") == 0), F.col("copies"))
    more = more.otherwise(F.least(F.col("copies"), F.greatest(F.lit(1), fitting)))
    some = F.col("source_size") > 0
    return placed.select(
        "source", "doc_id", "size", "copies", "source_size", "target",
        F.when(some, whole).otherwise(F.lit(0)).cast("long").alias("whole"), F.when(some, more).otherwise(F.lit(0)).cast("long").alias("more"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix-1",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, repeats.

    Sources in code point order, null last, take ``weights`` in turn. A source whose target is r
    times its size takes every document floor(r) times; the fraction left is a budget of words,
    spent on documents in the order of a seeded hash: a document is taken once more if its middle
    word lies inside the budget, so a source misses its target by at most half a document.
    Ranks inside a source come from sums over hash ranges, so no task ranks a whole source.

    Null texts have size 0 and take nothing; a null source is a source of its own, an empty one
    another. Equal ids order by size; repeated rows count as documents of their own and are
    written out from their number, ``COPIES`` at a time. A source
    without words has target 0. Other columns are not read. Empty in, empty out.
    """
    found = _decided(docs, weights, max_epochs, seed, id_col, text_col, source_col)
    bundle = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("bundle")
    bundles = found.select("*", bundle)
    copy = F.explode(F.sequence(F.col("bundle"), F.least(F.col("copies"), F.col("bundle") + COPIES) - 1)).alias("copy")
    repeats = F.col("whole") + (F.col("copy") < F.col("more")).cast("long")
    rows = bundles.select("*", copy).withColumn("repeats", repeats)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"), "repeats")


def repeat_by_mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix-1",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with every row as often as ``mix`` takes it, columns unchanged; rows taken 0 times go.

    Of several rows that agree in id, size and source the ones taken once more are those whose texts
    hash below the share; equal texts among them share one decision.
    """
    found = _decided(docs, weights, max_epochs, seed, id_col, text_col, source_col).filter("whole + more > 0")
    found = found.select(*[F.col(c).alias(f"__mix_{c}") for c in ("source", "doc_id", "size", "copies", "whole", "more")])
    same = (
        docs[id_col].cast("long").eqNullSafe(found["__mix_doc_id"])
        & docs[source_col].cast("string").eqNullSafe(found["__mix_source"])
        & (n_words(docs[text_col]) == found["__mix_size"])
    )
    hashed = F.xxhash64(docs[text_col].cast("string"), F.lit(seed)).cast("double")
    below = hashed < F.col("__mix_more") / F.col("__mix_copies") * F.lit(2.0**64) - F.lit(2.0**63)
    repeats = F.col("__mix_whole") + ((F.col("__mix_more") == F.col("__mix_copies")) | below).cast("long")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_repeats"))).alias("__mix_time")
    taken = docs.join(found, same).withColumn("__mix_repeats", repeats).filter("__mix_repeats > 0")
    return taken.select(*[docs[c] for c in docs.columns], times).drop("__mix_time")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1/' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) AS BIGINT) AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, CAST(3 * source_size AS BIGINT) AS cap,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS BIGINT) AS rest,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS BIGINT) AS rest_weight
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT rest, rest_weight FROM c WHERE NOT (cap * rest_weight <= weight * rest) ORDER BY rest_weight DESC LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN cap * rest_weight <= weight * rest THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight AS DOUBLE) * CAST((SELECT rest FROM o) AS DOUBLE) / CAST((SELECT rest_weight FROM o) AS DOUBLE) END AS target
  FROM c),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN
           CAST(floor(target / source_size) AS BIGINT)
           + CASE WHEN CAST(2 * start + size AS DOUBLE) < 2 * (target - floor(target / source_size) * source_size) THEN 1 ELSE 0 END
         ELSE 0 END AS repeats
  FROM p)
SELECT doc_id, size, source_size, target, CAST(repeats * size AS BIGINT) AS taken, CAST(repeats AS BIGINT) AS repeats FROM r
"""
