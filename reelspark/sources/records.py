"""JSON lines, JSON documents and shot lists as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.texts import strict_json, strip
from reelspark.operators.resume import last_per_key

#: Fixed value: the last line of a finished shot list.
COMPLETE = "# COMPLETE"


def whole_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, text of every file."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """``texts`` with line_no (from 0) and line instead of the text."""
    rest = [c for c in texts.columns if c != text]
    return texts.select(*rest, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))


def latest_records(rows: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Of rows (line_no, line and more): the JSON objects, and of each key the last. Blank and malformed lines go."""
    is_object = strip(F.col("line")).startswith("{") & strict_json(F.col("line")).isNotNull()
    parsed = rows.filter(is_object).withColumn("r", F.from_json("line", schema)).drop("line")
    flat = parsed.select(*[c for c in parsed.columns if c != "r"], "r.*")
    return last_per_key(flat, keys, "line_no")


def strict_records(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines of which none may be malformed; repeats stay."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def tolerant_documents(texts: DataFrame) -> DataFrame:
    """``texts`` with ``doc``: the file's JSON as VARIANT, null if it is none."""
    return texts.withColumn("doc", strict_json(F.col("text")))


def shots(rows: DataFrame, key: str) -> DataFrame:
    """key, scene_no, start_frame, end_frame from the lines of shot lists; comments and other lines are passed over."""
    parts = F.split(F.trim("line"), r"\s+")
    kept = rows.filter(~F.trim("line").startswith("#")).select(
        key, "line_no", F.try_element_at(parts, F.lit(1)).try_cast("long").alias("start_frame"), F.try_element_at(parts, F.lit(2)).try_cast("long").alias("end_frame")
    )
    return kept.filter("start_frame IS NOT NULL AND end_frame IS NOT NULL")


def shot_lines(found: DataFrame, key: str) -> DataFrame:
    """key, line_no, line: a line of a shot list for each shot (key, start_frame, end_frame), in the order of their starts; ``shots`` reads it."""
    return found.select(key, F.col("start_frame").cast("long").alias("line_no"), F.concat_ws(" ", "start_frame", "end_frame").alias("line"))


def end_marks(finished: DataFrame, key: str) -> DataFrame:
    """The line that ends the shot list of each ``key``, once, after all others; ``is_complete`` reads it."""
    return finished.select(key).distinct().select(key, F.lit(2**63 - 1).cast("long").alias("line_no"), F.lit(COMPLETE).alias("line"))


def is_complete(rows: DataFrame, key: str) -> DataFrame:
    """key, complete: whether the last line that is not blank is the end mark."""
    return rows.filter(F.trim("line") != "").groupBy(key).agg((F.max_by(F.trim("line"), "line_no") == COMPLETE).alias("complete"))


def screened(record: Column, value: str, error: str) -> Column:
    """Whether a screening of a VARIANT record is done: a value that is not null, or an error entry."""
    return F.coalesce(F.try_variant_get(record, f"$.{value}", "boolean").isNotNull() | F.try_variant_get(record, f"$.{error}", "string").isNotNull(), F.lit(False))


def missing_key(record: Column, key: str) -> Column:
    """Whether a VARIANT object has no such key at all; a key with null is there."""
    return F.try_variant_get(record, f"$.{key}", "variant").isNull()


def lenient_valid(record: Column) -> Column:
    """A person, and no text: null has_text counts as none, a missing one as text."""
    person = F.coalesce(F.try_variant_get(record, "$.has_person", "boolean"), F.lit(False))
    text = F.coalesce(F.try_variant_get(record, "$.has_text", "boolean"), F.lit(False))
    return person & ~text & ~missing_key(record, "has_text")


def with_defaults(record: Column, defaults: dict[str, Column]) -> Column:
    """Struct of VARIANT fields with a default (VARIANT) for each that ``record`` has no key for; a null stays null."""
    return F.struct(*[F.when(missing_key(record, k), v).otherwise(F.try_variant_get(record, f"$.{k}", "variant")).alias(k) for k, v in defaults.items()])
