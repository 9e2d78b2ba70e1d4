"""Queries that run models from outside: small functions stand for the networks, whole tables for the media."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.functions import texts as tx
from reelspark.plans.registry import query, table
from reelspark.sources import annotators, records


def _model(item):
    """What loads a model that works on one item: it fails on a batch if any item of it fails."""
    return lambda: lambda items: [item(x) for x in items]


def _areas(n: int) -> list[float]:
    return [float(n % 7 * 100 + k) for k in range(n % 4)]


def _answer(prompt: str) -> str:
    if prompt.endswith("7"):
        raise RuntimeError("out of memory")
    n = int(prompt.rsplit(" ", 1)[1])
    return ("```json\n{\"characters\": %d}\n```" if n % 2 else "Assistant: {\"characters\": %d} there you go") % (n % 10)


def _profile(path: str) -> str:
    if "/3" in path:
        raise ValueError("no audio track")
    return '{"noise": "low", "speakers": %d}' % len(path)


@query("SELECT event_id, event_type AS kind, value FROM events")
def strict_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events written as JSON lines and read by the reader that takes no malformed line."""
    path = scratch.app_dir(spark) + "/" + scratch.unique("lines")
    table(spark, d, "events").select("event_id", F.col("event_type").alias("kind"), "value").write.json(path)
    return records.strict_records(spark, path, "event_id long, kind string, value double")


@query("""SELECT doc_id, n_chars % 4 AS boxes, CASE WHEN n_chars % 4 > 0 THEN (n_chars % 7) * 100.0::DOUBLE + n_chars % 4 - 1 END AS largest FROM documents""")
def ocr_surface(spark: SparkSession, d: str) -> DataFrame:
    """Areas of text boxes that a detector finds on each picture, how many and the largest."""
    found = annotators.register_annotator("text_boxes", _model(_areas), "array<double>")(F.col("n_chars"))["value"]
    return table(spark, d, "documents").select("doc_id", found.alias("b")).select("doc_id", F.size("b").cast("long").alias("boxes"), F.array_max("b").alias("largest"))


@query("SELECT source, count(*) FILTER (n_chars % 3 = 0) AS with_person, count(*) AS pictures FROM documents GROUP BY source")
def person_surface(spark: SparkSession, d: str) -> DataFrame:
    """Pictures with a person, by film, as a detector says."""
    found = annotators.register_annotator("person", _model(lambda n: n % 3 == 0), "boolean")(F.col("n_chars"))["value"]
    rows = table(spark, d, "documents").select("source", found.alias("person"))
    return rows.groupBy("source").agg(F.count_if("person").alias("with_person"), F.count(F.lit(1)).alias("pictures"))


@query("""SELECT doc_id, CASE WHEN n_chars % 10 = 7 THEN NULL ELSE n_chars % 10 END AS characters, CASE WHEN n_chars % 10 = 7 THEN 'RuntimeError: out of memory' END AS error FROM documents""")
def vlm_surface(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a model to prompts, as JSON in two forms: read where there are some, an error where the model failed on that item alone."""
    said = annotators.register_annotator("answers", _model(_answer), "string")(F.concat(F.lit("How many characters? "), F.col("n_chars").cast("string")))
    rows = table(spark, d, "documents").select("doc_id", said.alias("said"))
    characters = F.try_variant_get(tx.salvaged_json(F.col("said.value"), 1), "$.characters", "bigint")
    return rows.select("doc_id", characters.alias("characters"), F.col("said.error").alias("error"))


@query("""WITH p AS (SELECT conv_id, 'clips/' || conv_id || '/' || count(*) AS path FROM conversations GROUP BY conv_id)
SELECT conv_id AS clip, CASE WHEN contains(path, '/3') THEN 'FAILED' ELSE 'COMPLETED' END AS status, CASE WHEN NOT contains(path, '/3') THEN length(path) END AS speakers FROM p""")
def omni_surface(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of the sound of clips; those without a track are quarantined with their error."""
    said = annotators.register_annotator("profile", _model(_profile), "string")(F.col("path"))
    paths = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    rows = paths.select(F.col("conv_id").alias("clip"), F.concat_ws("/", F.lit("clips"), F.col("conv_id").cast("string"), F.col("n").cast("string")).alias("path")).select("clip", said.alias("said"))
    status = F.when(F.col("said.error").isNull(), F.lit("COMPLETED")).otherwise(F.lit("FAILED"))
    return rows.select("clip", status.alias("status"), F.try_variant_get(F.try_parse_json("said.value"), "$.speakers", "bigint").alias("speakers"))
