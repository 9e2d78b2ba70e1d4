"""Media tables made from the driver's tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.functions.clips import clip_name
from reelspark.plans.registry import table


def clips(spark: SparkSession, d: str) -> DataFrame:
    """movie, clip, start, end, file."""
    docs = table(spark, d, "documents").select(F.col("source").alias("movie"), F.col("doc_id").alias("clip"), ((F.col("doc_id") * 37) % 500000).alias("start"), "n_chars")
    docs = docs.withColumn("end", F.col("start") + F.col("n_chars"))
    return docs.select("movie", "clip", "start", "end", clip_name(F.col("clip") % 1000, F.col("start"), F.col("end")).alias("file"))


CLIPS = """clips AS (
  SELECT source AS movie, doc_id AS clip, (doc_id*37)%500000 AS "start", (doc_id*37)%500000 + n_chars AS "end",
    'scene_' || lpad(CAST(doc_id%1000 AS VARCHAR),3,'0') || '_' || lpad(CAST((doc_id*37)%500000 AS VARCHAR),6,'0') || '_' || lpad(CAST((doc_id*37)%500000+n_chars AS VARCHAR),6,'0') || '.mp4' AS file
  FROM documents)"""


def flags(spark: SparkSession, d: str) -> DataFrame:
    """movie, clip, file, has_person, has_text: null where a clip was not screened."""
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("clip"), (F.col("quality") == 1).alias("has_person"), (F.col("toxic") == 1).alias("has_text"))
    return clips(spark, d).join(labels, "clip", "left")


FLAGS = CLIPS + """,
flags AS (SELECT c.*, quality = 1 AS has_person, toxic = 1 AS has_text FROM clips c LEFT JOIN labels l ON l.doc_id = c.clip)"""


def segments(spark: SparkSession, d: str) -> DataFrame:
    """clip, turn, speaker, text, start, end: turns one after the other, a character a unit of time."""
    upto = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    rows = table(spark, d, "conversations").withColumn("end", F.sum(F.length("text")).over(upto))
    return rows.select(F.col("conv_id").alias("clip"), "turn", F.col("role").alias("speaker"), "text", (F.col("end") - F.length("text")).alias("start"), "end")


SEGMENTS = """segments AS (
  SELECT conv_id AS clip, turn, role AS speaker, text, e - length(text) AS "start", e AS "end"
  FROM (SELECT *, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM conversations))"""


def cues(spark: SparkSession, d: str) -> DataFrame:
    """clip, cue, start, end: ten cues a clip."""
    ids = table(spark, d, "conversations").select(F.col("conv_id").alias("clip")).distinct()
    ids = ids.withColumn("cue", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))))
    return ids.select("clip", "cue", (F.col("cue") * 200).alias("start"), (F.col("cue") * 200 + 150).alias("end"))


CUES = """cues AS (
  SELECT clip, cue, cue*200 AS "start", cue*200+150 AS "end"
  FROM (SELECT DISTINCT conv_id AS clip FROM conversations), (SELECT CAST(unnest(range(10)) AS BIGINT) AS cue))"""


def words(spark: SparkSession, d: str) -> DataFrame:
    """clip, word, start, end: fifty words a clip."""
    ids = table(spark, d, "conversations").select(F.col("conv_id").alias("clip")).distinct()
    ids = ids.withColumn("word", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(49).cast("long"))))
    return ids.select("clip", "word", (F.col("word") * 40 + 7).alias("start"), (F.col("word") * 40 + 37).alias("end"))


WORDS = """words AS (
  SELECT clip, word, word*40+7 AS "start", word*40+37 AS "end"
  FROM (SELECT DISTINCT conv_id AS clip FROM conversations), (SELECT CAST(unnest(range(50)) AS BIGINT) AS word))"""


def frame_scores(spark: SparkSession, d: str) -> DataFrame:
    """movie, frame, p: probability of a boundary."""
    k = F.get_json_object("props", "$.k").cast("double")
    rows = table(spark, d, "events").select(F.col("event_type").alias("movie"), "event_id", (k / 99).alias("p"))
    return rows.select("movie", (F.row_number().over(Window.partitionBy("movie").orderBy("event_id")) - 1).cast("long").alias("frame"), "p")


FRAME_SCORES = """frame_scores AS (
  SELECT event_type AS movie, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS frame, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE)/99 AS p FROM events)"""


def track_scores(spark: SparkSession, d: str) -> DataFrame:
    """track, frame, score."""
    return table(spark, d, "events").select(F.col("user_id").alias("track"), F.col("event_id").alias("frame"), F.col("value").alias("score"))


TRACK_SCORES = "track_scores AS (SELECT user_id AS track, event_id AS frame, value AS score FROM events)"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """clip, frame, x1, y1, x2, y2 in an 854 by 480 picture."""
    e = lambda k: F.element_at("embedding", k).cast("double")
    x, y = [(e(k) + 1) / 2 * 854 for k in (1, 3)], [(e(k) + 1) / 2 * 480 for k in (2, 4)]
    return table(spark, d, "embeddings").select(
        F.col("label").alias("clip"), F.col("vec_id").alias("frame"), F.least(*x).alias("x1"), F.least(*y).alias("y1"), F.greatest(*x).alias("x2"), F.greatest(*y).alias("y2")
    )


BOXES = """raw_boxes AS (
  SELECT label AS clip, vec_id AS frame, (CAST(embedding[1] AS DOUBLE)+1)/2*854 AS xa, (CAST(embedding[3] AS DOUBLE)+1)/2*854 AS xb,
    (CAST(embedding[2] AS DOUBLE)+1)/2*480 AS ya, (CAST(embedding[4] AS DOUBLE)+1)/2*480 AS yb FROM embeddings),
boxes AS (SELECT clip, frame, least(xa,xb) AS x1, least(ya,yb) AS y1, greatest(xa,xb) AS x2, greatest(ya,yb) AS y2 FROM raw_boxes)"""


def faces(spark: SparkSession, d: str) -> DataFrame:
    """clip, frame, face_no, x1, y1, x2, y2, conf."""
    rows = table(spark, d, "events").select((F.col("user_id") % 10).alias("clip"), F.floor(F.col("event_id") / 40).alias("frame"), "event_id", "user_id", "value")
    no = (F.row_number().over(Window.partitionBy("clip", "frame").orderBy("event_id")) - 1).cast("long")
    x1 = F.floor(F.col("user_id") / 10) * 56.0 + F.col("value") % 10
    return rows.select("clip", "frame", no.alias("face_no"), x1.alias("x1"), F.lit(100.0).alias("y1"), (x1 + 50).alias("x2"), F.lit(180.0).alias("y2"), (F.col("value") / 490).alias("conf"))


FACES = """faces AS (
  SELECT user_id%10 AS clip, event_id//40 AS frame, row_number() OVER (PARTITION BY user_id%10, event_id//40 ORDER BY event_id) - 1 AS face_no,
    (user_id//10)*56.0 + value%10 AS x1, 100.0 AS y1, (user_id//10)*56.0 + value%10 + 50 AS x2, 180.0 AS y2, value/490 AS conf FROM events)"""


def answers(spark: SparkSession, d: str) -> DataFrame:
    """id, answer: what a model might say, in five forms around {"n": ...}."""
    body = F.concat(F.lit('{"n": '), F.col("n_chars").cast("string"), F.lit("}"))
    k = F.col("doc_id") % 5
    text = (
        F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(k == 1, F.concat(F.lit("Assistant: "), body))
        .when(k == 2, body)
        .when(k == 3, F.lit("sorry, no answer"))
        .otherwise(F.concat(F.lit("Sure! "), body, F.lit(" hope it helps")))
    )
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), text.alias("answer"))


ANSWERS = """answers AS (
  SELECT doc_id AS id, CASE doc_id%5 WHEN 0 THEN '```json' || chr(10) || b || chr(10) || '```' WHEN 1 THEN 'Assistant: ' || b WHEN 2 THEN b
    WHEN 3 THEN 'sorry, no answer' ELSE 'Sure! ' || b || ' hope it helps' END AS answer
  FROM (SELECT doc_id, '{"n": ' || n_chars || '}' AS b FROM documents))"""
