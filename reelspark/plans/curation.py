"""Queries that count, select and join clips into a dataset, and tell what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.functions import clips as cl
from reelspark.operators import resume, stats
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query, table
from reelspark.streaming import stages

_DIALOGUE = "dlg AS (SELECT conv_id AS clip, bool_or(trim(text) <> '') AS has_dialogue, count(DISTINCT role) AS speakers FROM conversations GROUP BY conv_id)"
_MOVIES = f"""WITH {st.FLAGS}, {_DIALOGUE},
c AS (SELECT f.*, ("end"-"start")/24.0::DOUBLE AS dur FROM flags f),
m AS (
  SELECT movie, count(*) AS clips, round(coalesce(sum(dur), 0), 4) AS seconds, round(coalesce(avg(dur), 0), 4) AS mean_seconds, round(coalesce(min(dur), 0), 4) AS min_seconds, round(coalesce(max(dur), 0), 4) AS max_seconds,
    CAST(count(*) FILTER (has_person) AS BIGINT) AS with_person, CAST(count(*) FILTER (NOT has_person) AS BIGINT) AS without_person, CAST(count(*) FILTER (has_person IS NULL) AS BIGINT) AS person_unknown,
    CAST(count(*) FILTER (has_text) AS BIGINT) AS with_text, CAST(count(*) FILTER (NOT has_text) AS BIGINT) AS without_text, CAST(count(*) FILTER (has_text IS NULL) AS BIGINT) AS text_unknown,
    CAST(count(*) FILTER (has_dialogue) AS BIGINT) AS with_dialogue, CAST(coalesce(sum(speakers), 0) AS BIGINT) AS speaker_clips
  FROM c LEFT JOIN dlg ON dlg.clip = c.clip GROUP BY movie)
"""


def _dialogue(spark: SparkSession, d: str) -> DataFrame:
    return stats.dialogue_summary(table(spark, d, "conversations").select(F.col("conv_id").alias("clip"), "text", F.col("role").alias("speaker")), "clip")


@query(_MOVIES + "SELECT * FROM m")
def movie_stats(spark: SparkSession, d: str) -> DataFrame:
    clips = st.flags(spark, d).withColumn("duration", cl.duration_by_prefix(F.col("file")))
    return stats.movie_stats(clips, _dialogue(spark, d))


@query(_MOVIES + """SELECT count(*) AS movies, CAST(sum(clips) AS BIGINT) AS clips, round(sum(seconds), 2) AS seconds, round(sum(seconds)/sum(clips), 4) AS mean_seconds,
  min(min_seconds) AS min_seconds, max(max_seconds) AS max_seconds, CAST(sum(with_dialogue) AS BIGINT) AS with_dialogue FROM m""")
def global_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.global_stats(movie_stats(spark, d))


@query(f"WITH {_DIALOGUE} SELECT clip, has_dialogue, speakers FROM dlg")
def dialogue_summary(spark: SparkSession, d: str) -> DataFrame:
    return _dialogue(spark, d)


@query(f"WITH {_DIALOGUE} SELECT speakers, count(*) AS clips FROM dlg GROUP BY speakers")
def speaker_distribution(spark: SparkSession, d: str) -> DataFrame:
    return _dialogue(spark, d).groupBy("speakers").agg(F.count(F.lit(1)).alias("clips"))


_TAGGED = "lines AS (SELECT conv_id AS clip, CASE WHEN role = 'system' THEN 'UNK' ELSE 'T' || turn END AS tag, CASE WHEN turn % 5 = 4 THEN 'UNKNOWN' ELSE role END AS speaker FROM conversations)"


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    tag = F.when(F.col("role") == "system", F.lit("UNK")).otherwise(F.concat(F.lit("T"), F.col("turn").cast("string")))
    speaker = F.when(F.col("turn") % 5 == 4, F.lit("UNKNOWN")).otherwise(F.col("role"))
    return table(spark, d, "conversations").select(F.col("conv_id").alias("clip"), tag.alias("tag"), speaker.alias("speaker"))


@query(f"""WITH {_TAGGED}, u AS (SELECT *, tag = 'UNK' OR speaker IN ('UNKNOWN', 'UNK') AS unk FROM lines)
SELECT clip, count(DISTINCT CASE WHEN NOT unk THEN speaker END) AS speakers, CAST(count(*) FILTER (unk) AS BIGINT) AS unknown_lines, count(*) AS lines, count(*) FILTER (unk) = 0 AS all_matched FROM u GROUP BY clip""")
def unk_summary(spark: SparkSession, d: str) -> DataFrame:
    return stats.aligned_summary(_tagged(spark, d), "clip")


@query(f"""WITH {_TAGGED}, k AS (SELECT clip FROM lines GROUP BY clip HAVING count(*) > 0 AND NOT bool_or(upper(speaker) LIKE '%UNK%'))
SELECT count(*) AS total, CAST(count(k.clip) AS BIGINT) AS passed FROM (SELECT DISTINCT clip FROM lines) c LEFT JOIN k ON k.clip = c.clip""")
def no_unk_clips(spark: SparkSession, d: str) -> DataFrame:
    """How many clips have no line of an unknown speaker."""
    per = _tagged(spark, d).groupBy("clip").agg(F.bool_or(F.upper("speaker").contains("UNK")).alias("unk"))
    return per.agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("unk")).alias("passed"))


@query(f"""WITH {st.FLAGS} SELECT movie, count(*) AS total, CAST(count(*) FILTER (has_text) AS BIGINT) AS with_text, CAST(count(*) FILTER (has_person) AS BIGINT) AS with_person FROM flags GROUP BY movie""")
def screen_counts(spark: SparkSession, d: str) -> DataFrame:
    return st.flags(spark, d).groupBy("movie").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("has_text")).alias("with_text"), F.count_if(F.col("has_person")).alias("with_person"))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    """Clips with a person and surely without text, that have a transcript."""
    said = table(spark, d, "conversations").select(F.col("conv_id").alias("clip"))
    return st.flags(spark, d).filter(F.col("has_person") & ~F.col("has_text")).join(said, "clip", "left_semi")


_TARGETS = f"WITH {st.FLAGS}, t AS (SELECT * FROM flags WHERE has_person AND NOT has_text AND clip IN (SELECT conv_id FROM conversations))"


@query(_TARGETS + " SELECT movie, clip, file FROM t")
def asd_targets(spark: SparkSession, d: str) -> DataFrame:
    return _targets(spark, d).select("movie", "clip", "file")


@query(_TARGETS + """ SELECT movie, clip, file FROM t WHERE ("end"-"start"+1)/24.0 >= 2.0 AND clip IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING bool_or(regexp_matches(text, '[\\p{L}\\p{N}]')))""")
def asd_targets_ext(spark: SparkSession, d: str) -> DataFrame:
    """Those of at least two seconds with real dialogue; a name that tells no duration passes."""
    long = F.coalesce(cl.duration_by_suffix(F.col("file")) >= 2.0, F.lit(True))
    said = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("clip")).agg(F.bool_or(F.col("text").rlike(r"[\p{L}\p{N}]")).alias("real")).filter("real")
    return _targets(spark, d).filter(long).join(said, "clip", "left_semi").select("movie", "clip", "file")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    return resume.pending(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"]).select("doc_id", "source")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def cleanup_targets(spark: SparkSession, d: str) -> DataFrame:
    """Who has begun something and finished nothing."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    begun = table(spark, d, "customer").select("c_custkey").join(orders, "c_custkey", "left_semi")
    return resume.pending(begun, orders.filter("o_orderstatus = 'F'"), ["c_custkey"])


@query("SELECT o_custkey AS movie, count(*) AS items, CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS open_items, bool_and(o_orderstatus <> 'O') AS complete FROM orders GROUP BY o_custkey")
def completeness(spark: SparkSession, d: str) -> DataFrame:
    return resume.barrier(table(spark, d, "orders").withColumnRenamed("o_custkey", "movie"), ["movie"], F.col("o_orderstatus") != "O")


@query("""SELECT o_custkey AS movie, count(*) AS items, CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS open_items, bool_and(o_orderstatus <> 'O' AND c_acctbal > 0) AS complete
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey""")
def stage_barrier(spark: SparkSession, d: str) -> DataFrame:
    """Complete only where the stage before is complete too."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).withColumnRenamed("o_custkey", "movie")
    return resume.barrier(rows, ["movie"], F.col("o_orderstatus") != "O", F.col("c_acctbal") > 0)


@query("SELECT o_orderkey AS item, o_custkey AS movie FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def stage_pending(spark: SparkSession, d: str) -> DataFrame:
    ready = table(spark, d, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("movie"))
    return resume.pending(ready, table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("item")), ["item"])


@query("""SELECT 'screened' AS stage, count(*) AS done, (SELECT count(*) FROM documents) - count(*) AS pending FROM labels
UNION ALL SELECT 'transcribed', count(DISTINCT conv_id), (SELECT count(*) FROM documents) - count(DISTINCT conv_id) FROM conversations""")
def stage_progress(spark: SparkSession, d: str) -> DataFrame:
    everything = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("all")).scalar()
    done = table(spark, d, "labels").agg(F.lit("screened").alias("stage"), F.count(F.lit(1)).alias("done"))
    done = done.unionByName(table(spark, d, "conversations").agg(F.lit("transcribed").alias("stage"), F.count_distinct("conv_id").alias("done")))
    return done.select("stage", "done", (everything - F.col("done")).alias("pending"))


def _dataset(spark: SparkSession, d: str, items: DataFrame) -> DataFrame:
    name = F.concat(F.lit("p"), F.col("l_linenumber").cast("string"), F.lit("_norm.jpg"))
    images = items.groupBy(F.col("l_orderkey").alias("clip")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", name.alias("f")))).alias("i"))
    images = images.select("clip", F.array_join(F.transform("i", lambda x: x["f"]), ",").alias("images"))
    speaking = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("movie"), F.col("o_orderkey").alias("clip"))
    meta = table(spark, d, "customer").select(F.col("c_custkey").alias("movie"), F.col("c_name").alias("meta"))
    return speaking.join(images, "clip").join(meta, "movie").select("movie", "clip", "meta", "images")


_DATASET = """WITH imgs AS (SELECT l_orderkey AS clip, list('p' || l_linenumber || '_norm.jpg' ORDER BY l_linenumber) AS images FROM lineitem GROUP BY l_orderkey)
SELECT o_custkey AS movie, o_orderkey AS clip, c_name AS meta, array_to_string(images, ',') AS images FROM orders JOIN customer ON c_custkey = o_custkey JOIN imgs ON clip = o_orderkey WHERE o_orderstatus = 'F'"""


@query(_DATASET)
def dataset_join(spark: SparkSession, d: str) -> DataFrame:
    """Speaking clips with their metadata and every image; clips that lack any go."""
    return _dataset(spark, d, table(spark, d, "lineitem"))


@query(_DATASET)
def dataset_join_whole(spark: SparkSession, d: str) -> DataFrame:
    """The same, under the name it had while ``dataset_join`` took three images a clip."""
    return dataset_join(spark, d)


@query("SELECT 'scene_' || l_orderkey AS clip, count(*) AS images, min('m/scene_' || l_orderkey || '_person' || l_linenumber || '_norm.jpg') AS first FROM lineitem GROUP BY l_orderkey")
def norm_images(spark: SparkSession, d: str) -> DataFrame:
    """Images by the clip that their name belongs to."""
    path = F.concat(F.lit("m/scene_"), F.col("l_orderkey").cast("string"), F.lit("_person"), F.col("l_linenumber").cast("string"), F.lit(".jpg"))
    rows = table(spark, d, "lineitem").select(cl.normalised_path(path).alias("path"))
    return rows.groupBy(cl.clip_of_image(F.col("path")).alias("clip")).agg(F.count(F.lit(1)).alias("images"), F.min("path").alias("first"))


@query("""SELECT d.doc_id AS clip, CASE WHEN l.doc_id IS NULL THEN 'no_boxes' WHEN c.conv_id IS NULL THEN 'no_caption' ELSE 'ok' END AS status
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN (SELECT DISTINCT conv_id FROM conversations) c ON c.conv_id = d.doc_id""")
def caption_join_status(spark: SparkSession, d: str) -> DataFrame:
    """What a clip lacks is its status; no clip goes."""
    boxes = table(spark, d, "labels").select(F.col("doc_id").alias("clip"), F.lit(True).alias("b"))
    captions = table(spark, d, "conversations").select(F.col("conv_id").alias("clip"), F.lit(True).alias("c")).distinct()
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("clip")).join(boxes, "clip", "left").join(captions, "clip", "left")
    return rows.select("clip", F.when(F.col("b").isNull(), F.lit("no_boxes")).when(F.col("c").isNull(), F.lit("no_caption")).otherwise(F.lit("ok")).alias("status"))


@query("""SELECT d.doc_id AS image, CASE WHEN l.doc_id IS NULL THEN true ELSE l.quality = 1 END AS face_visible, CASE WHEN l.doc_id IS NULL THEN 'full_body' WHEN l.toxic = 1 THEN 'close_up' ELSE 'half_body' END AS shot_type
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def orientation_lookup(spark: SparkSession, d: str) -> DataFrame:
    """An image that was not judged counts as a face and full body; one whose judgement is null stays null."""
    judged = table(spark, d, "labels").select(F.col("doc_id").alias("image"), F.lit(True).alias("there"), (F.col("quality") == 1).alias("face"), F.when(F.col("toxic") == 1, F.lit("close_up")).otherwise(F.lit("half_body")).alias("shot"))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("image")).join(judged, "image", "left")
    absent = F.col("there").isNull()
    return rows.select("image", F.when(absent, F.lit(True)).otherwise(F.col("face")).alias("face_visible"), F.when(absent, F.lit("full_body")).otherwise(F.col("shot")).alias("shot_type"))


@query("""WITH t AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS n, count(*) OVER () AS total FROM customer)
SELECT c_custkey, CAST(n // CAST(ceil(total/18.0) AS BIGINT) AS BIGINT) AS worker FROM t""")
def chunk_partition(spark: SparkSession, d: str) -> DataFrame:
    """Work lists in eighteen runs."""
    rows = resume.numbered(table(spark, d, "customer").select("c_custkey"), [F.col("c_custkey")], "total")
    return rows.select("c_custkey", resume.contiguous_worker(F.col("number"), F.col("total"), 18).alias("worker"))


@query("SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) % 18 AS worker FROM customer")
def stride_partition(spark: SparkSession, d: str) -> DataFrame:
    rows = resume.numbered(table(spark, d, "customer").select("c_custkey"), [F.col("c_custkey")])
    return rows.select("c_custkey", resume.strided_worker(F.col("number"), 18).cast("long").alias("worker"))


@query("SELECT doc_id, source, 'COMPLETED' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def stream_vs_batch_clips(spark: SparkSession, d: str) -> DataFrame:
    """What a stage leaves after taking all documents as a stream, where labelled ones were done before."""
    base = scratch.shared_dir(spark) + "/" + scratch.unique("stream")
    schema = "doc_id bigint, source string, status string"
    done = table(spark, d, "labels").select("doc_id", F.lit("").alias("source"), F.lit("DONE").alias("status"))
    done.write.parquet(base + "/out")
    table(spark, d, "documents").select("doc_id", "source").write.parquet(base + "/in")
    items = stages.watch(spark, base + "/in", "doc_id bigint, source string")
    work = lambda df: df.select("doc_id", "source", stages.with_status(F.col("source"), F.lit(None)).alias("status"))
    stages.run_stage(items, ["doc_id"], base + "/out", base + "/checkpoint", work, schema).awaitTermination()
    return spark.read.schema(schema).parquet(base + "/out").filter("status = 'COMPLETED'")
