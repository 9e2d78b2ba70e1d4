"""Queries on series of any length, on what grows from run to run, and on work that fails."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.operators import attempts, segmented, stats, tracking
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query, table
from reelspark.sources import annotators, datasources, records, subtitles, windows
from reelspark.streaming import barrier, progress, scenes, stages

_ONE = """s AS (SELECT event_id AS pos, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE)/99 AS p, value, event_type FROM events)"""


def _one(spark: SparkSession, d: str) -> DataFrame:
    """series, pos, p, value, event_type: all events as one series."""
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, d, "events").select(F.lit(0).alias("series"), F.col("event_id").alias("pos"), (k / 99).alias("p"), "value", "event_type")


@query(f"""WITH {_ONE}, f AS (SELECT *, p > 0.2 AS cut, lag(p > 0.2) OVER (ORDER BY pos) AS before, lead(pos) OVER (ORDER BY pos) AS nxt FROM s),
r AS (SELECT *, sum(CASE WHEN NOT cut AND coalesce(before, true) THEN 1 ELSE 0 END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT min(pos) AS start_frame, coalesce(max_by(nxt, pos) FILTER (nxt IS NOT NULL), max(pos)) AS end_frame FROM r WHERE NOT cut GROUP BY run""")
def long_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Scenes of one series that goes over many tasks."""
    return segmented.scenes_of(_one(spark, d), ["series"], "pos", "p", 0.2).drop("series")


@query(f"""WITH {_ONE}, f AS (SELECT *, value >= 200 AS isin, lag(value >= 200) OVER (ORDER BY pos) AS before, lead(pos) OVER (ORDER BY pos) AS nxt FROM s),
r AS (SELECT *, sum(CASE WHEN isin AND NOT coalesce(before, false) THEN 1 ELSE 0 END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM f),
g AS (SELECT min(pos) AS "start", max(coalesce(nxt, pos)) AS "end" FROM r WHERE isin GROUP BY run)
SELECT "start", "end", "end" - "start" AS duration FROM g WHERE "end" - "start" > 3""")
def long_segments(spark: SparkSession, d: str) -> DataFrame:
    """Runs above a threshold of one series that goes over many tasks."""
    return segmented.segments_of(_one(spark, d), ["series"], "pos", "value", 200, 3).drop("series")


@query(f"""WITH {_ONE} SELECT pos, last_value(CASE WHEN event_type = 'purchase' AND value > 300 THEN value END IGNORE NULLS) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS held FROM s""")
def long_locf(spark: SparkSession, d: str) -> DataFrame:
    """The last large purchase up to each event, carried over the ranges of one series."""
    value = F.when((F.col("event_type") == "purchase") & (F.col("value") > 300), F.col("value"))
    return segmented.carried(_one(spark, d), ["series"], "pos", value, "held").select("pos", "held")


@query("""WITH l AS (SELECT user_id % 10 AS k, event_id * 4 AS t, event_id FROM events), r AS (SELECT o_custkey % 10 AS k, o_orderkey AS t, o_orderkey, o_orderstatus FROM orders)
SELECT l.event_id, r.o_orderkey, r.o_orderstatus AS status FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.t >= r.t""")
def asof_orders(spark: SparkSession, d: str) -> DataFrame:
    """The last order of its group before each event."""
    left = table(spark, d, "events").select((F.col("user_id") % 10).alias("k"), (F.col("event_id") * 4).alias("t"), "event_id")
    right = table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("k"), F.col("o_orderkey").alias("t"), "o_orderkey", F.col("o_orderstatus").alias("status"))
    return segmented.asof(left, right, ["k"], "t", ["o_orderkey", "status"]).select("event_id", "o_orderkey", "status")


def _smooth(radius: int):
    def load():
        import numpy as np

        def run(items: list) -> list:
            out = []
            for values in items:
                sums = np.concatenate(([0.0], np.cumsum(values)))
                at = np.arange(len(values))
                low, high = np.maximum(at - radius, 0), np.minimum(at + radius + 1, len(values))
                out.append(((sums[high] - sums[low]) / (high - low)).tolist())
            return out

        return run

    return load


@query(f"""WITH {st.FRAME_SCORES} SELECT movie, frame, round(avg(p) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING), 6) AS said FROM frame_scores""")
def windowed_model(spark: SparkSession, d: str) -> DataFrame:
    """A model that averages what is around each frame, run on overlapping windows of a hundred frames and stitched together."""
    annotate = annotators.register_annotator("smooth", _smooth(25), "array<double>")
    said = windows.windowed(st.frame_scores(spark, d), ["movie"], "frame", "p", annotate, 100, 25, "said")
    return said.select("movie", "frame", F.round("said", 6).alias("said"))


@query("""WITH e AS (SELECT user_id % 50 AS f, event_id % 97 = 0 AND (user_id % 50) % 5 = 0 AS open FROM events)
SELECT CAST(f AS VARCHAR) AS film, count(*) AS items FROM e WHERE f % 7 <> 0 GROUP BY f HAVING NOT bool_or(open)""")
def streamed_barrier(spark: SparkSession, d: str) -> DataFrame:
    """Films that a stream of item events makes done: in three runs of the query, each going on where the one before ended."""
    base = scratch.app_dir(spark) + "/" + scratch.unique("barrier")
    e = table(spark, d, "events").select((F.col("user_id") % 50).alias("f"), "event_id")
    row = lambda kind, item=F.lit(None): (F.col("f").cast("string").alias("film"), F.lit(kind).alias("kind"), item.cast("string").alias("item"))
    open_ = (F.col("event_id") % 97 == 0) & (F.col("f") % 5 == 0)
    through = e.filter(~open_).select(*row(barrier.THROUGH, F.col("event_id")))
    found = e.select(*row(barrier.FOUND, F.col("event_id")))
    upstream = e.filter("f % 7 <> 0").select("f").distinct().select(*row(barrier.UPSTREAM_DONE))
    with barrier.rocksdb(spark):
        for part in (through, found.unionByName(through), upstream.unionByName(found)):  # told twice, and through before found
            part.write.mode("append").parquet(base + "/in")
            events = stages.watch(spark, base + "/in", "film string, kind string, item string")
            done = barrier.stream_barrier(events).writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/checkpoint")
            done.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("film string, items long").parquet(base + "/out")


@query(f"""WITH {st.FRAME_SCORES}, f AS (SELECT *, p > 0.2 AS cut, lag(p > 0.2) OVER w AS before, lead(frame) OVER w AS nxt FROM frame_scores WINDOW w AS (PARTITION BY movie ORDER BY frame)),
r AS (SELECT *, sum(CASE WHEN NOT cut AND coalesce(before, true) THEN 1 ELSE 0 END) OVER (PARTITION BY movie ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT movie, min(frame) AS start_frame, coalesce(max_by(nxt, frame) FILTER (nxt IS NOT NULL), max(frame)) AS end_frame FROM r WHERE NOT cut GROUP BY movie, run""")
def scenes_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Scenes of films whose frames came in three parts, each read once, the open scene going on from part to part."""
    base = scratch.app_dir(spark) + "/" + scratch.unique("growing")
    frames = st.frame_scores(spark, d)
    sizes = frames.groupBy("movie").agg(F.count(F.lit(1)).alias("n"))
    part = F.floor(F.col("frame") * 3 / F.col("n"))
    dealt = scratch.written(frames.join(sizes, "movie").withColumn("part", part), "growing-frames")
    for k in range(3):
        dealt.filter(F.col("part") == k).select("movie", "frame", "p").write.mode("append").parquet(base + "/in")
        scenes.grow_scenes(stages.watch(spark, base + "/in", "movie string, frame long, p double"), base, base + "/checkpoint", 0.2).awaitTermination()
    return scenes.scenes_so_far(spark, base, 3)


@query(f"""WITH {st.SEGMENTS} SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY turn) AS idx, "start" * 1.0::DOUBLE AS "start", "end" * 1.0::DOUBLE AS "end", trim('[' || speaker || '] ' || trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text FROM segments WHERE "end" > "start" """)
def srt_files(spark: SparkSession, d: str) -> DataFrame:
    """Turns written as one SRT file a clip by the sink for entities, and read again as a data source."""
    datasources.register(spark)
    base = scratch.app_dir(spark) + "/" + scratch.unique("srt")
    cues = st.segments(spark, d).filter("end > start").withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    files = subtitles.srt_texts(cues, "clip", "turn").select(F.concat(F.lit("clips/"), F.col("clip").cast("string"), F.lit(".srt")).alias("name"), "text")
    files.write.format("entity_files").mode("append").save(base)
    clip = F.regexp_extract("path", r"(\d+)\.srt$", 1).cast("long").alias("clip")
    return spark.read.format("srt").load(base).select(clip, "idx", "start", "end", "text")


@query("""SELECT user_id AS clip, count(*) AS cues, min(event_id) AS first, round(CAST(sum(value) AS DOUBLE), 4) AS total, CAST(user_id % 3 = 0 AS BOOLEAN) AS broken FROM events GROUP BY user_id""")
def entity_documents(spark: SparkSession, d: str) -> DataFrame:
    """One JSON document a clip, written by the sink for entities and read by the tolerant reader; each third is followed by a broken one, which reads as none."""
    datasources.register(spark)
    base = scratch.app_dir(spark) + "/" + scratch.unique("documents")
    rows = table(spark, d, "events").groupBy(F.col("user_id").alias("clip")).agg(F.count(F.lit(1)).alias("cues"), F.min("event_id").alias("first"), F.sum("value").alias("total"))
    name = F.concat(F.lit("clips/"), F.col("clip").cast("string"), F.lit("/result.json")).alias("name")
    good = rows.select(name, F.to_json(F.struct("clip", "cues", "first", "total")).alias("text"))
    bad = rows.filter("clip % 3 = 0").select(F.replace(name, F.lit("result"), F.lit("broken")).alias("name"), F.concat(F.lit('{"clip": '), F.col("clip").cast("string"), F.lit(', "cues"')).alias("text"))
    good.unionByName(bad).write.format("entity_files").mode("append").save(base)
    read = records.tolerant_documents(records.whole_texts(spark, f"{base}/clips/*/*.json"))
    get = lambda k, kind: F.try_variant_get("doc", f"$.{k}", kind).alias(k)
    found = read.select(F.regexp_extract("path", r"clips/(\d+)/", 1).cast("long").alias("clip"), F.col("doc").isNull().alias("none"), get("cues", "long"), get("first", "long"), get("total", "double"))
    whole = found.groupBy("clip").agg(F.max("cues").alias("cues"), F.max("first").alias("first"), F.round(F.max("total"), 4).alias("total"), F.bool_or("none").alias("broken"))
    return whole


@query("""SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 'libx264' WHEN doc_id % 5 <> 0 THEN 'libopenh264' WHEN doc_id % 2 = 0 THEN 'mpeg4' END AS candidate,
  CASE WHEN doc_id % 3 <> 0 THEN 1 WHEN doc_id % 5 <> 0 THEN 2 ELSE 3 END AS tried FROM documents""")
def first_success(spark: SparkSession, d: str) -> DataFrame:
    """Documents stand for clips of which encoders fail on some: the first that works, and how many were tried."""
    fails = lambda bad: lambda df: df.withColumn("value", F.when(~bad, F.lit("done"))).withColumn("error", F.when(bad, F.lit("cannot encode")))
    i = F.col("doc_id")
    encoders = [("libx264", fails(i % 3 == 0)), ("libopenh264", fails(i % 5 == 0)), ("mpeg4", fails(i % 2 != 0))]
    results, tries = attempts.first_success(table(spark, d, "documents").select("doc_id"), ["doc_id"], encoders)
    return results.join(tries.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("tried")), "doc_id").select("doc_id", "candidate", "tried")


@query("SELECT doc_id, CAST(least(doc_id % 5 + 1, 3) AS INTEGER) AS attempts, CASE WHEN doc_id % 5 < 3 THEN 'COMPLETED' ELSE 'FAILED' END AS status FROM documents")
def retried_items(spark: SparkSession, d: str) -> DataFrame:
    """Items that fail up to four times, polled five times with three tries each."""
    log = scratch.app_dir(spark) + "/" + scratch.unique("attempt-log")
    items = table(spark, d, "documents").select("doc_id")

    def work(df: DataFrame) -> DataFrame:
        bad = F.col("attempt") <= F.col("doc_id") % 5
        return df.withColumn("value", F.when(~bad, F.lit("done"))).withColumn("error", F.when(bad, F.lit("busy")))

    for _ in range(5):
        attempts.poll(spark, items, ["doc_id"], log, work, attempts.RETRY, 3)
    return attempts.outcome(attempts.logged(spark, log), ["doc_id"]).select("doc_id", "attempts", "status")


@query("""WITH e AS (SELECT event_type AS film, user_id % 5 AS part, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 10 AS k, event_id % 1000 AS m FROM events)
SELECT film, part, CAST((grouping(film) + grouping(part)) AS BIGINT) AS level, count(*) AS rows, CAST(sum(m) AS BIGINT) AS total,
  array_to_string(list_transform(map_entries(histogram(k)), lambda x: x.key || ':' || x.value), ',') AS distribution
FROM e GROUP BY ROLLUP (film, part)""")
def stats_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Counts, sums and distributions by film and part, by film, and over all, with one expansion."""
    k = (F.get_json_object("props", "$.k").cast("long") % 10).alias("k")
    rows = table(spark, d, "events").select(F.col("event_type").alias("film"), (F.col("user_id") % 5).alias("part"), k, (F.col("event_id") % 1000).alias("m"))
    text = F.array_join(F.transform(F.map_entries("distribution"), lambda x: F.concat(x["key"].cast("string"), F.lit(":"), x["value"].cast("string"))), ",")
    return stats.rolled_up(rows, ["film", "part"], "k", "m").withColumn("distribution", text)


@query("""SELECT CASE WHEN doc_id % 7 = 0 THEN 'FAILED' WHEN doc_id % 5 = 0 THEN 'NO_VALID_SPEAKER' WHEN doc_id % 11 = 0 THEN 'other' ELSE 'COMPLETED' END AS status, count(*) AS items FROM documents GROUP BY 1""")
def observed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Items by status, counted while their stage is written, without reading what it wrote."""
    i = F.col("doc_id")
    status = F.when(i % 7 == 0, F.lit("FAILED")).when(i % 5 == 0, F.lit("NO_VALID_SPEAKER")).when(i % 11 == 0, F.lit("SKIPPED")).otherwise(F.lit("COMPLETED"))
    seen = Observation("stage")
    scratch.removed(scratch.written(progress.observed(table(spark, d, "documents").select("doc_id", status.alias("status")), seen), "observed"))
    return progress.counts_of(spark, seen)


@query()
def tracks_between_cuts(spark: SparkSession, d: str) -> DataFrame:
    """Tracks of whole clips by the rule that takes faces out of the list it goes over; cut where no face follows. Sequential, so held against a loop in the tests."""
    faces = st.faces(spark, d).withColumn("frame", F.col("frame") + 20 * F.floor(F.col("frame") / 50))
    return tracking.greedy_tracks(faces, ["clip"], 5, same_frame=True, skipping=True)
