"""Scenes of films whose frames come in bit by bit: a run reads only frames that are new, and the open scene goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelspark import scratch
from reelspark.operators.segmented import runs_of

_STATE = "movie string, first_frame long, last_frame long, open_start long, low boolean"
_SHOTS = "movie string, start_frame long, end_frame long"


def _state(spark: SparkSession, base: str, batch: int) -> DataFrame:
    """State after the last batch before ``batch``: of each film its first and last frame, where the open scene began, and whether any frame was none of a transition."""
    if batch == 0:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{base}/state/{batch - 1}")


def grow_scenes(frames: DataFrame, base: str, checkpoint: str, threshold: float) -> StreamingQuery:
    """Write down the scenes that a stream of (movie, frame, p) ends, below ``base``, and go on where the last run stopped.

    What the checkpoint has listed is not read again. A batch meets the films' state, one row each, and writes scenes and
    state under its own number, so a batch that runs twice writes the same. Frames of a film come in order from batch
    to batch, inside one in any; a frame at or before the film's last one has been seen and is passed over.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        state = _state(spark, base, number)
        new = df.join(state, "movie", "left").filter("last_frame IS NULL OR frame > last_frame").select("movie", "frame", (F.col("p") > threshold).alias("cut"))
        new = scratch.written(new.groupBy("movie", "frame").agg(F.bool_or(F.coalesce("cut", F.lit(False))).alias("cut")), "new-frames")  # read once
        touched = new.groupBy("movie").agg(F.min("frame").alias("from"), F.max("frame").alias("to"), F.bool_or(~F.col("cut")).alias("some"))
        known = touched.join(state, "movie", "left")
        # The last frame read stands for the open scene, which the runs of the new frames then continue.
        held = known.filter("open_start IS NOT NULL").select("movie", F.col("last_frame").alias("frame"), F.lit(False).alias("cut"))
        found = runs_of(new.unionByName(held), ["movie"], "frame", ~F.col("cut")).join(state, "movie", "left")
        found = found.select("movie", F.when(F.col("start") == F.col("last_frame"), F.col("open_start")).otherwise(F.col("start")).alias("start_frame"), F.col("next").alias("end_frame"))
        found.filter("end_frame IS NOT NULL").write.mode("overwrite").parquet(f"{base}/shots/{number}")
        open_ = found.filter("end_frame IS NULL").select("movie", F.col("start_frame").alias("now_open"))
        after = known.join(open_, "movie", "left").select(
            "movie", F.coalesce("first_frame", "from").alias("first_frame"), F.col("to").alias("last_frame"), F.col("now_open").alias("open_start"), (F.coalesce("low", F.lit(False)) | F.col("some")).alias("low")
        )
        after.unionByName(state.join(touched.select("movie"), "movie", "left_anti")).write.mode("overwrite").parquet(f"{base}/state/{number}")
        scratch.removed(new)

    return frames.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scenes_so_far(spark: SparkSession, base: str, batches: int) -> DataFrame:
    """movie, start_frame, end_frame after ``batches`` batches: all scenes written, and the last ones as if the films ended here."""
    if not batches:
        return spark.createDataFrame([], _SHOTS)
    written = spark.read.schema(_SHOTS).parquet(*[f"{base}/shots/{k}" for k in range(batches)])
    state = _state(spark, base, batches)
    last = state.filter("open_start IS NOT NULL OR NOT low").select("movie", F.coalesce("open_start", "first_frame").alias("start_frame"), F.col("last_frame").alias("end_frame"))
    return written.unionByName(last)
