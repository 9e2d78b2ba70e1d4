"""Ordered fallbacks and retries: who is tried with what, and a log of every attempt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch

#: A function that adds ``value`` and ``error`` to its rows.
Work = Callable[[DataFrame], DataFrame]
#: What becomes of an item that failed: it is tried at the next poll, it has failed, or it counts as done without a value.
RETRY, FAIL, EMPTY = "retry", "fail", "empty"


def first_success(items: DataFrame, keys: list[str], candidates: list[tuple[str, Work]]) -> tuple[DataFrame, DataFrame]:
    """(results, attempts): ``items`` with candidate and value of the first candidate that succeeds, and keys, attempt, candidate, error of all tries.

    An attempt fails if it gives an error or no value. Each candidate sees only the items that all before it failed on; its results
    are a table before the next one starts, so nothing is tried twice. Items on which all fail have a null candidate and value, and ``error`` of
    the last. Keys name items: of rows that share them one is tried. Without candidates nothing is tried.
    """
    kept = items.dropDuplicates(keys)
    open_, rounds = kept, []
    for number, (name, work) in enumerate(candidates, 1):
        tried = work(open_).select(*keys, F.lit(number).alias("attempt"), F.lit(name).alias("candidate"), "value", "error")
        tried = tried.withColumn("error", F.when(F.col("value").isNull(), F.coalesce("error", F.lit("no value"))).otherwise(F.col("error")))
        rounds.append(scratch.written(tried, f"attempts-{number}"))
        open_ = kept.join(rounds[-1].filter("error IS NOT NULL").select(*keys), keys, "left_semi")
    if not rounds:
        return kept.withColumns({c: F.lit(None).cast("string") for c in ("candidate", "value", "error")}), kept.select(*keys).limit(0).withColumns({"attempt": F.lit(0), "candidate": F.lit(""), "error": F.lit("")})
    every = rounds[0]
    for r in rounds[1:]:
        every = every.unionByName(r)
    # Of an item the last attempt is the one that counts: nothing is tried after a success.
    last = every.groupBy(*keys).agg(F.max_by(F.struct(F.when(F.col("error").isNull(), F.col("candidate")).alias("candidate"), F.when(F.col("error").isNull(), F.col("value")).alias("value"), "error"), "attempt").alias("r"))
    return kept.join(last.select(*keys, "r.*"), keys, "left"), every.drop("value")


def poll(spark: SparkSession, items: DataFrame, keys: list[str], log: str, work: Work, policy: str = RETRY, tries: int | None = None) -> DataFrame:
    """Try what is open, append keys, attempt, status, value, error to the table ``log``, and give what was appended.

    Open are items of which the log has no final status. ``work`` gets them with ``attempt``, the number of this try. After a failure the policy
    decides: RETRY leaves the item open, until ``tries`` have failed, then it is FAILED; FAIL makes it FAILED at once; EMPTY makes it
    COMPLETED without a value. A poll's rows are written once, in one table write, so one that is broken off has tried nothing.
    """
    tried = logged(spark, log)
    kept = items.dropDuplicates(keys)
    if tried is None:
        open_ = kept.withColumn("attempt", F.lit(1))
    else:
        state = tried.groupBy(*keys).agg(F.max("attempt").alias("attempt"), F.bool_or(F.col("status") != "RETRY").alias("final"))
        open_ = kept.join(state, keys, "left").filter("final IS NULL OR NOT final").drop("final").withColumn("attempt", F.coalesce("attempt", F.lit(0)) + 1)
    done = F.col("error").isNull() & F.col("value").isNotNull()
    used_up = F.lit(False) if tries is None else F.col("attempt") >= tries
    failed = {RETRY: F.when(used_up, F.lit("FAILED")).otherwise(F.lit("RETRY")), FAIL: F.lit("FAILED"), EMPTY: F.lit("COMPLETED")}[policy]
    rows = work(open_).withColumn("status", F.when(done, F.lit("COMPLETED")).otherwise(failed)).select(*keys, "attempt", "status", "value", "error")
    rows = scratch.written(rows, "poll")
    rows.write.mode("append").parquet(log)
    return rows


def logged(spark: SparkSession, log: str) -> DataFrame | None:
    """The log of all polls; None before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    return spark.read.parquet(log) if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else None


def outcome(log: DataFrame, keys: list[str]) -> DataFrame:
    """keys, attempts, status, value: where each item stands."""
    return log.groupBy(*keys).agg(F.max("attempt").alias("attempts"), F.max_by(F.struct("status", "value"), "attempt").alias("r")).select(*keys, "attempts", "r.*")
