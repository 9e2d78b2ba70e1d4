"""Stages as streaming queries.

The file source's checkpoint remembers what it has listed, so nothing is taken twice and a restart
goes on where the last run stopped; output tables are met by an anti-join, so work that another
run finished is not done again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelspark.operators.resume import pending


def watch(spark: SparkSession, folder: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def run_stage(
    items: DataFrame, keys: list[str], output: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], schema: str, every: str | None = None
) -> StreamingQuery:
    """A query that appends ``work`` of new items to the table ``output``; items that are there already are left out.

    ``every``: polling interval; None takes what is there and ends. A batch that is run again after
    a failure finds its own rows in ``output``, so nothing is appended twice.
    """

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        empty = spark.createDataFrame([], schema)
        done = spark.read.schema(schema).parquet(output) if _exists(spark, output) else empty
        work(pending(df, done, keys).dropDuplicates(keys)).write.mode("append").parquet(output)

    writer = items.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def with_status(result: Column, error: Column, on_failure: str = "FAILED") -> Column:
    """Status of an item: COMPLETED, or how its stage treats failures."""
    return F.when(error.isNull() & result.isNotNull(), F.lit("COMPLETED")).otherwise(F.lit(on_failure))


def running_counts(items: DataFrame, group: str, checkpoint: str, name: str) -> StreamingQuery:
    """Counts a group in the in-memory table ``name``, kept by the stream's state."""
    counts = items.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, group: str, width: str, late: str) -> DataFrame:
    """Counts and sums by tumbling windows of event time; rows later than ``late`` are left out."""
    timed = events.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", late)
    return timed.groupBy(F.window("__time", width).alias("window"), group).agg(F.count(F.lit(1)).alias("n"))


def run_chain(
    spark: SparkSession, first: str, schema: str, keys: list[str], base: str, chain: list[tuple[str, Callable[[DataFrame], DataFrame]]], goes_on: tuple[str, ...] = ("COMPLETED",)
) -> dict[str, str]:
    """Stages one after the other, each a streaming query over the table of the one before; gives the table of each.

    ``first`` is the folder of items with ``schema``. A stage's function adds ``status`` to its items; those with a status in
    ``goes_on`` are the next one's items. Every stage keeps its own checkpoint and table below ``base``, so a chain that is
    run again takes up what is new and nothing else.
    """
    source, columns, tables = first, schema, {}
    for name, work in chain:
        items = watch(spark, source, columns)
        if source != first:
            items = items.filter(F.col("status").isin(*goes_on)).drop("status")
        out = f"{base}/{name}"
        spark.createDataFrame([], f"{schema}, status string").write.mode("ignore").parquet(out)
        run_stage(items, keys, out, f"{base}/{name}-checkpoint", work, f"{schema}, status string").awaitTermination()
        source, columns, tables[name] = out, f"{schema}, status string", out
    return tables
