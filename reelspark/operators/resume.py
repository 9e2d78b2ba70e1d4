"""What is left to do, what is complete, and who does it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark import scratch

#: Statuses after which a stage leaves an item alone.
FINAL = ("COMPLETED", "NO_TRACKABLE_FACE", "NO_VALID_TRACK", "NO_VALID_SPEAKER")


def pending(inputs: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without an output."""
    return inputs.join(outputs.select(*keys).distinct(), keys, "left_anti")


def last_per_key(records: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Of each key the record that stands last; a map-side combinable maximum, no sort."""
    rest = [c for c in records.columns if c not in (*keys, pos)]
    best = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(pos)).alias("r"), F.max(pos).alias(pos))
    return best.select(*keys, pos, "r.*")


def merged(cached: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New records, and the cached ones that they do not replace."""
    return new.unionByName(cached.join(new.select(*keys).distinct(), keys, "left_anti"))


def barrier(items: DataFrame, keys: list[str], done: Column, upstream_done: Column | None = None) -> DataFrame:
    """keys, items, open_items, complete: complete if every item, and what is upstream, is done."""
    up = upstream_done if upstream_done is not None else F.lit(True)
    return items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(~F.coalesce(done, F.lit(False))).alias("open_items"),
        F.bool_and(F.coalesce(done & up, F.lit(False))).alias("complete"),
    )


def numbered(df: DataFrame, order: list[Column], total: str | None = None) -> DataFrame:
    """``number``, the 0-based place in the whole order, and the number of all rows under the name ``total``, if one is given.

    Rows are dealt by ranges of the order into a table in the shared folder; each range is numbered by itself and
    begins after the counts of those before it. What one task sees of all is a row a range.
    """
    placed = scratch.written(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "numbered")
    counts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias(total or "__total"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return placed.join(offsets, "__range").withColumn("number", F.col("__before") + inside).drop("__range", "__before", "__total")


def contiguous_worker(number: Column, count: Column, workers: int) -> Column:
    """Worker of an item where each takes a run of ceil(count / workers)."""
    return F.floor(number / F.ceil(count / F.lit(workers)))


def strided_worker(number: Column, workers: int) -> Column:
    return F.pmod(number, F.lit(workers))


def next_stage(items: DataFrame, log: DataFrame, keys: list[str], stages: list[str], pos: str = "pos", final: tuple[str, ...] = FINAL) -> DataFrame:
    """``items`` with ``next``: the first of ``stages`` whose last status in ``log`` (keys, stage, status, ``pos``) is none of ``final``; null when all are through."""
    last = last_per_key(log.select(*keys, "stage", "status", pos), [*keys, "stage"], pos)
    through = last.filter(F.col("status").isin(*final)).groupBy(*keys).agg(F.collect_set("stage").alias("__through"))
    out = items.join(through, keys, "left")
    open_ = F.filter(F.array(*[F.lit(s) for s in stages]), lambda s: ~F.array_contains(F.coalesce("__through", F.array().cast("array<string>")), s))
    return out.withColumn("next", F.get(open_, 0)).drop("__through")
