"""Scans over series of any length: ranges that are summed up by themselves and then joined by what goes over their edges.

A series is cut into ranges of its order, each of a size that fits a task. A range is worked out alone and
summed up in one row: whether a run is open at its edges, how many runs it has, its last value, its first
place. The summaries, as many as ranges, are combined in order, and each range gets what comes in from the ones before. No
task sees more than a range, and nothing depends on how the ranges were cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark import scratch

_RANGE = "__range"


def ranged(df: DataFrame, keys: list[str], pos: str, ranges: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, with ``__range``: rows are dealt by ranges of (keys, ``pos``), about as many as there are partitions, or ``ranges``."""
    order = [*keys, pos]
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return scratch.written(dealt.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _inside(keys: list[str], pos: str) -> Window:
    return Window.partitionBy(*keys, _RANGE).orderBy(pos)


def _before(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(_RANGE)


def runs_of(df: DataFrame, keys: list[str], pos: str, flag: Column, ranges: int | None = None) -> DataFrame:
    """keys, start, last, next: the unbroken runs of rows with ``flag`` set; ``next`` is the place of the row after a run, null at the end of a series.

    Null flags are off. Places of a series are distinct; of rows that share one any may come first. Empty in, empty out.
    """
    rows = ranged(df.select(*keys, pos, F.coalesce(flag, F.lit(False)).alias("__on")), keys, pos, ranges)
    order = _inside(keys, pos)
    starts = (F.col("__on") & ~F.coalesce(F.lag("__on").over(order), F.lit(False))).cast("long")
    marked = rows.withColumn("__next", F.lead(pos).over(order)).withColumn("__start", starts)
    marked = marked.withColumn("__run", F.sum("__start").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    summary = marked.groupBy(*keys, _RANGE).agg(
        F.sum("__start").alias("__runs"), F.min_by("__on", pos).alias("__first_on"), F.max_by("__on", pos).alias("__last_on"), F.min(pos).alias("__first")
    )
    ahead = _before(keys)
    joins = F.col("__first_on") & F.coalesce(F.lag("__last_on").over(ahead), F.lit(False))
    summary = summary.withColumn("__joins", joins.cast("long")).withColumn("__after", F.lead("__first").over(ahead))
    earlier = F.coalesce(F.sum("__runs").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summary = summary.select(*keys, _RANGE, "__after", (earlier - F.sum("__joins").over(ahead.rowsBetween(Window.unboundedPreceding, 0))).alias("__offset"))
    local = marked.filter("__on").groupBy(*keys, _RANGE, "__run").agg(F.min(pos).alias("start"), F.max(pos).alias("last"), F.max_by(F.struct("__next"), pos).alias("n"))
    found = local.join(summary, [*keys, _RANGE]).withColumn("__id", F.col("__run") + F.col("__offset")).withColumn("next", F.coalesce("n.__next", "__after"))
    return found.groupBy(*keys, "__id").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.max_by(F.struct("next"), "last").alias("n")).select(*keys, "start", "last", F.col("n.next").alias("next"))


def scenes_of(df: DataFrame, keys: list[str], frame: str, p: str, threshold: float, ranges: int | None = None) -> DataFrame:
    """keys, start_frame, end_frame as ``sequences.scenes`` gives them, for series of any length."""
    cut = F.col(p) > threshold
    found = runs_of(df, keys, frame, ~cut, ranges).select(*keys, F.col("start").alias("start_frame"), F.coalesce("next", "last").alias("end_frame"))
    whole = df.groupBy(*keys).agg(F.min(frame).alias("start_frame"), F.max(frame).alias("end_frame"), F.count_if(~cut).alias("low"))
    return found.unionByName(whole.filter("low = 0").drop("low"))


def segments_of(df: DataFrame, keys: list[str], time: str, score: str, threshold: float, min_duration: float, ranges: int | None = None) -> DataFrame:
    """keys, start, end, duration as ``sequences.segments_above`` gives them, for series of any length."""
    found = runs_of(df, keys, time, F.col(score) >= threshold, ranges).select(*keys, "start", F.coalesce("next", "last").alias("end"))
    return found.withColumn("duration", F.col("end") - F.col("start")).filter(F.col("duration") > min_duration)


def carried(df: DataFrame, keys: list[str], pos: str, value: Column, name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the last ``value`` that was not null up to each row, for series of any length."""
    rows = ranged(df.withColumn(name, value), keys, pos, ranges)
    known = F.col(name).isNotNull()
    last = rows.filter(known).groupBy(*keys, _RANGE).agg(F.max_by(name, pos).alias("__own"))
    every = rows.select(*keys, _RANGE).distinct().join(last, [*keys, _RANGE], "left")
    brought = F.last("__own", ignorenulls=True).over(_before(keys).rowsBetween(Window.unboundedPreceding, -1))
    every = every.select(*keys, _RANGE, brought.alias("__brought"))
    upto = _inside(keys, pos).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn(name, F.last(name, ignorenulls=True).over(upto))
    return inside.join(every, [*keys, _RANGE]).withColumn(name, F.coalesce(name, "__brought")).drop(_RANGE, "__brought")


def group_numbers(df: DataFrame, keys: list[str], pos: str, gap: float, name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: rows of a series get one number until ``pos`` jumps by more than ``gap``; for series of any length."""
    rows = ranged(df, keys, pos, ranges)
    order = _inside(keys, pos)
    cut = (F.col(pos) - F.lag(pos).over(order) > gap).cast("long")
    marked = rows.withColumn("__cut", F.coalesce(cut, F.lit(0)))
    summary = marked.groupBy(*keys, _RANGE).agg(F.sum("__cut").alias("__cuts"), F.min(pos).alias("__first"), F.max(pos).alias("__last"))
    ahead = _before(keys)
    edge = F.coalesce((F.col("__first") - F.lag("__last").over(ahead) > gap).cast("long"), F.lit(0))
    summary = summary.withColumn("__edge", edge)
    earlier = F.coalesce(F.sum("__cuts").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summary = summary.select(*keys, _RANGE, (earlier + F.sum("__edge").over(ahead.rowsBetween(Window.unboundedPreceding, 0))).alias("__offset"))
    numbered = marked.withColumn(name, F.sum("__cut").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    return numbered.join(summary, [*keys, _RANGE]).withColumn(name, F.col(name) + F.col("__offset")).drop(_RANGE, "__cut", "__offset")


def asof(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str], tolerance: float | None = None, ranges: int | None = None) -> DataFrame:
    """``left`` with ``values`` and ``right_time`` of the last row of ``right`` of the same keys at or before its ``time``; nulls where there is none.

    With ``tolerance``, a row further back counts as none. Rows with a null time meet nothing, null keys meet each other as in a window. Of rows of
    ``right`` that share keys and time, the one with the largest values counts. Both sides go by ranges of (keys, time)
    in one table, and the last row of each range is carried to those after it: no key is in one task, and gaps of any length cost nothing.
    """
    rest = [c for c in left.columns if c not in (*keys, time)]
    kinds = {f.name: f.dataType for f in right.schema.fields}
    there = right.filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.max(F.struct(F.col(time).alias("right_time"), *values)).alias("__right"))
    timed = left.filter(F.col(time).isNotNull())
    here = timed.select(*keys, F.struct(F.col(time).alias("t"), F.lit(1).alias("side")).alias("__at"), F.struct(*rest, F.lit(True).alias("__row")).alias("__left"), F.lit(None).cast(there.schema["__right"].dataType).alias("__right"))
    there = there.select(*keys, F.struct(F.col(time).alias("t"), F.lit(0).alias("side")).alias("__at"), F.lit(None).cast(here.schema["__left"].dataType).alias("__left"), "__right")
    met = carried(here.unionByName(there), keys, "__at", F.col("__right"), "__met", ranges).filter("__left IS NOT NULL")
    near = F.lit(True) if tolerance is None else F.col("__at.t") - F.col("__met.right_time") <= tolerance
    found = met.select(*keys, F.col("__at.t").alias(time), *[F.col(f"__left.`{c}`").alias(c) for c in rest], *[F.when(near, F.col(f"__met.`{c}`")).alias(c) for c in ("right_time", *values)])
    untimed = left.filter(F.col(time).isNull()).select(*found.columns[: len(keys) + 1 + len(rest)], F.lit(None).cast(kinds[time]).alias("right_time"), *[F.lit(None).cast(kinds[v]).alias(v) for v in values])
    return found.unionByName(untimed)
