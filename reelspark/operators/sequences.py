"""Operators on series: rows with keys, a position and a value.

Windows are by series key, so a series is one group; series are clips and tracks, of bounded length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, keys: list[str], pos: str, flag: Column) -> DataFrame:
    """Rows with ``flag`` set, and ``run``: a number that rows of one unbroken run share."""
    order = Window.partitionBy(*keys).orderBy(pos)
    starts = (F.col("__on") & ~F.coalesce(F.lag("__on").over(order), F.lit(False))).cast("int")
    marked = df.withColumn("__on", F.coalesce(flag, F.lit(False))).withColumn("__start", starts)
    return marked.withColumn("run", F.sum("__start").over(order.rowsBetween(Window.unboundedPreceding, 0))).filter("__on").drop("__on", "__start")


def scenes(df: DataFrame, keys: list[str], frame: str, p: str, threshold: float, drop_last: bool = False) -> DataFrame:
    """keys, start_frame, end_frame of the stretches between transitions (p > ``threshold``).

    A stretch ends at the frame of the next transition, or at the last frame. A series of
    transitions only is one scene. ``drop_last``: without the scene that reaches the end, if there
    are several.
    """
    order = Window.partitionBy(*keys).orderBy(frame)
    whole = df.groupBy(*keys).agg(F.min(frame).alias("first"), F.max(frame).alias("last"), F.count_if(~(F.col(p) > threshold)).alias("low"))
    ahead = df.withColumn("__next", F.lead(frame).over(order))
    found = runs(ahead, keys, frame, ~(F.col(p) > threshold)).groupBy(*keys, "run").agg(
        F.min(frame).alias("start_frame"), F.coalesce(F.max("__next"), F.max(frame)).alias("end_frame"), F.max(frame).alias("own_last")
    )
    # A run that ends before the series does ends at the transition after it; max("__next") is that frame.
    found = found.join(whole.select(*keys, "last"), keys).withColumn("tail", F.col("own_last") == F.col("last"))
    found = found.withColumn("end_frame", F.when(F.col("tail"), F.col("last")).otherwise(F.col("end_frame")))
    if drop_last:
        found = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter(~F.col("tail") | (F.col("n") == 1))
    only = whole.filter("low = 0").select(*keys, F.col("first").alias("start_frame"), F.col("last").alias("end_frame"))
    return found.select(*keys, "start_frame", "end_frame").unionByName(only)


def scenes_by_windows(df: DataFrame, keys: list[str], frame: str, p: str, threshold: float, window: int, min_frames: int = 0) -> DataFrame:
    """keys, start_frame, end_frame of the scenes that a scan in windows of ``window`` frames writes down.

    Such a scan carries the last scene of a window over to the next, so scenes are those of the whole series. It never writes
    the last one if that began in the last window, after others, or if the last window is full: then nothing follows that would
    end it. Scenes shorter than ``min_frames`` go. Frames are numbered from 0.
    """
    found = scenes(df, keys, frame, p, threshold)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    ends = found.groupBy(*keys).agg(F.max("start_frame").alias("__last"), F.count(F.lit(1)).alias("__scenes")).join(n, keys)
    full = F.col("__n") % window == 0
    began = (F.col("__last") >= F.floor(F.col("__n") / window) * window) & (F.col("__scenes") > 1)
    ends = ends.select(*keys, F.when(full | began, F.col("__last")).alias("__unwritten"))
    kept = found.join(ends, keys).filter(~F.col("start_frame").eqNullSafe(F.col("__unwritten")) & (F.col("end_frame") - F.col("start_frame") >= min_frames))
    return kept.select(*keys, "start_frame", "end_frame")


def min_scene_frames(seconds: float, fps: float = 25.0) -> int:
    """Frames that a scene of a clip needs."""
    return max(1, round(fps * seconds))


def content_cuts(df: DataFrame, keys: list[str], frame: str, value: str, threshold: float) -> DataFrame:
    """keys, start_frame, end_frame of stretches between frames whose ``value`` changes by more than ``threshold``; ends are exclusive."""
    order = Window.partitionBy(*keys).orderBy(frame)
    cut = F.coalesce(F.abs(F.col(value) - F.lag(value).over(order)) > threshold, F.lit(True)).cast("long")
    marked = df.withColumn("__cut", cut).withColumn("__scene", F.sum("__cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "__scene").agg(F.min(frame).alias("start_frame"), (F.max(frame) + 1).alias("end_frame")).drop("__scene")


def sized_tracks(boxes: DataFrame, keys: list[str], frame: str, min_size: float = 1.0, min_frames: int = 1) -> DataFrame:
    """keys, frames, width, height: of tracks (frame, x1, y1, x2, y2) filled between their frames, those whose mean width or height is above ``min_size``.

    ``min_frames`` counts the frames before filling.
    """
    known = boxes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__known"))
    filled = interpolated(boxes, keys, frame, ["x1", "y1", "x2", "y2"])
    mean = filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"), F.avg(F.col("x2") - F.col("x1")).alias("width"), F.avg(F.col("y2") - F.col("y1")).alias("height"))
    return mean.join(known, keys).filter((F.col("__known") >= min_frames) & (F.greatest("width", "height") > min_size)).drop("__known")


def zipped(left: Column, right: Column) -> Column:
    """Pairs (a, b) of two arrays by place, as many as the shorter one has."""
    n = F.least(F.size(left), F.size(right))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, 1, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def segments_above(df: DataFrame, keys: list[str], time: str, score: str, threshold: float, min_duration: float) -> DataFrame:
    """keys, start, end, duration of runs with score >= ``threshold`` that last longer than ``min_duration``.

    A run ends at the time of the first row below, or at its last row where the series ends.
    """
    order = Window.partitionBy(*keys).orderBy(time)
    ahead = df.withColumn("__next", F.lead(time).over(order))
    found = runs(ahead, keys, time, F.col(score) >= threshold).groupBy(*keys, "run").agg(
        F.min(time).alias("start"), F.max(F.coalesce("__next", time)).alias("end")
    )
    return found.withColumn("duration", F.col("end") - F.col("start")).filter(F.col("duration") > min_duration).drop("run")


def interpolated(df: DataFrame, keys: list[str], frame: str, values: list[str], max_gap: int | None = None) -> DataFrame:
    """Every frame between known ones, with values on the straight line; gaps over ``max_gap`` stay open."""
    order = Window.partitionBy(*keys).orderBy(frame)
    nxt = F.lead(frame).over(order)
    ahead = df.select(*keys, frame, *values, nxt.alias("__to"), *[F.lead(v).over(order).alias(f"__{v}") for v in values])
    last = F.col(frame) if max_gap is None else F.when(F.col("__to") - F.col(frame) <= max_gap, F.col("__to") - 1)
    upto = F.coalesce(F.col("__to") - 1 if max_gap is None else last, F.col(frame))
    filled = ahead.withColumn("__at", F.explode(F.sequence(F.col(frame), upto)))
    share = (F.col("__at") - F.col(frame)) / (F.col("__to") - F.col(frame))
    line = [F.when(F.col("__at") == F.col(frame), F.col(v)).otherwise(F.col(v) + (F.col(f"__{v}") - F.col(v)) * share).alias(v) for v in values]
    return filled.select(*keys, F.col("__at").alias(frame), *line)


def median_filter(df: DataFrame, keys: list[str], pos: str, value: str, width: int = 13, name: str = "median") -> DataFrame:
    """The middle of ``width`` values around each row; places outside the series count as zero."""
    half = width // 2
    around = F.collect_list(value).over(Window.partitionBy(*keys).orderBy(pos).rowsBetween(-half, half))
    padded = F.concat(around, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(around)))
    return df.withColumn(name, F.element_at(F.array_sort(padded), half + 1))


def carried_forward(df: DataFrame, keys: list[str], pos: str, value: Column, name: str) -> DataFrame:
    """The last value that was not null up to each row."""
    upto = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(upto))


def unit_vector(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: x / F.greatest(norm, F.lit(1e-12)))


def neighbour_similarity(df: DataFrame, keys: list[str], frame: str, feature: str, reach: int) -> DataFrame:
    """keys, frame, offset, similarity of every frame with those up to ``reach`` before and after.

    A series is cut into blocks of at least 64 frames; the first ``reach`` of a block also go to the one before, so a vector
    moves little more than once and a series is spread over its blocks. A block is one matrix product; each
    pair is found in the block of its earlier frame, and gives both its offsets. Frames outside have no row.
    """
    size = max(64, 8 * reach)
    at = F.col(frame).cast("long")
    block = F.floor(at / size).cast("long")
    both = F.when(at - block * size < reach, F.array(block - 1, block)).otherwise(F.array(block))
    unit = df.select(*keys, at.alias("frame"), unit_vector(F.col(feature)).alias("v"), F.explode(both).alias("block"))
    kept = [f for f in unit.schema.fields if f.name in keys]

    def multiply(group: pa.Table) -> pa.Table:
        frames = group["frame"].combine_chunks().to_numpy()
        v = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(frames), -1)
        own = np.flatnonzero(frames // size == group["block"][0].as_py())
        later = frames[None, :] - frames[own, None]
        a, b = np.nonzero((later >= 0) & (later <= reach))
        found, offset = (v[own] @ v.T)[a, b], later[a, b]
        ahead = offset > 0  # the pair seen from the later frame
        where = np.concatenate((own[a], b[ahead]))
        columns = [group[k].combine_chunks().take(pa.array(where)) for k in keys]
        columns += [pa.array(x) for x in (frames[where], np.concatenate((offset, -offset[ahead])), np.concatenate((found, found[ahead])))]
        return pa.Table.from_arrays(columns, [*keys, "frame", "offset", "similarity"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "frame long, offset long, similarity double"])
    return unit.groupBy(*keys, "block").applyInArrow(multiply, schema)


def similarity_lookup(df: DataFrame, keys: list[str], frame: str, feature: str, reach: int) -> DataFrame:
    """keys, frame, similarities: an array of 2 ``reach`` + 1 values a frame, 0 where there is no frame."""
    found = neighbour_similarity(df, keys, frame, feature, reach)
    near = found.groupBy(*keys, "frame").agg(F.map_from_entries(F.collect_list(F.struct("offset", "similarity"))).alias("m"))
    offsets = F.sequence(F.lit(-reach).cast("long"), F.lit(reach).cast("long"))
    return near.select(*keys, "frame", F.transform(offsets, lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0.0))).alias("similarities"))


def colour_histogram(df: DataFrame, keys: list[str], r: str, g: str, b: str) -> DataFrame:
    """keys, bin, share: three bits a channel, 512 bins, counts divided by their Euclidean norm."""
    code = F.shiftleft(F.shiftright(r, 5), 6) + F.shiftleft(F.shiftright(g, 5), 3) + F.shiftright(b, 5)
    counts = df.withColumn("bin", code).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    norm = F.sqrt(F.sum(F.col("n") * F.col("n")).over(Window.partitionBy(*keys)).cast("double"))
    return counts.select(*keys, "bin", (F.col("n") / norm).alias("share"))


def multiscale_mean(df: DataFrame, keys: list[str], pos: str, score: str, seconds: list[int], rate: int = 25) -> DataFrame:
    """keys, pos, score: for each length, the mean of the row's chunk of that many seconds; then the mean over lengths. Round with ``tenths``."""
    each = df.select(*keys, pos, score, F.explode(F.array(*[F.lit(s) for s in seconds])).alias("seconds"))
    chunk = each.withColumn("chunk", F.floor(F.col(pos) / (F.col("seconds") * rate)))
    mean = chunk.withColumn("mean", F.avg(score).over(Window.partitionBy(*keys, "seconds", "chunk")))
    return mean.groupBy(*keys, pos).agg(F.avg("mean").alias(score))


def tenths(score: Column) -> Column:
    """Tenths by half even."""
    return F.bround(score, 1)
