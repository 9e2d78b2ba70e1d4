"""Models that see a window of a series: overlapping windows with a halo, and their results stitched together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(series: DataFrame, keys: list[str], pos: str, value: str, annotate: Callable[[Column], Column], window: int, halo: int, name: str) -> DataFrame:
    """keys, ``pos``, ``name``, error: what a model says of each place, from windows of ``window`` places.

    Places are whole numbers. A window overlaps its neighbours by ``halo`` at both ends, and only what the model says of the places between is kept, so that
    every kept place has been seen with ``halo`` places on either side, as far as the series has them. ``annotate`` is a registered
    annotator of an array of values that returns an array of as many results; it is loaded once a task and gets many windows at once.

    A place that is missing is missing in its window. A failing window gives its places a null and the error; so does one that
    returns another number of results than it got values. Null values are passed on. Empty in, empty out.
    """
    own = window - 2 * halo
    if own < 1:
        raise ValueError(f"a halo of {halo} on both sides leaves nothing of a window of {window}")
    first, last = (F.floor((F.col(pos) + k) / own).cast("long") for k in (-halo, halo))
    dealt = series.select(*keys, F.col(pos).cast("long").alias("p"), F.col(value).alias("v")).withColumn(pos, F.col("p"))
    dealt = dealt.withColumn("w", F.explode(F.sequence(first, last))).drop(pos)
    windows = dealt.groupBy(*keys, "w").agg(F.array_sort(F.collect_list(F.struct("p", "v"))).alias("rows"))
    said = windows.withColumn("said", annotate(F.transform("rows", lambda r: r["v"])))
    fits = F.coalesce(F.size("said.value") == F.size("rows"), F.lit(False))
    error = F.when(~fits, F.coalesce("said.error", F.lit("another number of results than values")))
    pairs = F.transform("rows", lambda r, k: F.struct(r["p"].alias("p"), F.when(fits, F.get("said.value", k)).alias("x")))
    kept = F.filter(pairs, lambda r: F.floor(r["p"] / own) == F.col("w"))
    return said.select(*keys, error.alias("error"), F.inline(kept)).select(*keys, F.col("p").alias(pos), F.col("x").alias(name), "error")
