"""Screening of clips by sampled frames, with an early stop, and filters of what detectors find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Area from which a text box counts, a detector's class of persons and its least confidence.
TEXT_AREA, PERSON_CLASS, PERSON_SCORE = 200, 1, 0.5


def is_text_box(area: Column, least: float = TEXT_AREA) -> Column:
    return area > least


def is_person(label: Column, score: Column, least: float = PERSON_SCORE) -> Column:
    return (label == PERSON_CLASS) & (score >= least)


def any_hit(samples: DataFrame, keys: list[str], sample: str, hit: Column, min_hits: int = 1) -> DataFrame:
    """keys, found, sampled, hits, ratio: whether ``min_hits`` samples are hits, and what a scan that stops at the last of them reports.

    A scan that stops early has seen ``sampled`` samples and reports a ratio of 1; else all, and the share of hits in thousandths.
    """
    order = Window.partitionBy(*keys).orderBy(sample)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = samples.withColumn("__hit", F.coalesce(hit, F.lit(False)).cast("long"))
    rows = rows.withColumn("__hits", F.sum("__hit").over(upto)).withColumn("__nth", F.row_number().over(order).cast("long"))
    each = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("all"), F.sum("__hit").alias("all_hits"), F.min(F.when(F.col("__hits") >= min_hits, F.col("__nth"))).alias("stop")
    )
    found = F.col("stop").isNotNull()
    return each.select(
        *keys, found.alias("found"), F.coalesce("stop", "all").alias("sampled"), F.when(found, F.lit(min_hits).cast("long")).otherwise(F.col("all_hits")).alias("hits"),
        F.when(found, F.lit(1.0)).otherwise(F.round(F.col("all_hits") / F.col("all"), 3)).alias("ratio"),
    )
