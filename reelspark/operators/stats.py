"""Statistics of clips by movie and over all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Speakers that stand for no one known.
UNKNOWN = ("UNKNOWN", "UNK")


def dialogue_summary(segments: DataFrame, clip: str) -> DataFrame:
    """clip, has_dialogue, speakers: any text that is not blank; distinct speakers that have a name."""
    return segments.groupBy(clip).agg(
        F.bool_or(F.trim(F.coalesce("text", F.lit(""))) != "").alias("has_dialogue"), F.count_distinct(F.when(F.col("speaker") != "", F.col("speaker"))).alias("speakers")
    )


def aligned_summary(lines: DataFrame, clip: str) -> DataFrame:
    """clip, speakers (known, distinct), unknown_lines, lines, all_matched."""
    unknown = (F.col("tag") == "UNK") | F.coalesce(F.col("speaker").isin(*UNKNOWN), F.lit(False))
    return lines.groupBy(clip).agg(
        F.count_distinct(F.when(~unknown, F.coalesce("speaker", "tag"))).alias("speakers"),
        F.count_if(unknown).alias("unknown_lines"), F.count(F.lit(1)).alias("lines"), (F.count_if(unknown) == 0).alias("all_matched"),
    )


def movie_stats(clips: DataFrame, dialogue: DataFrame) -> DataFrame:
    """One row a movie from clips (movie, clip, duration or null, has_person, has_text) and dialogue (clip, has_dialogue, speakers).

    Averages are over clips whose name tells a duration; a movie without any has 0 for the lot.
    """
    rows = clips.join(dialogue, "clip", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    is_true, is_false, unknown = (lambda c: F.col(c)), (lambda c: ~F.col(c)), (lambda c: F.col(c).isNull())
    return rows.groupBy("movie").agg(
        F.count(F.lit(1)).alias("clips"),
        F.round(zero(F.sum("duration")), 4).alias("seconds"), F.round(zero(F.avg("duration")), 4).alias("mean_seconds"),
        F.round(zero(F.min("duration")), 4).alias("min_seconds"), F.round(zero(F.max("duration")), 4).alias("max_seconds"),
        F.count_if(is_true("has_person")).alias("with_person"), F.count_if(is_false("has_person")).alias("without_person"), F.count_if(unknown("has_person")).alias("person_unknown"),
        F.count_if(is_true("has_text")).alias("with_text"), F.count_if(is_false("has_text")).alias("without_text"), F.count_if(unknown("has_text")).alias("text_unknown"),
        F.count_if(F.col("has_dialogue")).alias("with_dialogue"), F.coalesce(F.sum("speakers"), F.lit(0)).alias("speaker_clips"),
    )


def global_stats(by_movie: DataFrame) -> DataFrame:
    """One row over all movies; the mean is over all clips, parsed or not."""
    return by_movie.agg(
        F.count(F.lit(1)).alias("movies"), F.sum("clips").alias("clips"), F.round(F.sum("seconds"), 2).alias("seconds"), F.round(F.try_divide(F.sum("seconds"), F.sum("clips")), 4).alias("mean_seconds"),
        F.min("min_seconds").alias("min_seconds"), F.max("max_seconds").alias("max_seconds"), F.sum("with_dialogue").alias("with_dialogue"),
    )


def rolled_up(rows: DataFrame, levels: list[str], value: str, measure: str) -> DataFrame:
    """levels, level, rows, total, distribution: over each of ``levels`` in turn, the first alone, and all rows.

    ``level`` is the number of levels summed over (null levels of the data are told from those by it), ``total`` the sum of ``measure`` and
    ``distribution`` the map of counts by ``value``, in order; a null value is no entry. Rows are first counted by levels and value, so the one
    expansion, to all levels, is of those counts; maps of higher levels are merged by adding counts of equal keys.
    """
    base = rows.groupBy(*levels, value).agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias("s"))
    sets = [[*map(F.col, levels[:k]), F.col(value)] for k in range(len(levels), -1, -1)]
    merged = base.groupingSets(sets, *levels, value).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.grouping_id().alias("id"))
    counts = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(value, "n"))))
    out = merged.groupBy(*levels, "id").agg(F.sum("n").alias("rows"), F.sum("s").alias("total"), F.map_from_entries(counts).alias("distribution"))
    return out.select(*levels, F.bit_count("id").cast("long").alias("level"), "rows", "total", "distribution")
