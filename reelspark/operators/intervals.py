"""Joins of intervals: what overlaps, by how much, and what that says about the speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.operators.ranking import first_rows, ranked


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    zero = F.lit(0)
    return F.greatest(zero, F.least(e1, e2) - F.greatest(s1, s2))


#: Slots of a level are so many times as wide as those of the level below.
_STEP = 4


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose [start, end) overlap; columns of the right get ``r_``.

    Rows meet on (keys, level, slot), so no key's rows are compared with all others and a hot key is spread over its slots. An interval is
    on the lowest level whose slots (of ``width`` on level 0, on each further one four times as wide) are as long as itself, so it touches two of them at most, however
    long it is. It goes to its own level and those above, as far as there are any, and a pair meets on the higher of its two
    levels, in the first slot that both touch. Empty intervals overlap nothing.
    """
    names = {c: c if c in keys else f"r_{c}" for c in right.columns}
    level = lambda s, e: F.greatest(F.lit(0), F.ceil(F.log((e - s) / width) / F.log(F.lit(float(_STEP))) - 1e-9)).cast("int")
    a = left.filter("end > start").withColumn("__own", level(F.col("start"), F.col("end")))
    b = right.filter("end > start").withColumn("__own", level(F.col("start"), F.col("end")))
    top = a.select("__own").union(b.select("__own")).agg(F.max("__own")).first()[0] or 0
    wide = lambda at: F.lit(float(width)) * F.pow(F.lit(float(_STEP)), at)

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("__level", F.explode(F.sequence("__own", F.lit(top))) if top else F.lit(0))
        at = wide(F.col("__level"))
        return rows.withColumn("__slot", F.explode(F.sequence(F.floor(F.col("start") / at), F.floor((F.col("end") - 1e-9) / at))))

    b = dealt(b).select(*[F.col(c).alias(n) for c, n in names.items()], F.col("__own").alias("__other"), "__level", "__slot")
    near = dealt(a).join(b, [*keys, "__level", "__slot"])
    first = F.floor(F.greatest("start", "r_start") / wide(F.col("__level")))
    meets = (F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))
    return near.filter(meets & (F.col("__level") == F.greatest("__own", "__other")) & (F.col("__slot") == first)).drop("__own", "__other", "__level", "__slot")


def frames_of_shots(shots: DataFrame, frames: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Rows of ``frames`` (keys, frame and more) with start_frame and end_frame of each shot that holds them; rows meet on slots of ``width``."""
    a = frames.withColumn("__slot", F.floor(F.col("frame") / width))
    held = shots.filter("end_frame > start_frame")
    b = held.select(*keys, "start_frame", "end_frame", F.explode(F.sequence(F.floor(F.col("start_frame") / width), F.floor((F.col("end_frame") - 1) / width))).alias("__slot"))
    return a.join(b, [*keys, "__slot"]).filter("start_frame <= frame AND frame < end_frame").drop("__slot")


def overlap_by_track(cues: DataFrame, segments: DataFrame, clip: str, cue: str, track: str, width: int = 10, lowest: int = 2) -> DataFrame:
    """clip, cue, track, overlap: for every cue the tracks that share time with it, and at 0 the ``lowest`` tracks of its clip that share none.

    So the first ``lowest`` tracks of a ranking by overlap, then number, are there, without every cue meeting every track.
    ``cues``: clip, cue, start, end; ``segments``: clip, track, start, end; they meet on slots of ``width``.
    """
    first = first_rows(segments.select(clip, track).distinct(), [clip], [F.col(track)], lowest)
    pairs = cues.select(clip, cue).join(first, clip)
    shared = interval_join(cues.select(clip, cue, "start", "end"), segments.select(clip, track, "start", "end"), [clip], width)
    shared = shared.select(clip, cue, F.col(f"r_{track}").alias(track), overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end")).alias("o"))
    zero = F.lit(0).cast(shared.schema["o"].dataType).alias("o")
    return shared.unionByName(pairs.select(clip, cue, track, zero)).groupBy(clip, cue, track).agg(F.sum("o").alias("overlap"))


def assigned(cues: DataFrame, by_track: DataFrame, clip: str, cue: str, track: str, min_overlap: float, min_ratio: float) -> DataFrame:
    """Cues with their best track, or none if they share less than ``min_overlap`` or at most ``min_ratio`` of their time.

    Ties go to the lower track. Adds track, overlap, ratio, unknown.
    """
    best = first_rows(by_track, [clip, cue], [F.col("overlap").desc(), F.col(track)])
    out = cues.join(best, [clip, cue], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0)))
    span = F.col("end") - F.col("start")
    out = out.withColumn("ratio", F.when(span > 0, F.col("overlap") / span).otherwise(F.lit(0.0)))
    unknown = F.col(track).isNull() | (F.col("overlap") < min_overlap) | (F.col("ratio") <= min_ratio)
    return out.withColumn("unknown", unknown).withColumn(track, F.when(~F.col("unknown"), F.col(track)))


def top_tracks(by_track: DataFrame, clip: str, cue: str, track: str, n: int = 2) -> DataFrame:
    """The ``n`` tracks that share most with each cue, tracks that share nothing included, with their rank."""
    return ranked(by_track, [clip, cue], [F.col("overlap").desc(), F.col(track)]).filter(F.col("rank") <= n)


def word_vote(votes: DataFrame, clip: str, cue: str, tag: str) -> DataFrame:
    """clip, cue, tag, ratio: the tag with most overlap among a cue's words.

    ``votes``: one row a word: clip, cue, word (its number), tag (UNK included), overlap > 0. The
    ratio is to the overlap of all words. Ties go to the tag that voted first.
    """
    sums = votes.groupBy(clip, cue, tag).agg(F.sum("overlap").alias("votes"), F.min("word").alias("first_word"))
    total = votes.groupBy(clip, cue).agg(F.sum("overlap").alias("total"))
    best = first_rows(sums, [clip, cue], [F.col("votes").desc(), F.col("first_word")])
    return best.join(total, [clip, cue]).select(clip, cue, tag, (F.col("votes") / F.col("total")).alias("ratio"))


def active_at(times: DataFrame, cues: DataFrame, clip: str, time: str, width: int) -> DataFrame:
    """Pairs of a time and the cues active then, both ends included; rows meet on slots of ``width``."""
    a = times.withColumn("__slot", F.floor(F.col(time) / width))
    b = cues.withColumn("__slot", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    return a.join(b, [clip, "__slot"]).filter(F.col(time).between(F.col("start"), F.col("end"))).drop("__slot")
