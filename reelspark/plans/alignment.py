"""Queries that bring subtitles, words, speakers, faces and bodies together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import boxes as bx
from reelspark.functions.texts import display_text, track_tag
from reelspark.operators import intervals as iv
from reelspark.operators.ranking import first_rows
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query

_BY_TRACK = f"""WITH {st.CUES}, {st.SEGMENTS},
tracks AS (SELECT DISTINCT clip, turn FROM segments),
by_track AS (
  SELECT c.clip, c.cue, t.turn AS track, CAST(coalesce(sum(greatest(0, least(c."end", s."end") - greatest(c."start", s."start"))), 0) AS BIGINT) AS overlap
  FROM cues c JOIN tracks t ON t.clip = c.clip JOIN segments s ON s.clip = c.clip AND s.turn = t.turn GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY clip, cue ORDER BY overlap DESC, track) AS place FROM by_track),
asg AS (SELECT c.clip, c.cue, c."start", c."end", b.overlap, b.overlap/(c."end"-c."start") AS ratio,
  CASE WHEN b.overlap < 5 OR b.overlap/(c."end"-c."start") <= 0.2 THEN NULL ELSE b.track END AS track FROM cues c JOIN best b ON b.clip = c.clip AND b.cue = c.cue AND b.place = 1)
"""


def _by_track(spark: SparkSession, d: str) -> DataFrame:
    segments = st.segments(spark, d).select("clip", F.col("turn").alias("track"), "start", "end")
    return iv.overlap_by_track(st.cues(spark, d), segments, "clip", "cue", "track", 200)


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    return iv.assigned(st.cues(spark, d), _by_track(spark, d), "clip", "cue", "track", 5, 0.2)


@query(_BY_TRACK + "SELECT clip, cue, overlap, round(ratio, 6) AS ratio, CASE WHEN track IS NULL THEN 'UNK' ELSE 'T' || lpad(CAST(track AS VARCHAR), 2, '0') END AS tag FROM asg")
def overlap_assign(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d).select("clip", "cue", "overlap", F.round("ratio", 6).alias("ratio"), track_tag(F.col("track")).alias("tag"))


@query(_BY_TRACK + "SELECT clip, cue, track, overlap, place AS rank FROM best WHERE place <= 2")
def top2_candidates(spark: SparkSession, d: str) -> DataFrame:
    return iv.top_tracks(_by_track(spark, d), "clip", "cue", "track").select("clip", "cue", "track", "overlap", F.col("rank").cast("long"))


_VOTES = f"""WITH {st.CUES}, {st.WORDS}, {st.SEGMENTS},
votes AS (
  SELECT c.clip, c.cue, w.word, s.speaker AS tag, least(c."end", w."end") - greatest(c."start", w."start") AS overlap
  FROM cues c JOIN words w ON w.clip = c.clip AND w."start" < c."end" AND c."start" < w."end"
  JOIN segments s ON s.clip = w.clip AND w."start" >= s."start" AND w."start" < s."end"),
v AS (SELECT clip, cue, tag, sum(overlap) AS votes, min(word) AS first_word FROM votes GROUP BY ALL),
k AS (SELECT *, sum(votes) OVER (PARTITION BY clip, cue) AS total, row_number() OVER (PARTITION BY clip, cue ORDER BY votes DESC, first_word) AS place FROM v),
vote AS (SELECT clip, cue, tag, votes/total AS ratio FROM k WHERE place = 1)
"""


def _vote(spark: SparkSession, d: str) -> DataFrame:
    words, segments = st.words(spark, d), st.segments(spark, d).select("clip", "speaker", "start", "end")
    heard = iv.active_at(words.withColumnRenamed("start", "at").withColumnRenamed("end", "till"), segments, "clip", "at", 500).filter(F.col("at") < F.col("end"))
    heard = heard.select("clip", "word", F.col("at").alias("start"), F.col("till").alias("end"), F.col("speaker").alias("tag"))
    pairs = iv.interval_join(st.cues(spark, d), heard, ["clip"], 200)
    votes = pairs.select("clip", "cue", F.col("r_word").alias("word"), F.col("r_tag").alias("tag"), iv.overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end")).alias("overlap"))
    return iv.word_vote(votes, "clip", "cue", "tag")


@query(_VOTES + "SELECT clip, cue, tag, round(ratio, 6) AS ratio FROM vote")
def word_vote(spark: SparkSession, d: str) -> DataFrame:
    return _vote(spark, d).withColumn("ratio", F.round("ratio", 6))


@query(_BY_TRACK.rstrip() + _VOTES.replace(f"WITH {st.CUES}, {st.WORDS}, {st.SEGMENTS}", f", {st.WORDS}", 1) + """
SELECT a.clip, a.cue, a.overlap, CASE WHEN v.ratio > 0.5 THEN v.tag ELSE CASE WHEN a.track IS NULL THEN 'UNK' ELSE 'T' || lpad(CAST(a.track AS VARCHAR), 2, '0') END END AS tag,
  round(CASE WHEN v.ratio > 0.5 THEN v.ratio ELSE a.ratio END, 6) AS confidence, CASE WHEN v.ratio > 0.5 THEN 'word_vote' ELSE 'overlap' END AS source,
  (CASE WHEN v.ratio > 0.5 THEN v.tag ELSE CASE WHEN a.track IS NULL THEN 'UNK' ELSE 'T' || lpad(CAST(a.track AS VARCHAR), 2, '0') END END) || ': cue ' || a.cue AS display_text
FROM asg a LEFT JOIN vote v ON v.clip = a.clip AND v.cue = a.cue""")
def aligned_subtitles(spark: SparkSession, d: str) -> DataFrame:
    """Cues with the speaker by overlap, unless more than half of their words' time says another."""
    vote = _vote(spark, d).select("clip", "cue", F.col("tag").alias("voted"), F.col("ratio").alias("vote"))
    both = _assigned(spark, d).join(vote, ["clip", "cue"], "left")
    wins = F.coalesce(F.col("vote") > 0.5, F.lit(False))
    tag = F.when(wins, F.col("voted")).otherwise(track_tag(F.col("track")))
    return both.select(
        "clip", "cue", "overlap", tag.alias("tag"), F.round(F.when(wins, F.col("vote")).otherwise(F.col("ratio")), 6).alias("confidence"),
        F.when(wins, F.lit("word_vote")).otherwise(F.lit("overlap")).alias("source"), display_text(tag, F.concat(F.lit("cue "), F.col("cue").cast("string"))).alias("display_text"),
    )


@query(f"""WITH {st.SEGMENTS}
SELECT a.clip, a.turn, b.turn AS other, least(a."end"+500, b."end"+500) - greatest(a."start", b."start") AS overlap
FROM segments a JOIN segments b ON a.clip = b.clip AND a."start" < b."end"+500 AND b."start" < a."end"+500""")
def interval_pairs(spark: SparkSession, d: str) -> DataFrame:
    longer = st.segments(spark, d).select("clip", "turn", "start", (F.col("end") + 500).alias("end"))
    pairs = iv.interval_join(longer, longer, ["clip"], 200)
    return pairs.select("clip", "turn", F.col("r_turn").alias("other"), iv.overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end")).alias("overlap"))


@query(f"""WITH {st.CUES}, t AS (SELECT clip, CAST(unnest(range(40)) AS BIGINT)*50 AS at FROM (SELECT DISTINCT clip FROM cues))
SELECT t.clip, t.at, c.cue FROM t JOIN cues c ON c.clip = t.clip AND t.at BETWEEN c."start" AND c."end" """)
def active_subtitles(spark: SparkSession, d: str) -> DataFrame:
    cues = st.cues(spark, d)
    times = cues.select("clip").distinct().withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1950).cast("long"), F.lit(50).cast("long"))))
    return iv.active_at(times, cues, "clip", "at", 200).select("clip", "at", "cue")


_SHARED = "greatest(0, least(a.x2,b.x2)-greatest(a.x1,b.x1)) * greatest(0, least(a.y2,b.y2)-greatest(a.y1,b.y1))"
_PAIRS = f"""WITH {st.BOXES},
pairs AS (SELECT a.clip, a.frame, b.frame AS other, {_SHARED} AS sh, (a.x2-a.x1)*(a.y2-a.y1) AS area_a, (b.x2-b.x1)*(b.y2-b.y1) AS area_b FROM boxes a JOIN boxes b ON a.clip = b.clip AND a.frame <> b.frame AND a.frame//50 = b.frame//50)
"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of the same clip and stretch of fifty frames."""
    rows = st.boxes(spark, d).withColumn("part", F.floor(F.col("frame") / 50))
    other = rows.select("clip", "part", F.col("frame").alias("other"), *[F.col(c).alias(f"b_{c}") for c in ("x1", "y1", "x2", "y2")])
    return rows.join(other, ["clip", "part"]).filter("frame <> other")


@query(_PAIRS + """SELECT clip, frame, other, c > 0.8 AS accepted, round(c, 6) AS covered FROM (
  SELECT *, CASE WHEN area_a > 0 THEN sh/area_a ELSE 0 END AS c, row_number() OVER (PARTITION BY clip, frame ORDER BY CASE WHEN area_a > 0 THEN sh/area_a ELSE 0 END DESC, other) AS place FROM pairs) WHERE place = 1""")
def iof_fusion(spark: SparkSession, d: str) -> DataFrame:
    """The box that covers most of each box; accepted above 0.8."""
    pairs = _pairs(spark, d).withColumn("c", bx.covered(bx.box(""), bx.box("b_")))
    best = first_rows(pairs, ["clip", "frame"], [F.col("c").desc(), F.col("other")])
    return best.select("clip", "frame", "other", (F.col("c") > 0.8).alias("accepted"), F.round("c", 6).alias("covered"))


@query(_PAIRS + "SELECT clip, frame, other, round(sh/(area_a+area_b-sh+1e-5), 6) AS iou FROM pairs WHERE sh/(area_a+area_b-sh+1e-5) > 0.5")
def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(spark, d).withColumn("iou", bx.iou(bx.box(""), bx.box("b_"))).filter("iou > 0.5")
    return pairs.select("clip", "frame", "other", F.round("iou", 6).alias("iou"))


@query(_PAIRS + """, m AS (SELECT *, row_number() OVER (PARTITION BY clip, frame ORDER BY sh DESC, other) AS place FROM pairs WHERE sh > 0)
SELECT b.clip, b.frame, coalesce(m.other, -1) AS other, round(CASE WHEN m.other IS NULL THEN greatest(0, b.x1-1.5*(b.x2-b.x1)) ELSE o.x1 END, 4) AS px1, round(CASE WHEN m.other IS NULL THEN least(480, b.y2+4*(b.y2-b.y1)) ELSE o.y2 END, 4) AS py2
FROM boxes b LEFT JOIN m ON m.clip = b.clip AND m.frame = b.frame AND m.place = 1 LEFT JOIN boxes o ON o.clip = m.clip AND o.frame = m.other""")
def person_face_match(spark: SparkSession, d: str) -> DataFrame:
    """The body that shares most with a face, else the face's box grown to a body's."""
    pairs = _pairs(spark, d).withColumn("shared", bx.shared_area(bx.box(""), bx.box("b_"))).filter("shared > 0")
    best = first_rows(pairs, ["clip", "frame"], [F.col("shared").desc(), F.col("other")]).select("clip", "frame", "other", "b_x1", "b_y2")
    grown = bx.body_from_face(bx.box(""), 854, 480)
    out = st.boxes(spark, d).join(best, ["clip", "frame"], "left")
    return out.select("clip", "frame", F.coalesce("other", F.lit(-1).cast("long")).alias("other"), F.round(F.coalesce("b_x1", grown[0]), 4).alias("px1"), F.round(F.coalesce("b_y2", grown[3]), 4).alias("py2"))


@query(f"""WITH {st.BOXES} SELECT clip, frame, round(greatest(0, x1-1.5*(x2-x1)), 4) AS x1, round(greatest(0, y1-0.5*(y2-y1)), 4) AS y1, round(least(854, x2+1.5*(x2-x1)), 4) AS x2, round(least(480, y2+4*(y2-y1)), 4) AS y2 FROM boxes""")
def face_expand_fallback(spark: SparkSession, d: str) -> DataFrame:
    grown = bx.body_from_face(bx.box(""), 854, 480)
    return st.boxes(spark, d).select("clip", "frame", *[F.round(c, 4).alias(n) for c, n in zip(grown, ("x1", "y1", "x2", "y2"), strict=True)])


@query(f"""WITH {st.BOXES}, k AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY (x2-x1)*(y2-y1) DESC, frame) AS place FROM boxes)
SELECT clip, frame, round((x2-x1)*(y2-y1), 4) AS area FROM k WHERE place = 1""")
def largest_face(spark: SparkSession, d: str) -> DataFrame:
    rows = st.boxes(spark, d).withColumn("a", bx.area(bx.box("")))
    return first_rows(rows, ["clip"], [F.col("a").desc(), F.col("frame")]).select("clip", "frame", F.round("a", 4).alias("area"))


@query(f"""WITH {st.BOXES}, k AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY (x2-x1)*(y2-y1), frame) AS place FROM boxes)
SELECT clip, frame, round((x2-x1)*(y2-y1), 4) AS area FROM k WHERE place = 1""")
def smallest_face_frame(spark: SparkSession, d: str) -> DataFrame:
    rows = st.boxes(spark, d).withColumn("a", bx.area(bx.box("")))
    return first_rows(rows, ["clip"], [F.col("a"), F.col("frame")]).select("clip", "frame", F.round("a", 4).alias("area"))


@query(f"""WITH {st.BOXES}, p AS (SELECT clip, frame, greatest(0, least(CAST(trunc(x1) AS INT), 639)) AS x1, greatest(0, least(CAST(trunc(y1) AS INT), 359)) AS y1, greatest(0, least(CAST(trunc(x2) AS INT), 640)) AS x2, greatest(0, least(CAST(trunc(y2) AS INT), 360)) AS y2 FROM boxes)
SELECT * FROM p WHERE x2 > x1 AND y2 > y1""")
def char_box_clamp(spark: SparkSession, d: str) -> DataFrame:
    """Boxes in whole pixels of a 640 by 360 picture; boxes without an inside go."""
    px = bx.pixel_box(bx.box(""), 640, 360, of_shares=False)
    named = st.boxes(spark, d).select("clip", "frame", *[c.alias(n) for c, n in zip(px, ("x1", "y1", "x2", "y2"), strict=True)])
    return named.filter(bx.is_crop(bx.box("")))


@query(f"""WITH {st.BOXES}, q AS (SELECT clip, frame, floor((x1+x2)/2) AS cx, floor((y1+y2)/2) AS cy, floor(floor(greatest(x2-x1, y2-y1)*1.5)/2) AS h FROM boxes)
SELECT clip, frame, CAST(greatest(0, cx-h) AS BIGINT) AS x1, CAST(greatest(0, cy-h) AS BIGINT) AS y1, CAST(least(854, cx+h) AS BIGINT) AS x2, CAST(least(480, cy+h) AS BIGINT) AS y2 FROM q""")
def square_crops(spark: SparkSession, d: str) -> DataFrame:
    crop = bx.square_crop(bx.box(""), 854, 480)
    return st.boxes(spark, d).select("clip", "frame", *[c.alias(n) for c, n in zip(crop, ("x1", "y1", "x2", "y2"), strict=True)])
