"""Queries on series: scenes, runs, smoothing, similarity, tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.operators import sequences as seq
from reelspark.operators import tracking
from reelspark.operators.ranking import ranked
from reelspark.operators.resume import numbered
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query, table

_SCENES = f"""WITH {st.FRAME_SCORES},
m AS (SELECT *, p > 0.2 AS cut FROM frame_scores),
g AS (SELECT *, sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY movie ORDER BY frame ROWS UNBOUNDED PRECEDING) AS k, max(frame) OVER (PARTITION BY movie) AS last FROM m),
s AS (SELECT movie, k, min(frame) AS start_frame, max(frame) AS own_last, any_value(last) AS last FROM g WHERE NOT cut GROUP BY movie, k),
r AS (SELECT movie, start_frame, CASE WHEN own_last = last THEN last ELSE own_last + 1 END AS end_frame, own_last = last AS tail, count(*) OVER (PARTITION BY movie) AS n FROM s
      UNION ALL SELECT movie, min(frame), max(frame), false, 1 FROM m GROUP BY movie HAVING bool_and(cut))
"""


@query(_SCENES + "SELECT movie, row_number() OVER (PARTITION BY movie ORDER BY start_frame) AS scene_no, start_frame, end_frame FROM r")
def scenes_from_scores(spark: SparkSession, d: str) -> DataFrame:
    found = seq.scenes(st.frame_scores(spark, d), ["movie"], "frame", "p", 0.2)
    return ranked(found, ["movie"], [F.col("start_frame")], "scene_no").select("movie", F.col("scene_no").cast("long"), "start_frame", "end_frame")


@query(_SCENES + "SELECT movie, start_frame, end_frame FROM r WHERE NOT tail OR n = 1")
def scenes_drop_last(spark: SparkSession, d: str) -> DataFrame:
    return seq.scenes(st.frame_scores(spark, d), ["movie"], "frame", "p", 0.2, drop_last=True)


_SEGMENTS = f"""WITH {st.TRACK_SCORES},
a AS (SELECT *, score >= 50 AS up, lead(frame) OVER w AS nxt, lag(score >= 50) OVER w AS prev FROM track_scores WINDOW w AS (PARTITION BY track ORDER BY frame)),
b AS (SELECT *, sum(CASE WHEN up AND NOT coalesce(prev, false) THEN 1 ELSE 0 END) OVER (PARTITION BY track ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM a),
s AS (SELECT track, run, min(frame) AS "start", max(coalesce(nxt, frame)) AS "end" FROM b WHERE up GROUP BY track, run),
f AS (SELECT track, "start", "end", "end" - "start" AS duration FROM s WHERE "end" - "start" > 25)
"""


@query(_SEGMENTS + "SELECT * FROM f")
def speaking_segments(spark: SparkSession, d: str) -> DataFrame:
    return seq.segments_above(st.track_scores(spark, d), ["track"], "frame", "score", 50, 25)


_RANK = _SEGMENTS + """, t AS (
  SELECT a.track, coalesce(any_value(g.total), 0) AS total, round(avg(score), 9) AS mean, max(score) AS peak
  FROM track_scores a LEFT JOIN (SELECT track, CAST(sum(duration) AS BIGINT) AS total FROM f GROUP BY track) g ON g.track = a.track GROUP BY a.track),
k AS (SELECT *, row_number() OVER (ORDER BY total DESC, mean DESC, peak DESC, track) AS place FROM t)
"""


def _track_rank(spark: SparkSession, d: str) -> DataFrame:
    scores = st.track_scores(spark, d)
    total = seq.segments_above(scores, ["track"], "frame", "score", 50, 25).groupBy("track").agg(F.sum("duration").alias("total"))
    each = scores.groupBy("track").agg(F.round(F.avg("score"), 9).alias("mean"), F.max("score").alias("peak")).join(total, "track", "left")
    each = each.withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    return each.select("track", "total", "mean", "peak")


def _order() -> list:
    return [F.col("total").desc(), F.col("mean").desc(), F.col("peak").desc(), F.col("track")]


@query(_RANK + "SELECT * FROM k")
def track_rank(spark: SparkSession, d: str) -> DataFrame:
    ranked_ = numbered(_track_rank(spark, d), _order())
    return ranked_.select("track", "total", "mean", "peak", (F.col("number") + 1).alias("place"))


@query(_RANK + "SELECT * FROM k WHERE place <= 3")
def pick_target_track(spark: SparkSession, d: str) -> DataFrame:
    """The top three of the ranking; the first is the target."""
    top = _track_rank(spark, d).orderBy(*_order()).limit(3)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*_order())).cast("long"))  # three rows


@query(f"""WITH {st.TRACK_SCORES},
a AS (SELECT *, lead(frame) OVER w AS nf, lead(score) OVER w AS ns FROM track_scores WINDOW w AS (PARTITION BY track ORDER BY frame)),
f AS (SELECT *, unnest(CASE WHEN nf IS NULL OR nf - frame > 10 THEN [frame] ELSE range(frame, nf) END) AS fr FROM a)
SELECT track, fr AS frame, round(CASE WHEN fr = frame THEN score ELSE score + (ns - score) * ((fr - frame) / (nf - frame)) END, 6) AS score FROM f""")
def interpolate_track(spark: SparkSession, d: str) -> DataFrame:
    return seq.interpolated(st.track_scores(spark, d), ["track"], "frame", ["score"], 10).withColumn("score", F.round("score", 6))


@query(f"""WITH {st.TRACK_SCORES},
a AS (SELECT *, list(score) OVER (PARTITION BY track ORDER BY frame ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS l FROM track_scores)
SELECT track, frame, list_sort(list_concat(l, list_transform(range(13 - len(l)), lambda x: CAST(0 AS DOUBLE))))[7] AS median FROM a""")
def medfilt13(spark: SparkSession, d: str) -> DataFrame:
    return seq.median_filter(st.track_scores(spark, d), ["track"], "frame", "score").select("track", "frame", "median")


@query(f"""WITH {st.TRACK_SCORES}
SELECT track, frame, last_value(CASE WHEN score >= 50 THEN score END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame ROWS UNBOUNDED PRECEDING) AS held FROM track_scores""")
def locf_bbox(spark: SparkSession, d: str) -> DataFrame:
    kept = F.when(F.col("score") >= 50, F.col("score"))
    return seq.carried_forward(st.track_scores(spark, d), ["track"], "frame", kept, "held").select("track", "frame", "held")


@query("""WITH v AS (SELECT label % 2 AS movie, vec_id AS frame, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT movie, frame, e, sqrt(list_dot_product(e, e)) AS n FROM v)
SELECT a.movie, a.frame, b.frame - a.frame AS "offset", round(list_dot_product(a.e, b.e) / (a.n * b.n), 6) AS similarity
FROM u a JOIN u b ON a.movie = b.movie AND b.frame BETWEEN a.frame - 5 AND a.frame + 5""")
def neighbour_similarity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").select((F.col("label") % 2).alias("movie"), F.col("vec_id").alias("frame"), F.col("embedding").cast("array<double>").alias("e"))
    return seq.neighbour_similarity(rows, ["movie"], "frame", "e", 5).withColumn("similarity", F.round("similarity", 6))


@query("""WITH px AS (
  SELECT vec_id AS frame, unnest(list_transform(range(21), lambda i: [CAST(floor((CAST(embedding[3*i+1] AS DOUBLE)+1)*127.5) AS INT), CAST(floor((CAST(embedding[3*i+2] AS DOUBLE)+1)*127.5) AS INT), CAST(floor((CAST(embedding[3*i+3] AS DOUBLE)+1)*127.5) AS INT)])) AS c FROM embeddings),
k AS (SELECT frame, ((c[1]>>5)<<6) + ((c[2]>>5)<<3) + (c[3]>>5) AS bin, count(*) AS n FROM px GROUP BY ALL)
SELECT frame, bin, round(n / sqrt(sum(n*n) OVER (PARTITION BY frame)), 6) AS share FROM k""")
def color_histogram(spark: SparkSession, d: str) -> DataFrame:
    channel = lambda e, i, k: F.floor((F.get(e, i * 3 + k).cast("double") + 1) * 127.5).cast("int")
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("frame"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.struct(*[channel(F.col("embedding"), i, k).alias(c) for k, c in enumerate("rgb")]))).alias("c")
    )
    rows = rows.select("frame", "c.*")
    return seq.colour_histogram(rows, ["frame"], "r", "g", "b").withColumn("share", F.round("share", 6))


@query(f"""WITH {st.TRACK_SCORES},
p AS (SELECT track, row_number() OVER (PARTITION BY track ORDER BY frame) - 1 AS pos, score FROM track_scores),
e AS (SELECT *, unnest([1,2,3,4,5,6]) AS secs FROM p),
m AS (SELECT track, pos, avg(score) OVER (PARTITION BY track, secs, pos // (secs*5)) AS a FROM e)
SELECT track, pos, round(avg(a), 9) AS score FROM m GROUP BY track, pos""")
def multiscale_mean(spark: SparkSession, d: str) -> DataFrame:
    """Means over chunks of one to six seconds, five rows a second."""
    pos = (F.row_number().over(Window.partitionBy("track").orderBy("frame")) - 1).cast("long")
    rows = st.track_scores(spark, d).select("track", pos.alias("pos"), "score")
    return seq.multiscale_mean(rows, ["track"], "pos", "score", list(range(1, 7)), 5).withColumn("score", F.round("score", 9))


@query(f"""WITH {st.TRACK_SCORES}
SELECT track, CAST(count(*) AS BIGINT) AS frames, round(avg(score), 3) AS asd_score, round(avg(score), 3) >= 245 AS is_speaking FROM track_scores GROUP BY track""")
def track_speaking(spark: SparkSession, d: str) -> DataFrame:
    mean = F.round(F.avg("score"), 3)
    return st.track_scores(spark, d).groupBy("track").agg(F.count(F.lit(1)).alias("frames"), mean.alias("asd_score"), (mean >= 245).alias("is_speaking"))


@query("""SELECT event_type AS movie, frame, row_number() OVER (PARTITION BY event_type ORDER BY frame) AS sample FROM (
  SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS frame FROM events) WHERE frame % 24 = 0""")
def sampled_frames(spark: SparkSession, d: str) -> DataFrame:
    """One frame a second at 24 frames a second, numbered from 1."""
    kept = st.frame_scores(spark, d).filter(F.col("frame") % 24 == 0)
    return ranked(kept, ["movie"], [F.col("frame")], "sample").select("movie", "frame", F.col("sample").cast("long"))


@query("""SELECT event_type AS movie, count(*) AS frames, least(count(*) // 2, count(*) - 1) AS middle FROM events GROUP BY event_type""")
def middle_frame(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1))
    return table(spark, d, "events").groupBy(F.col("event_type").alias("movie")).agg(n.alias("frames"), F.least(F.floor(n / 2), n - 1).alias("middle"))


@query(f"""WITH {st.FRAME_SCORES}, s AS (SELECT movie, frame // 24 AS sample, p FROM frame_scores WHERE frame % 24 = 0)
SELECT movie, count(*) AS total, CAST(count(*) FILTER (p >= 0.9) AS BIGINT) AS hits, min(sample) FILTER (p >= 0.9) AS first_hit,
  count(*) FILTER (p >= 0.9) >= 1 AS found, CASE WHEN count(*) FILTER (p >= 0.9) >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ratio FROM s GROUP BY movie""")
def any_hit_report(spark: SparkSession, d: str) -> DataFrame:
    """Whether any sampled frame satisfies a predicate, and where a scan that stops at the first hit ends (ratio 1)."""
    hit = F.col("p") >= 0.9
    kept = st.frame_scores(spark, d).filter(F.col("frame") % 24 == 0).withColumn("sample", F.floor(F.col("frame") / 24))
    return kept.groupBy("movie").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("hits"), F.min(F.when(hit, F.col("sample"))).alias("first_hit"),
        (F.count_if(hit) >= 1).alias("found"), F.when(F.count_if(hit) >= 1, F.lit(1.0)).otherwise(F.lit(0.0)).alias("ratio"),
    )


@query()
def greedy_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Faces with their tracks; sequential, so held against a plain loop in the tests."""
    faces = st.faces(spark, d).withColumn("scene", F.floor(F.col("frame") / 100))
    return tracking.greedy_tracks(faces.select("clip", "scene", "frame", "face_no", "x1", "y1", "x2", "y2"), ["clip", "scene"], 5)


@query(f"""WITH {st.FACES} SELECT clip, frame, count(*) AS n, list(face_no ORDER BY face_no)[1] AS first_face,
  CAST(count(*) FILTER (conf >= 0.5) AS BIGINT) AS sure FROM faces GROUP BY clip, frame""")
def frame_faces(spark: SparkSession, d: str) -> DataFrame:
    """Faces gathered by frame, and those the detector is sure of."""
    listed = F.array_sort(F.collect_list("face_no"))
    return st.faces(spark, d).groupBy("clip", "frame").agg(F.count(F.lit(1)).alias("n"), F.element_at(listed, 1).alias("first_face"), F.count_if(F.col("conf") >= 0.5).alias("sure"))
