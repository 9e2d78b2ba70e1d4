"""Queries on shots and their frames, tracks, speakers of clips, and screening by detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import boxes as bx
from reelspark.functions import speakers, texts, times
from reelspark.operators import intervals, screening
from reelspark.operators import sequences as seq
from reelspark.operators.ranking import first_rows, ranked
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query, table
from reelspark.plans.series import _SCENES


def _speaker_results(spark: SparkSession, d: str) -> DataFrame:
    """movie, clip, result: characters of orders as JSON, objects for even clips and lists for odd ones."""
    name = F.concat(F.lit("<char_"), F.col("l_linenumber").cast("string"), F.lit(">"))
    speaks = (F.col("l_returnflag") == "R").cast("string")
    entry = F.concat(F.lit('"'), name, F.lit('": {"is_speaking": '), speaks, F.lit("}"))
    key = F.when(F.col("l_linenumber") % 2 == 0, F.lit("char_id")).otherwise(F.lit("char"))
    item = F.concat(F.lit('{"'), key, F.lit('": "'), name, F.lit('", "is_speaking": '), speaks, F.lit("}"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("l_returnflag"))
    lists = lines.groupBy(F.col("l_orderkey").alias("clip")).agg(F.collect_list(entry).alias("entries"), F.collect_list(item).alias("items"))
    text = F.when(F.col("clip") % 2 == 0, F.concat(F.lit("{"), F.array_join("entries", ", "), F.lit("}"))).otherwise(F.concat(F.lit("["), F.array_join("items", ", "), F.lit("]")))
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("movie"), F.col("o_orderkey").alias("clip"))
    return lists.select("clip", F.parse_json(text).alias("result")).join(orders, "clip")


_CHARS = """lines AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL),
chars AS (SELECT l_orderkey AS clip, coalesce(bool_or(l_returnflag = 'R'), false) AS speaking,
  coalesce(string_agg('<char_' || l_linenumber || '>', ',' ORDER BY l_linenumber) FILTER (l_returnflag = 'R'), '') AS characters FROM lines GROUP BY l_orderkey)"""


@query(f"WITH {_CHARS} SELECT o_custkey AS movie, clip, speaking, characters FROM chars JOIN orders ON o_orderkey = clip")
def speaking_gate(spark: SparkSession, d: str) -> DataFrame:
    """Whether anyone speaks in a clip, and who, from both forms of speaker results."""
    rows = _speaker_results(spark, d)
    return rows.select("movie", "clip", speakers.any_speaking(F.col("result")).alias("speaking"), F.array_join(speakers.speaking_characters(F.col("result")), ",").alias("characters"))


@query(f"""WITH {_CHARS}, imgs AS (SELECT l_orderkey AS clip, list('p' || l_linenumber || '_norm.jpg' ORDER BY l_linenumber) AS images FROM lineitem GROUP BY l_orderkey)
SELECT o_custkey AS movie, chars.clip, c_name AS meta, array_to_string(images, ',') AS images, characters
FROM chars JOIN orders ON o_orderkey = chars.clip JOIN customer ON c_custkey = o_custkey JOIN imgs ON imgs.clip = chars.clip WHERE speaking""")
def dataset_join_speaking(spark: SparkSession, d: str) -> DataFrame:
    """The dataset's records: clips in which someone speaks, with metadata, all images, and who speaks."""
    rows = _speaker_results(spark, d).filter(speakers.any_speaking(F.col("result")))
    name = F.concat(F.lit("p"), F.col("l_linenumber").cast("string"), F.lit("_norm.jpg"))
    images = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("clip")).agg(F.array_join(F.array_sort(F.collect_list(name)), ",").alias("images"))
    meta = table(spark, d, "customer").select(F.col("c_custkey").alias("movie"), F.col("c_name").alias("meta"))
    return rows.join(images, "clip").join(meta, "movie").select("movie", "clip", "meta", "images", F.array_join(speakers.speaking_characters(F.col("result")), ",").alias("characters"))


@query(f"""WITH {_CHARS}, s AS (SELECT clip FROM chars WHERE speaking)
SELECT 'clips/' || clip || '.mp4' AS src, 'kept/' || o_custkey || '/' || clip || '.mp4' AS dst FROM s JOIN orders ON o_orderkey = clip
UNION ALL SELECT 'images/' || clip || '_person' || l_linenumber || '_norm.jpg', 'kept/' || o_custkey || '/' || clip || '_person' || l_linenumber || '_norm.jpg' FROM s JOIN orders ON o_orderkey = clip JOIN lineitem ON l_orderkey = clip""")
def copy_manifest(spark: SparkSession, d: str) -> DataFrame:
    """What is to be copied where for the dataset: the file of each clip kept, and its images."""
    kept = _speaker_results(spark, d).filter(speakers.any_speaking(F.col("result"))).select("clip", F.concat(F.lit("kept/"), F.col("movie").cast("string"), F.lit("/")).alias("to"))
    film = F.concat(F.col("clip").cast("string"), F.lit(".mp4"))
    images = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip"), F.concat(F.col("l_orderkey").cast("string"), F.lit("_person"), F.col("l_linenumber").cast("string"), F.lit("_norm.jpg")).alias("name"))
    films = kept.select(F.concat(F.lit("clips/"), film).alias("src"), F.concat("to", film).alias("dst"))
    return films.unionByName(kept.join(images, "clip").select(F.concat(F.lit("images/"), F.col("name")).alias("src"), F.concat("to", "name").alias("dst")))


@query(_SCENES + """, n AS (SELECT movie, start_frame, end_frame FROM r)
SELECT n.movie, n.start_frame, count(*) AS frames, round(avg(f.p), 6) AS mean FROM n JOIN frame_scores f ON f.movie = n.movie AND f.frame >= n.start_frame AND f.frame < n.end_frame GROUP BY n.movie, n.start_frame""")
def shot_frames(spark: SparkSession, d: str) -> DataFrame:
    """The frames of each shot, by a join on ranges."""
    frames = st.frame_scores(spark, d)
    held = intervals.frames_of_shots(seq.scenes(frames, ["movie"], "frame", "p", 0.2), frames, ["movie"], 50)
    return held.groupBy("movie", "start_frame").agg(F.count(F.lit(1)).alias("frames"), F.round(F.avg("p"), 6).alias("mean"))


@query(_SCENES.replace("p > 0.2", "p > 0.8") + """, w AS (SELECT movie, count(*) AS n FROM frame_scores GROUP BY movie),
e AS (SELECT r.movie, max(start_frame) AS last, count(*) AS k, any_value(w.n) AS n FROM r JOIN w ON w.movie = r.movie GROUP BY r.movie)
SELECT r.movie, r.start_frame, r.end_frame FROM r JOIN e ON e.movie = r.movie
WHERE r.end_frame - r.start_frame >= 4 AND NOT (r.start_frame = e.last AND (e.n % 100 = 0 OR (e.last >= e.n // 100 * 100 AND e.k > 1)))""")
def scenes_windowed(spark: SparkSession, d: str) -> DataFrame:
    """Scenes of at least four frames as a scan in windows of 100 frames writes them down."""
    return seq.scenes_by_windows(st.frame_scores(spark, d), ["movie"], "frame", "p", 0.8, 100, 4)


@query(f"""WITH {st.FRAME_SCORES}, c AS (SELECT *, CASE WHEN abs(p - lag(p) OVER w) > 0.5 THEN 1 WHEN lag(p) OVER w IS NULL THEN 1 ELSE 0 END AS cut FROM frame_scores WINDOW w AS (PARTITION BY movie ORDER BY frame)),
s AS (SELECT *, sum(cut) OVER (PARTITION BY movie ORDER BY frame ROWS UNBOUNDED PRECEDING) AS scene FROM c),
g AS (SELECT movie, min(frame) AS start_frame, max(frame) + 1 AS end_frame FROM s GROUP BY movie, scene)
SELECT * FROM g WHERE end_frame - start_frame >= 5""")
def content_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Stretches between strong changes that last a fifth of a second."""
    found = seq.content_cuts(st.frame_scores(spark, d), ["movie"], "frame", "p", 0.5)
    return found.filter(F.col("end_frame") - F.col("start_frame") >= seq.min_scene_frames(0.2))


@query(f"""WITH {st.FACES}, b AS (SELECT clip, frame, count(*) FILTER (conf * 490 * 2 > 200) >= 3 AS hit FROM faces GROUP BY clip, frame),
o AS (SELECT *, sum(hit::INT) OVER w AS hits, row_number() OVER w AS nth FROM b WINDOW w AS (PARTITION BY clip ORDER BY frame ROWS UNBOUNDED PRECEDING)),
s AS (SELECT clip, count(*) AS n, sum(hit::INT) AS all_hits, min(nth) FILTER (hits >= 40) AS stop FROM o GROUP BY clip)
SELECT clip, stop IS NOT NULL AS found, coalesce(stop, n) AS sampled, CAST(CASE WHEN stop IS NOT NULL THEN 40 ELSE all_hits END AS BIGINT) AS hits, CASE WHEN stop IS NOT NULL THEN 1.0::DOUBLE ELSE round(all_hits / n, 3) END AS ratio FROM s""")
def text_screening(spark: SparkSession, d: str) -> DataFrame:
    """Clips with at least forty frames of three or more text boxes; boxes are twenty high and a tenth of a face's value wide."""
    rows = st.faces(spark, d).withColumn("right", F.col("conf") * 490 / 10)
    area = bx.text_box_area(F.lit(0.0), F.col("right"), F.lit(0.0), F.lit(20.0))
    frames = rows.groupBy("clip", "frame").agg((F.count_if(screening.is_text_box(area)) >= 3).alias("hit"))
    return screening.any_hit(frames, ["clip"], "frame", F.col("hit"), 40)


@query(f"""WITH {st.FACES}, b AS (SELECT clip, frame, count(*) FILTER (face_no % 3 = 1 AND conf >= 0.5) > 0 AS hit FROM faces GROUP BY clip, frame),
o AS (SELECT *, sum(hit::INT) OVER w AS hits, row_number() OVER w AS nth FROM b WINDOW w AS (PARTITION BY clip ORDER BY frame ROWS UNBOUNDED PRECEDING)),
s AS (SELECT clip, count(*) AS n, sum(hit::INT) AS all_hits, min(nth) FILTER (hits >= 1) AS stop FROM o GROUP BY clip)
SELECT clip, stop IS NOT NULL AS found, coalesce(stop, n) AS sampled, CAST(CASE WHEN stop IS NOT NULL THEN 1 ELSE all_hits END AS BIGINT) AS hits, CASE WHEN stop IS NOT NULL THEN 1.0::DOUBLE ELSE round(all_hits / n, 3) END AS ratio FROM s""")
def person_screening(spark: SparkSession, d: str) -> DataFrame:
    """Clips with a frame in which a detector is sure of a person; its class is the face's number modulo three."""
    person = screening.is_person(F.col("face_no") % 3, F.col("conf"))
    frames = st.faces(spark, d).groupBy("clip", "frame").agg(F.bool_or(person).alias("hit"))
    return screening.any_hit(frames, ["clip"], "frame", F.col("hit"))


@query(f"""WITH {st.BOXES}, a AS (SELECT *, lead(frame) OVER w AS nf, lead(x1) OVER w AS nx1, lead(y1) OVER w AS ny1, lead(x2) OVER w AS nx2, lead(y2) OVER w AS ny2 FROM boxes WINDOW w AS (PARTITION BY clip ORDER BY frame)),
f AS (SELECT *, unnest(CASE WHEN nf IS NULL THEN [frame] ELSE range(frame, nf) END) AS fr FROM a),
g AS (SELECT clip, CASE WHEN fr = frame THEN 0 ELSE (fr - frame) / (nf - frame) END AS s, x2 - x1 AS w, y2 - y1 AS h, nx2 - nx1 AS nw, ny2 - ny1 AS nh FROM f),
m AS (SELECT clip, count(*) AS frames, avg(CASE WHEN s = 0 THEN w ELSE w + (nw - w) * s END) AS width, avg(CASE WHEN s = 0 THEN h ELSE h + (nh - h) * s END) AS height FROM g GROUP BY clip)
SELECT clip, frames, round(width, 6) AS width, round(height, 6) AS height FROM m WHERE greatest(width, height) > 60""")
def sized_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Tracks, here a clip's boxes, that are wide or high enough on average over all their frames."""
    found = seq.sized_tracks(st.boxes(spark, d), ["clip"], "frame", 60.0, 2)
    return found.select("clip", "frames", F.round("width", 6).alias("width"), F.round("height", 6).alias("height"))


_ZIPPED = """arrays AS (SELECT user_id AS track, user_id % 10 AS clip, list(event_id ORDER BY event_id) AS frames, list(value ORDER BY event_id) FILTER (value < 400) AS scores FROM events GROUP BY user_id)"""


def _tracks_and_scores(spark: SparkSession, d: str) -> DataFrame:
    """clip, track, frames, scores: arrays of different length."""
    rows = table(spark, d, "events")
    frames = F.array_sort(F.collect_list("event_id"))
    scores = F.transform(F.array_sort(F.collect_list(F.when(F.col("value") < 400, F.struct("event_id", "value")))), lambda x: x["value"])
    return rows.groupBy(F.col("user_id").alias("track")).agg(F.first(F.col("user_id") % 10).alias("clip"), frames.alias("frames"), scores.alias("scores"))


@query(f"""WITH {_ZIPPED}, z AS (SELECT *, CAST(least(len(frames), coalesce(len(scores), 0)) AS BIGINT) AS n FROM arrays)
SELECT clip, track, n, CASE WHEN n > 0 THEN frames[n] END AS last_frame, round(coalesce(list_sum(list_transform(scores[1:n], lambda x: CASE WHEN x >= 245 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)), 0), 6) AS speaking FROM z""")
def zipped_scores(spark: SparkSession, d: str) -> DataFrame:
    """Frames and scores of tracks met by place, as far as both go."""
    pairs = _tracks_and_scores(spark, d).withColumn("pairs", seq.zipped(F.col("frames"), F.col("scores")))
    up = F.aggregate("pairs", F.lit(0.0), lambda s, x: s + F.when(x["b"] >= 245, F.lit(1.0)).otherwise(F.lit(0.0)))
    return pairs.select("clip", "track", F.size("pairs").cast("long").alias("n"), F.get(F.col("pairs"), F.size("pairs") - 1)["a"].alias("last_frame"), F.round(up, 6).alias("speaking"))


@query(f"""WITH {_ZIPPED} SELECT clip, count(*) AS num_tracks, 245.0::DOUBLE AS threshold, arg_min(frames[1], track) AS first_frame, CAST(sum(len(frames)) AS BIGINT) AS frames, CAST(sum(coalesce(len(scores), 0)) AS BIGINT) AS scores FROM arrays GROUP BY clip""")
def tracking_payload(spark: SparkSession, d: str) -> DataFrame:
    """Tracks and scores of a clip as one JSON document, and what a reader of it finds."""
    item = F.struct("track", "frames", "scores")
    whole = _tracks_and_scores(spark, d).groupBy("clip").agg(F.array_sort(F.collect_list(item)).alias("tracks"))
    payload = F.to_json(F.struct(F.size("tracks").alias("num_tracks"), F.lit(245.0).alias("threshold"), "tracks"))
    read = whole.select("clip", F.parse_json(payload).alias("p"))
    get = lambda path, kind: F.try_variant_get("p", path, kind)
    lists = lambda k: F.aggregate(F.transform(get("$.tracks", "array<struct<frames:array<long>,scores:array<double>>>"), lambda t: F.size(t[k]).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return read.select("clip", get("$.num_tracks", "long").alias("num_tracks"), get("$.threshold", "double").alias("threshold"), get("$.tracks[0].frames[0]", "long").alias("first_frame"), lists("frames").alias("frames"), lists("scores").alias("scores"))


@query(f"""WITH {st.BOXES}, {st.FACES},
chars AS (SELECT clip, frame AS person, x1 / 854 * 854.0 AS x1, y1 / 480 * 480.0 AS y1, x2 / 854 * 854.0 AS x2, y2 / 480 * 480.0 AS y2 FROM boxes),
t AS (SELECT clip, CAST(floor(x1 / 56) AS BIGINT) AS track, frame, face_no, x1, y1, x2, y2, conf, row_number() OVER (PARTITION BY clip, floor(x1 / 56) ORDER BY frame, face_no) - 1 AS pos, count(*) OVER (PARTITION BY clip, floor(x1 / 56)) AS n FROM faces),
mid AS (SELECT * FROM t WHERE pos = n // 2), score AS (SELECT clip, track, avg(conf - 0.3) AS mean FROM t GROUP BY clip, track),
p AS (SELECT c.clip, c.person, m.track, greatest(0, least(c.x2, m.x2) - greatest(c.x1, m.x1)) * greatest(0, least(c.y2, m.y2) - greatest(c.y1, m.y1)) / ((m.x2 - m.x1) * (m.y2 - m.y1)) AS iof FROM chars c JOIN mid m ON m.clip = c.clip),
k AS (SELECT *, row_number() OVER (PARTITION BY clip, person ORDER BY iof DESC, track) AS place FROM p WHERE iof > 0.8)
SELECT c.clip, '<char_' || c.person || '>' AS tag, coalesce(k.track, -1) AS track, coalesce(s.mean >= 0, false) AS is_speaking, round(s.mean, 3) AS asd_score, CASE WHEN k.track IS NULL THEN 'Face missing or occluded' END AS note
FROM chars c LEFT JOIN k ON k.clip = c.clip AND k.person = c.person AND k.place = 1 LEFT JOIN score s ON s.clip = k.clip AND s.track = k.track""")
def late_fusion(spark: SparkSession, d: str) -> DataFrame:
    """Characters, given in shares of the picture, with the track whose middle face lies most in them, above 0.8; who speaks on average."""
    share = st.boxes(spark, d).select("clip", F.col("frame").alias("person"), *[(F.col(c) / s).alias(c) for c, s in (("x1", 854), ("y1", 480), ("x2", 854), ("y2", 480))])
    chars = share.select("clip", "person", *[c.alias(f"c_{n}") for n, c in zip(("x1", "y1", "x2", "y2"), bx.scaled(bx.box(""), 854.0, 480.0), strict=True)])
    faces = st.faces(spark, d).withColumn("track", F.floor(F.col("x1") / 56).cast("long"))
    placed = ranked(faces, ["clip", "track"], [F.col("frame"), F.col("face_no")], "pos")
    tracks = faces.groupBy("clip", "track").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("conf") - 0.3).alias("mean"))
    middle = placed.join(tracks, ["clip", "track"]).filter(F.col("pos") - 1 == F.floor(F.col("n") / 2)).select("clip", "track", "mean", "x1", "y1", "x2", "y2")
    pairs = chars.join(middle, "clip").withColumn("iof", bx.covered(bx.box(""), bx.box("c_"))).filter("iof > 0.8")
    best = first_rows(pairs, ["clip", "person"], [F.col("iof").desc(), F.col("track")]).select("clip", "person", "track", "mean")
    out = chars.join(best, ["clip", "person"], "left")
    return out.select(
        "clip", texts.character_tag(F.col("person")).alias("tag"), F.coalesce("track", F.lit(-1).cast("long")).alias("track"), F.coalesce(F.col("mean") >= 0, F.lit(False)).alias("is_speaking"),
        F.round("mean", 3).alias("asd_score"), F.when(F.col("track").isNull(), F.lit("Face missing or occluded")).alias("note"),
    )


@query(f"""WITH {st.BOXES}, b AS (SELECT clip, frame // 10 AS part, frame, (x2 - x1) * (y2 - y1) AS a FROM boxes), k AS (SELECT *, row_number() OVER (PARTITION BY clip, part ORDER BY a DESC, frame) AS place FROM b)
SELECT clip, part, frame, round(a, 4) AS area FROM k WHERE place = 1""")
def largest_face_frame(spark: SparkSession, d: str) -> DataFrame:
    """The largest face of each frame; ten neighbouring boxes stand for one frame's."""
    rows = st.boxes(spark, d).select("clip", F.floor(F.col("frame") / 10).alias("part"), "frame", bx.area(bx.box("")).alias("a"))
    return first_rows(rows, ["clip", "part"], [F.col("a").desc(), F.col("frame")]).select("clip", "part", "frame", F.round("a", 4).alias("area"))


@query(f"""WITH {st.TRACK_SCORES}, p AS (SELECT track, row_number() OVER (PARTITION BY track ORDER BY frame) - 1 AS pos, score FROM track_scores),
e AS (SELECT *, unnest([1,2,3,4,5,6]) AS secs FROM p), m AS (SELECT track, pos, avg(score) OVER (PARTITION BY track, secs, pos // (secs*25)) AS a FROM e)
SELECT track, pos, round_even(avg(a), 1) AS score FROM m GROUP BY track, pos""")
def multiscale_tenths(spark: SparkSession, d: str) -> DataFrame:
    """Scores of tracks averaged over chunks of one to six seconds, in tenths."""
    rows = ranked(st.track_scores(spark, d), ["track"], [F.col("frame")], "pos").select("track", (F.col("pos") - 1).cast("long").alias("pos"), "score")
    return seq.multiscale_mean(rows, ["track"], "pos", "score", list(range(1, 7))).withColumn("score", seq.tenths(F.col("score")))


@query("""WITH v AS (SELECT label % 2 AS movie, vec_id AS frame, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT movie, frame, e, sqrt(list_dot_product(e, e)) AS n FROM v),
p AS (SELECT a.movie, a.frame, b.frame - a.frame AS o, list_dot_product(a.e, b.e) / (a.n * b.n) AS s FROM u a JOIN u b ON a.movie = b.movie AND b.frame BETWEEN a.frame - 50 AND a.frame + 50),
z AS (SELECT u.movie, u.frame, CAST(unnest(range(-50, 51)) AS BIGINT) AS o FROM u)
SELECT z.movie, z.frame, z.o AS "offset", round(coalesce(p.s, 0), 6) AS similarity FROM z LEFT JOIN p ON p.movie = z.movie AND p.frame = z.frame AND p.o = z.o""")
def similarity_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Similarities to the fifty frames before and after, 0 where there is no frame."""
    rows = table(spark, d, "embeddings").select((F.col("label") % 2).alias("movie"), F.col("vec_id").alias("frame"), F.col("embedding").cast("array<double>").alias("e"))
    found = seq.similarity_lookup(rows, ["movie"], "frame", "e", 50)
    flat = found.select("movie", "frame", F.posexplode("similarities").alias("place", "similarity"))
    return flat.select("movie", "frame", (F.col("place") - 50).cast("long").alias("offset"), F.round("similarity", 6).alias("similarity"))


@query(f"""WITH {st.BOXES}, s AS (SELECT clip, frame, floor(greatest(x2 - x1, y2 - y1) / 2) AS s, floor((x1 + x2) / 2) AS x, floor((y1 + y2) / 2) AS y FROM boxes),
q AS (SELECT *, CAST(floor(s * 1.8) AS BIGINT) AS pad FROM s)
SELECT clip, frame, pad, CAST(trunc(y + pad - s) AS BIGINT) AS top, CAST(trunc(y + pad + s * 1.8) AS BIGINT) AS bottom, CAST(trunc(x + pad - s * 1.4) AS BIGINT) AS "left", CAST(trunc(x + pad + s * 1.4) AS BIGINT) AS "right" FROM q""")
def crop_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Padding and bounds of the face crops, around whole centres with whole half sides."""
    b = bx.box("")
    rows = st.boxes(spark, d).select("clip", "frame", F.floor(F.greatest(b[2] - b[0], b[3] - b[1]) / 2).alias("s"), F.floor((b[0] + b[2]) / 2).alias("x"), F.floor((b[1] + b[3]) / 2).alias("y"))
    return rows.select("clip", "frame", *[c.alias(n) for n, c in bx.crop_geometry(F.col("s"), F.col("x"), F.col("y")).items()])


@query(f"""WITH {st.CLIPS}, c AS (SELECT clip, "start", "end", "end" - "start" AS n FROM clips),
a AS (SELECT *, CAST(floor("start" % 100 / 24.0 * 16000) AS BIGINT) AS f, least(CAST(floor(("start" % 100 + n) / 24.0 * 16000) AS BIGINT), 1000000) AS l, least((n*4 - (n*4) % 4) / 100.0, n % 90) AS len FROM c)
SELECT clip, CASE WHEN f < l THEN f END AS first_sample, CASE WHEN f < l THEN l END AS last_sample, CASE WHEN clip % 5 > 0 AND n > 0 THEN round(n / (clip % 5), 3) END AS seconds, round("start" / 25.0, 6) AS at,
  CAST(round_even(len * 100, 0) AS BIGINT) AS audio_rows, CAST(round_even(len * 25, 0) AS BIGINT) AS video_rows FROM a""")
def media_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Samples, seconds and feature rows of clips: audio of a million samples at 16,000 a second, rates from 0 to 4."""
    n = F.col("end") - F.col("start")
    first, last = times.audio_slice(F.col("start") % 100, F.col("start") % 100 + n, 24.0, 16_000, F.lit(1_000_000))
    audio, video = times.common_rows(n * 4, n % 90)
    return st.clips(spark, d).select(
        "clip", first.alias("first_sample"), last.alias("last_sample"), times.media_duration(n, F.col("clip") % 5).alias("seconds"), F.round(times.frames_to_seconds(F.col("start"), 25.0), 6).alias("at"), audio.alias("audio_rows"), video.alias("video_rows"),
    )


@query(f"""WITH {st.TRACK_SCORES} SELECT track, frame, 'Track | ' || CASE WHEN score >= 31 THEN 'speaking' ELSE 'silent' END || ' | score=' || CASE WHEN score IS NULL THEN 'NA' ELSE printf('%.2f', score) END AS label,
  'T' || lpad(CAST(track AS VARCHAR), CAST(greatest(2, length(CAST(track AS VARCHAR))) AS INT), '0') AS tag, 'Track ' || lpad(CAST(track AS VARCHAR), 5, '0') AS name, 'Track_' || lpad(CAST(track AS VARCHAR), 5, '0') AS file FROM (SELECT track, frame, CASE WHEN frame % 11 = 0 THEN NULL ELSE score / 8 END AS score FROM track_scores)""")
def track_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels, tags and names of tracks; each eleventh frame has no score."""
    score = F.when(F.col("frame") % 11 != 0, F.col("score") / 8)
    track = F.col("track")
    return st.track_scores(spark, d).select("track", "frame", texts.speaking_label("Track", score, 31).alias("label"), texts.track_tag(track).alias("tag"), texts.track_name(track).alias("name"), texts.track_file(track).alias("file"))


@query(f"WITH {st.TRACK_SCORES} SELECT track, frame, round(1 / (1 + exp(-(score - 245) / 100)), 6) AS p FROM track_scores")
def sigmoid_scores(spark: SparkSession, d: str) -> DataFrame:
    return st.track_scores(spark, d).select("track", "frame", F.round(seq.sigmoid((F.col("score") - 245) / 100), 6).alias("p"))


@query(f"""WITH {st.SEGMENTS} SELECT clip, turn, row_number() OVER (PARTITION BY clip ORDER BY "start" % 97, "end", turn) AS place FROM segments""")
def segments_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Places of segments in the order of start, then end."""
    rows = st.segments(spark, d).withColumn("start", F.col("start") % 97)
    return ranked(rows, ["clip"], [F.col("start"), F.col("end"), F.col("turn")], "place").select("clip", "turn", F.col("place").cast("long"))
