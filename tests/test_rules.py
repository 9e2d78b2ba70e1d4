"""Rules that are easy to get wrong, on rows made by hand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reelspark.functions import boxes, clips, texts, times
from reelspark.operators import intervals, resume, sequences, stats
from reelspark.operators.tracking import greedy_tracks, tracks_of
from reelspark.plans.queries import QUERIES
from reelspark.sources import annotators, files, records, subtitles
from reelspark.streaming import stages


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "values, expected, kept",
    [
        ([0, 0, 1, 0, 0, 0, 1, 1, 0, 0], [(0, 2), (3, 6), (8, 9)], [(0, 2), (3, 6)]),
        ([1, 1, 1], [(0, 2)], [(0, 2)]),
        ([0], [(0, 0)], [(0, 0)]),
        ([1, 0, 0, 1], [(1, 3)], [(1, 3)]),
        ([0, 0, 0], [(0, 2)], [(0, 2)]),
    ],
)
def test_scenes(spark, values, expected, kept):
    df = spark.createDataFrame([("m", k, float(v)) for k, v in enumerate(values)], "movie string, frame long, p double")
    for drop, want in ((False, expected), (True, kept)):
        got = sequences.scenes(df, ["movie"], "frame", "p", 0.5, drop).orderBy("start_frame").select("start_frame", "end_frame").collect()
        assert [tuple(r) for r in got] == want


def test_segments_close_at_the_first_row_below(spark):
    scores = [0.5, -1.0, 0.0, 0.0, -1.0, -1.0, 0.3]
    df = spark.createDataFrame([(1, float(k), s) for k, s in enumerate(scores)], "track long, t double, s double")
    got = sequences.segments_above(df, ["track"], "t", "s", 0.0, 0.0).orderBy("start").collect()
    assert [(r["start"], r["end"], r["duration"]) for r in got] == [(0.0, 1.0, 1.0), (2.0, 4.0, 2.0)]  # the last has no length


def test_median_pads_with_zeros(spark):
    df = spark.createDataFrame([(1, k, 100.0) for k in range(13)], "track long, pos long, v double")
    got = [r["median"] for r in sequences.median_filter(df, ["track"], "pos", "v").orderBy("pos").collect()]
    assert got == [100.0] * 13
    got = sequences.median_filter(df.filter("pos < 6"), ["track"], "pos", "v").collect()
    assert {r["median"] for r in got} == {0.0}


def test_clip_names(spark):
    df = spark.createDataFrame([("scene_001_000010_000058.mp4",), ("scene_001_000010_000057.mp4",), ("scene_001_000058_000010.mp4",), ("a_b_c.mp4",), ("short.mp4",)], "f string")
    got = df.select(clips.duration_by_prefix(F.col("f")), clips.duration_by_suffix(F.col("f")), clips.is_long_enough(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [(2.0, 49 / 24, True), (47 / 24, 2.0, False), (-2.0, -47 / 24, False), (None, None, True), (None, None, True)]


def test_times(spark):
    assert one(spark, times.srt_time(F.lit(3661.9999))) == "01:01:01,999"
    assert one(spark, times.srt_seconds(F.lit("01:01:01,250"))) == 3661.25
    assert one(spark, times.srt_seconds(F.lit("01:01,250"))) is None
    assert one(spark, times.minutes_text(F.lit(75.5))) == "01:15.50"
    assert one(spark, times.duration_text(F.lit(3725.25))) == "1h 2m 5.2s"
    for x in (0.125, 2.675, 125.625, 0.25, 0.375, 59.995, 59.996, 1.005, 8.345, 0.045, 1e6 + 0.005, 0.0, 7.0):
        assert one(spark, times.minutes_text(F.lit(x))) == f"{int(x // 60):02d}:{x % 60:05.2f}"
        assert one(spark, texts.speaking_label("T", F.lit(-x), 0)).endswith(f"score={-x:.2f}".replace("-0.00", "0.00"))
    for x in (0.25, 0.35, 0.05, 0.15, 2.45, 59.95, 61.25):
        assert one(spark, times.duration_text(F.lit(x))).endswith(f"{x % 60:.1f}s")


@pytest.mark.parametrize("text", ["[SPEAKER_00]: hi", "speaker-1 hi", "[ UNKNOWN ] hi", "Unknown: hi", "  hi  "])
def test_speaker_prefixes(spark, text):
    assert one(spark, texts.without_speaker(F.lit(text))) == "hi"


def test_salvage(spark):
    n = lambda s, v: one(spark, F.try_variant_get(texts.salvaged_json(F.lit(s), v), "$.a", "int"))
    assert [n('assistant: {"a": 1}', v) for v in (1, 2, 3)] == [1, 1, None or 1]
    assert n('{"a": 1, "b": "assistant"}', 1) == 1  # cut inside, then found by its braces
    assert n("nothing", 1) is None
    assert one(spark, texts.parse_status(texts.salvaged_json(F.lit("{}"), 1))) == "parse_error"


def test_boxes(spark):
    lit = lambda *v: tuple(F.lit(float(x)) for x in v)
    assert one(spark, boxes.covered(lit(0, 0, 10, 10), lit(0, 0, 8, 10))) == 0.8
    assert one(spark, boxes.covered(lit(5, 5, 5, 5), lit(0, 0, 8, 10))) == 0.0
    assert abs(one(spark, boxes.iou(lit(0, 0, 2, 2), lit(1, 0, 3, 2))) - 1 / 3) < 1e-5
    px = boxes.pixel_box(lit(-0.1, 0.5, 1.5, 1.0), 100, 50)
    assert tuple(spark.range(1).select(*[c.alias(str(k)) for k, c in enumerate(px)]).first()) == (0, 25, 100, 50)


def test_srt(spark):
    text = "1\n00:00:01,000 --> 00:00:02,000\n[A] one\n\n8\n00:00:01,000 --> 00:00:02,000\nUNKNOWN:\n\n9\n00:00:02,001 --> 00:00:02,999\n[SPEAKER_01] hi\n\n00:00:03,000 --> 00:00:04,000\ntwo\nlines\n\n3\n00:00:05.000 --> 00:00:06,000\nbad\n\n4\n00:00:07,000 --> 00:00:07,000\nempty\n\n9\n00:00:08,000 --> 00:00:09,500\n  \n"
    got = subtitles.srt_cues(spark.createDataFrame([("f", text)], "k string, text string"), "k").orderBy("start").collect()
    assert [(r["idx"], r["start"], r["end"], r["text"]) for r in got] == [(1, 1.0, 2.0, "[A] one"), (9, 2.001, 2.999, "hi"), (3, 3.0, 4.0, "two lines")]


def test_records(spark):
    text = '{"f": 1, "v": "a"}\n\n{broken\n{"f": 1, "v": "b"}\n{"f": 2, "v": null}'
    rows = records.lines(spark.createDataFrame([("m", text)], "movie string, text string"))
    got = {r["f"]: r["v"] for r in records.latest_records(rows, ["movie", "f"], "f bigint, v string").collect()}
    assert got == {1: "b", 2: None}


def test_flags_three_states(spark):
    rows = [('{"has_person": true, "has_text": null}', True), ('{"has_person": true}', False), ('{"has_person": true, "has_text": true}', False), ('{"has_person": null, "has_text": false}', False)]
    df = spark.createDataFrame(rows, "j string, want boolean")
    assert df.filter(records.lenient_valid(F.parse_json("j")) != F.col("want")).count() == 0


def test_overlap_ties_and_limits(spark):
    cues = spark.createDataFrame([(1, 0, 0.0, 10.0), (1, 1, 20.0, 30.0)], "clip long, cue long, start double, end double")
    segments = spark.createDataFrame([(1, 5, 0.0, 3.0), (1, 2, 5.0, 8.0), (1, 7, 20.0, 22.0)], "clip long, track long, start double, end double")
    by = intervals.overlap_by_track(cues, segments, "clip", "cue", "track")
    got = {r["cue"]: r for r in intervals.assigned(cues, by, "clip", "cue", "track", 0.05, 0.2).collect()}
    assert got[0]["track"] == 2 and got[0]["overlap"] == 3.0  # a tie goes to the lower track
    assert got[1]["unknown"] and got[1]["track"] is None  # a ratio of exactly 0.2 is not enough
    top = [(r["track"], r["overlap"]) for r in intervals.top_tracks(by, "clip", "cue", "track").filter("cue = 1").orderBy("rank").collect()]
    assert top == [(7, 2.0), (2, 0.0)]  # tracks that share nothing are candidates too


def test_interval_join_against_all_pairs(spark):
    rng = random.Random(3)
    make = lambda n: [(rng.randrange(3), k, float(s := rng.randrange(300)), float(s + rng.randrange(0, 90))) for k in range(n)]
    a, b = make(120), make(120)
    schema = "k long, id long, start double, end double"
    a += [(0, 200, 0.0, 1e6), (1, 201, 5.0, 2e9), (2, 202, 100.0, 100.5), (0, 203, -500.0, -20.0)]
    b += [(0, 300, -1e9, 1e9), (2, 301, 25.0, 50.0), (2, 302, 0.0, 100.0), (0, 303, -400.0, 1600.0)]
    got = intervals.interval_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], 25)
    want = {(x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and y[2] < x[3] and x[3] > x[2] and y[3] > y[2]}
    rows = [(r["id"], r["r_id"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_tracks(spark):
    box = lambda x: (x, 0.0, x + 10.0, 10.0)
    faces = [(0, 0, box(0.0)), (10, 0, box(1.0)), (21, 0, box(2.0)), (22, 0, box(2.0))]
    assert list(tracks_of(faces, 1, False)) == [(0, 0), (1, 0), (2, 1), (3, 1)]  # ten frames may be missed, eleven not
    assert list(tracks_of(faces, 3, False)) == []
    crossing = [(0, 0, box(0.0)), (0, 1, box(50.0)), (1, 0, box(51.0)), (1, 1, box(1.0))]
    assert sorted(tracks_of(crossing, 2, False)) == [(0, 0), (1, 1), (2, 1), (3, 0)]
    df = spark.createDataFrame([("c", 0, f, n, *b) for f, n, b in faces], "clip string, scene long, frame long, face_no long, x1 double, y1 double, x2 double, y2 double")
    assert greedy_tracks(df, ["clip", "scene"], 1).count() == 4


def _windows_by_hand(p, size, threshold, least):
    """A scan in windows that carries its last scene over, as scanners do it; see scenes_by_windows."""

    def found(values):
        out, start = [], None
        for k, v in enumerate(values):
            if v <= threshold and start is None:
                start = k
            elif v > threshold and start is not None:
                out.append((start, k))
                start = None
        if start is not None:
            out.append((start, len(values) - 1))
        return out or [(0, len(values) - 1)]

    out, carried, at, read = [], [], 0, 0
    while True:
        more = p[read : read + size]
        if not more:
            return out
        read += len(more)
        ended = len(more) < size
        window = carried + more
        own = found(window)
        if len(own) == 1 and not ended:
            carried = window
            continue
        out += [(at + a, at + b) for a, b in (own[:-1] if len(own) > 1 else own) if b - a >= least]
        carried, at = window[own[-1][0] :], at + own[-1][0]
        if ended:
            return out


def test_scenes_by_windows_against_a_scan(spark):
    rng = random.Random(12)
    series = {k: [float(rng.random() < rng.choice((0.05, 0.3, 0.9))) for _ in range(rng.randrange(1, 70))] for k in range(60)}
    series |= {100: [1.0] * 25, 101: [0.0] * 20, 102: [0.0] * 23, 103: [1.0] * 30 + [0.0] * 3, 104: [0.0] * 12 + [1.0] + [0.0] * 9 + [1.0]}
    df = spark.createDataFrame([(m, k, v) for m, values in series.items() for k, v in enumerate(values)], "movie long, frame long, p double")
    for least in (0, 2):
        got: dict[int, list] = {}
        for r in sequences.scenes_by_windows(df, ["movie"], "frame", "p", 0.5, 10, least).orderBy("movie", "start_frame").collect():
            got.setdefault(r["movie"], []).append((r["start_frame"], r["end_frame"]))
        assert {m: got.get(m, []) for m in series} == {m: _windows_by_hand(values, 10, 0.5, least) for m, values in series.items()}


def test_tracks_against_a_plain_loop():
    """The rule as a scan over frames that never skips a face, with and without faces of the frame a track ends in."""

    def by_hand(faces, least, same_frame):
        rest, out, number = sorted(range(len(faces)), key=lambda k: faces[k][:2]), [], 0
        while rest:
            track = [rest.pop(0)]
            for k in list(rest):
                (frame, _, box), (last, _, where) = faces[k], faces[track[-1]]
                if frame - last > 10:
                    break
                w, h = min(box[2], where[2]) - max(box[0], where[0]), min(box[3], where[3]) - max(box[1], where[1])
                shared = max(w, 0) * max(h, 0)
                both = (box[2] - box[0]) * (box[3] - box[1]) + (where[2] - where[0]) * (where[3] - where[1]) - shared
                if (same_frame or frame > last) and shared / (both + 1e-5) > 0.5:
                    track.append(k)
                    rest.remove(k)
            if len(track) >= least:
                out += [(k, number) for k in track]
                number += 1
        return sorted(out)

    rng = random.Random(13)
    for _ in range(60):
        faces, frame = [], 0
        for _ in range(rng.randrange(1, 40)):
            frame += rng.choice((0, 1, 1, 1, 2, 9, 10, 11))
            x = rng.choice((0.0, 40.0)) + rng.randrange(12)
            faces.append((frame, sum(f == frame for f, *_ in faces), (x, 0.0, x + 20.0, 20.0)))
        for least, same_frame in ((1, False), (2, True), (3, False)):
            assert sorted(tracks_of(faces, least, same_frame)) == by_hand(faces, least, same_frame)


def test_numbering_in_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("total")).repartition(6)
    got = resume.numbered(df, [F.col("k").desc()], "all").collect()
    assert len(got) == 5000 and all(r["number"] == 4999 - r["k"] and r["all"] == 5000 and r["total"] == "x" for r in got)
    assert resume.numbered(df.filter("false"), [F.col("k")]).count() == 0


@pytest.mark.parametrize("text", ['{"a": 1} {"a": 2}', '{"a": 1}] more', '{"a": 1}, {"a": 2}', '{"a": 1} x', "", " ", '"', "1, 2", None])
def test_one_json_value_and_nothing_else(spark, text):
    assert one(spark, texts.strict_json(F.lit(text)).isNull())
    assert one(spark, F.to_json(texts.strict_json(F.lit(' {"a": [1, {"b": null}]} ')))) == '{"a":[1,{"b":null}]}'


def test_person_images(spark):
    names = ["m/scene_1_person2.jpg", "m/scene_1_person1.JPG", "m/scene_1_person1_norm.jpg", "m/scene_2_person1.jpeg", "m/scene_2.jpg", "m/scene_1_person1.JPG"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert {r["clip"]: r["images"] for r in files.person_images(df, False).collect()} == {"scene_1": ["m/scene_1_person1.JPG", "m/scene_1_person1.JPG", "m/scene_1_person2.jpg"], "scene_2": ["m/scene_2_person1.jpeg"]}
    assert {r["clip"]: r["images"] for r in files.person_images(df, True).collect()} == {"scene_1": ["m/scene_1_person1_norm.jpg"]}
    assert sorted(r["path"] for r in files.matching(df).collect()) == sorted({n for n in names if "_person" in n})


def test_strict_lines(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"f": 1}\n{"f": 1}\n')
    bad.write_text('{"f": 1}\n{broken\n')
    assert records.strict_records(spark, str(good), "f long").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        records.strict_records(spark, str(bad), "f long").collect()


def test_event_windows(spark, tmp_path):
    rows = [("2024-01-01 00:00:05", "a"), ("2024-01-01 00:00:55", "a"), ("2024-01-01 00:01:05", "a"), ("2024-01-01 00:00:10", "b"), ("2024-01-01 00:09:00", "a")]
    spark.createDataFrame(rows, "at string, who string").write.parquet(str(tmp_path / "in"))
    counts = stages.windowed(stages.watch(spark, str(tmp_path / "in"), "at string, who string"), "at", "who", "1 minute", "10 minutes")
    counts.writeStream.outputMode("complete").format("memory").queryName("minutes").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((str(r["window"]["start"]), r["who"], r["n"]) for r in spark.table("minutes").collect())
    assert got == [("2024-01-01 00:00:00", "a", 2), ("2024-01-01 00:00:00", "b", 1), ("2024-01-01 00:01:00", "a", 1), ("2024-01-01 00:09:00", "a", 1)]


def test_chain_goes_on_with_what_is_new(spark, tmp_path):
    base, calls = str(tmp_path), []

    def work(name):
        def run(df):
            calls.append((name, df.count()))
            return df.select("k", F.when(F.col("k") % 3 == 0, F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("status"))

        return run

    chain = [("one", work("one")), ("two", work("two"))]
    spark.range(6).toDF("k").write.parquet(base + "/items")
    tables = stages.run_chain(spark, base + "/items", "k bigint", ["k"], base, chain)
    spark.range(4, 9).toDF("k").write.mode("append").parquet(base + "/items")
    stages.run_chain(spark, base + "/items", "k bigint", ["k"], base, chain)
    assert sorted(r["k"] for r in spark.read.parquet(tables["one"]).collect()) == list(range(9))
    assert sorted(r["k"] for r in spark.read.parquet(tables["two"]).collect()) == [1, 2, 4, 5, 7, 8]


def test_speaker_results(spark):
    from reelspark.functions import speakers

    rows = [('{"<char_1>": {"is_speaking": true}, "<char_2>": {"is_speaking": false}, "x": 3}', True, ["<char_1>"]), ('[{"char": "a", "is_speaking": true}, {"char_id": 5, "is_speaking": 1}, {"is_speaking": true}, 7]', True, ["5", "a"]), ("[]", False, []), ("3", False, []), ('{"a": {"is_speaking": null}}', False, []), ('[{"is_speaking": true}]', True, []), (None, False, [])]
    df = spark.createDataFrame(rows, "j string, any boolean, who array<string>")
    for r in df.withColumn("v", F.parse_json("j")).select("j", "any", "who", speakers.any_speaking(F.col("v")).alias("a"), speakers.speaking_characters(F.col("v")).alias("w")).collect():
        assert (r["a"], r["w"]) == (r["any"], r["who"]), r["j"]


def test_removed_tables(spark):
    from reelspark import scratch

    first = scratch.written(spark.range(5).toDF("k"), "gone")
    second = scratch.written(first.filter("k > 2"), "stays")
    scratch.removed(first, spark.range(3))
    assert sorted(r["k"] for r in second.collect()) == [3, 4]
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(first._scratch_path).count()


def test_empty_movies(spark):
    clips_ = spark.createDataFrame([("m", 1, None, None, None)], "movie string, clip long, duration double, has_person boolean, has_text boolean")
    dialogue = spark.createDataFrame([], "clip long, has_dialogue boolean, speakers long")
    by = stats.movie_stats(clips_, dialogue)
    assert by.first()["min_seconds"] == 0.0
    assert stats.global_stats(by.filter("false")).first()["min_seconds"] is None


def test_dataset_has_every_image(spark, tmp_path):
    """Clips with more than three images, with later ones only, and with none."""
    tables = {
        "lineitem": ([(1, k) for k in range(7, 0, -1)] + [(2, 5), (2, 4)], "l_orderkey long, l_linenumber int"),
        "orders": ([(1, 9, "F"), (2, 9, "F"), (3, 9, "F"), (4, 9, "O")], "o_orderkey long, o_custkey long, o_orderstatus string"),
        "customer": ([(9, "m")], "c_custkey long, c_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("dataset_join", "dataset_join_whole"):
        got = {r["clip"]: r["images"] for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert got == {1: ",".join(f"p{k}_norm.jpg" for k in range(1, 8)), 2: "p4_norm.jpg,p5_norm.jpg"}


def test_subtitle_lines_of_whole_texts(spark, tmp_path):
    """Lengths on both sides of the limit; ids tell nothing about what is taken."""
    rows = [(100 * k, text) for k, text in enumerate(("", "short", "a" * 72, "b" * 73, "c" * 5000, None))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("subtitle_lines", "subtitle_lines_whole"):
        got = {r["doc_id"]: r["line"] for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert got == {0: "", 100: "short", 200: "a" * 72, 300: "b" * 69 + "...", 400: "c" * 69 + "...", 500: None}


def test_shot_lists_as_files(spark, tmp_path):
    """Lines of two films, of which one is finished, written as files and read as whole texts."""
    found = spark.createDataFrame([("a", 7, 20), ("a", 0, 7), ("b", 3, 4)], "film string, start_frame long, end_frame long")
    rows = records.shot_lines(found, "film").unionByName(records.end_marks(found.filter("film = 'a'"), "film"))
    for film in ("a", "b"):
        lines = [r["line"] for r in rows.filter(F.col("film") == film).orderBy("line_no").collect()]
        (tmp_path / f"{film}.txt").write_text("\n".join(lines) + "\n")
    assert (tmp_path / "a.txt").read_text() == "0 7\n7 20\n# COMPLETE\n"
    texts = records.whole_texts(spark, str(tmp_path)).withColumn("film", F.regexp_extract("path", r"([^/]*)\.txt$", 1)).drop("path")
    read = records.lines(texts)
    assert sorted(tuple(r) for r in records.shots(read, "film").select("film", "start_frame", "end_frame").collect()) == [("a", 0, 7), ("a", 7, 20), ("b", 3, 4)]
    assert {r["film"]: r["complete"] for r in records.is_complete(read, "film").collect()} == {"a": True, "b": False}


def test_resume_and_merge(spark):
    a = spark.createDataFrame([(1, "old"), (2, "old")], "k long, v string")
    b = spark.createDataFrame([(2, "new"), (3, "new")], "k long, v string")
    assert [r["k"] for r in resume.pending(a, b, ["k"]).collect()] == [1]
    assert {r["k"]: r["v"] for r in resume.merged(a, b, ["k"]).collect()} == {1: "old", 2: "new", 3: "new"}


def test_listing_with_brackets(spark, tmp_path):
    folder = tmp_path / "Movie [X.Y]"
    folder.mkdir()
    for name in ("a.mp4", "b.MP4", "c.txt", "empty.mp4"):
        (folder / name).write_bytes(b"x" if name != "empty.mp4" else b"")
    found = files.listing(spark, str(folder))
    assert {r["name"] for r in found.collect()} == {"a", "b"}


def test_annotator_errors_stay_with_their_item(spark):
    def load():
        return lambda items: [10 // x for x in items]

    f = annotators.register_annotator("tenth", load, "long")
    got = {r["id"]: r["a"] for r in spark.range(3).select("id", f("id").alias("a")).collect()}
    assert got[1]["value"] == 10 and got[0]["value"] is None and "ZeroDivisionError" in got[0]["error"]
    assert annotators.annotator("tenth") is f


def test_stage_twice(spark, tmp_path):
    schema = "k long, v string"
    spark.createDataFrame([(k, "x") for k in range(5)], schema).write.parquet(str(tmp_path / "in"))
    run = lambda c: stages.run_stage(stages.watch(spark, str(tmp_path / "in"), schema), ["k"], str(tmp_path / "out"), str(tmp_path / c), lambda d: d, schema).awaitTermination()
    run("c1")
    run("c1")  # goes on where it stopped
    run("c2")  # starts anew and finds the output
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    stages.running_counts(stages.watch(spark, str(tmp_path / "in"), schema), "v", str(tmp_path / "c3"), "counts").awaitTermination()
    assert spark.table("counts").first()["n"] == 5
