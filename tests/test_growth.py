"""Series of any length, growing inputs, failing work, and data sources."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from reelspark.operators import attempts, segmented, sequences, tracking
from reelspark.sources import annotators, datasources, subtitles, windows
from reelspark.streaming import barrier, progress, scenes, stages


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 17])
def test_segmented_scans_do_not_depend_on_ranges(ranges, spark):
    rng = random.Random(ranges)
    rows = []
    for key in ("a", "b", None):
        value = 0.0
        for k in range(200):
            value = value if rng.random() < 0.8 else rng.choice([0.0, 0.5, 1.0])
            rows.append((key, 3 * k, None if rng.random() < 0.1 else value))
    rows += [("cuts", k, 1.0) for k in range(9)] + [("low", k, 0.0) for k in range(9)] + [("one", 5, 0.0)]
    df = spark.createDataFrame(rows, "k string, pos long, v double")
    known = df.filter("k IS NOT NULL AND v IS NOT NULL")
    assert rows_of(segmented.scenes_of(known, ["k"], "pos", "v", 0.4, ranges)) == rows_of(sequences.scenes(known, ["k"], "pos", "v", 0.4))
    want = sequences.segments_above(known, ["k"], "pos", "v", 0.5, 4).select("k", "start", "end", "duration")
    assert rows_of(segmented.segments_of(known, ["k"], "pos", "v", 0.5, 4, ranges).select("k", "start", "end", "duration")) == rows_of(want)
    want = sequences.carried_forward(known, ["k"], "pos", F.when(F.col("v") > 0.4, F.col("pos")), "held")
    got = segmented.carried(known, ["k"], "pos", F.when(F.col("v") > 0.4, F.col("pos")), "held", ranges)
    assert rows_of(got.select(want.columns)) == rows_of(want)
    assert segmented.scenes_of(known.limit(0), ["k"], "pos", "v", 0.4).count() == 0


def test_no_task_of_a_scan_holds_more_than_a_range(spark):
    """One series of 400,000 rows: every window of the plan is by range, or over the rows of ranges."""
    df = spark.range(400_000).select(F.lit(0).alias("k"), F.col("id").alias("pos"), (F.col("id") % 1000 == 7).cast("double").alias("v"))
    rows = segmented.ranged(df, ["k"], "pos", 16)
    sizes = [r["n"] for r in rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 12 and max(sizes) < 2.5 * 400_000 / len(sizes)
    found = segmented.scenes_of(df, ["k"], "pos", "v", 0.5, 16)
    assert found.count() == 401 and found.agg(F.max("end_frame")).first()[0] == 399_999


@pytest.mark.parametrize("ranges", [1, 5])
def test_asof_equals_a_loop(ranges, spark):
    rng = random.Random(8)
    left = [(rng.choice("xyz"), rng.choice([None, float(rng.randrange(500))]), k) for k in range(150)]
    right = [(rng.choice("xy"), float(rng.randrange(0, 500, 37)), k) for k in range(60)] + [("x", None, -1)]
    want = []
    for key, t, k in left:
        fits = [(u, v) for other, u, v in right if other == key and u is not None and t is not None and u <= t]
        best = max(fits) if fits else (None, None)
        far = fits and t - best[0] > 100
        want.append((key, t, k, *(best if not far else (None, None))))
    a, b = spark.createDataFrame(left, "k string, t double, id long"), spark.createDataFrame(right, "k string, t double, v long")
    got = segmented.asof(a, b, ["k"], "t", ["v"], 100, ranges)
    assert got.columns == ["k", "t", "id", "right_time", "v"]
    assert rows_of(got) == sorted(want, key=repr)
    assert rows_of(segmented.asof(a, b.limit(0), ["k"], "t", ["v"])) == sorted([(*r, None, None) for r in left], key=repr)
    assert segmented.asof(a.limit(0), b, ["k"], "t", ["v"]).count() == 0


def test_windowed_models(spark):
    loads = tempfile.mkdtemp(prefix="spark-loads-")

    def load():
        tempfile.mkstemp(dir=loads)

        def run(items):
            if any(13.0 in v for v in items):
                raise ValueError("unlucky")
            return [v[:-1] if 50.0 in v else list(v) for v in items]

        return run

    annotate = annotators.register_annotator("echo", load, "array<double>")
    df = spark.createDataFrame([("m", k, float(k)) for k in range(100) if k != 70] + [("n", 0, 5.0)], "k string, pos long, v double").repartition(4)
    got = {(r["k"], r["pos"]): (r["said"], r["error"]) for r in windows.windowed(df, ["k"], "pos", "v", annotate, 10, 2, "said").collect()}
    assert len(got) == 100 and got["n", 0] == (5.0, None)
    for (key, pos), (said, error) in got.items():
        if key == "m":
            window = range(pos // 6 * 6 - 2, pos // 6 * 6 + 8)
            assert (said, error) == ((None, "ValueError: unlucky") if 13 in window else (None, "another number of results than values") if 50 in window else (float(pos), None))
    assert len(os.listdir(loads)) <= 8  # once a task, not once a window
    with pytest.raises(ValueError):
        windows.windowed(df, ["k"], "pos", "v", annotate, 4, 2, "said")


def test_barrier_tells_once(spark):
    base = tempfile.mkdtemp(prefix="spark-barrier-")
    schema = "film string, kind string, item string"

    def told(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(base + "/in")
        done = barrier.stream_barrier(stages.watch(spark, base + "/in", schema)).writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/checkpoint")
        with barrier.rocksdb(spark):
            done.trigger(availableNow=True).start().awaitTermination()
        return rows_of(spark.read.schema("film string, items long").parquet(base + "/out"))

    assert told(("a", "found", "1"), ("a", "through", "2"), ("b", "upstream_done", None), (None, "found", "1"), ("c", "odd", "1")) == [("b", 0)]
    assert told(("a", "upstream_done", None), ("a", "found", "2"), ("c", "upstream_done", None), ("c", "found", "9")) == [("b", 0)]
    assert told(("a", "through", "1"), ("b", "found", "5")) == [("a", 2), ("b", 0)]
    assert told(("a", "upstream_done", None), ("a", "through", "1"), ("b", "through", "5"), ("c", "through", "9")) == [("a", 2), ("b", 0), ("c", 1)]


def test_scenes_of_growing_films(spark):
    """Any cut of the input into runs gives the same scenes, and a run reads only its own frames."""
    rng = random.Random(9)
    films = {m: [rng.choice([0.1, 0.1, 0.1, 0.9]) for _ in range(60)] for m in "ab"} | {"cuts": [0.9] * 10, "late": [0.1] * 5}
    rows = [(m, k, p) for m, ps in films.items() for k, p in enumerate(ps)]
    schema = "movie string, frame long, p double"
    want = rows_of(sequences.scenes(spark.createDataFrame(rows, schema), ["movie"], "frame", "p", 0.5))
    for cuts in ([30], [1, 2, 40], []):
        base = tempfile.mkdtemp(prefix="spark-growing-")
        edges = [0, *cuts, 100]
        for number, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            part = [r for r in rows if a <= r[1] < b and not (r[0] == "late" and number < len(edges) - 2)]
            part += [r for r in rows if r[0] == "late"] if number == len(edges) - 2 and a else []
            spark.createDataFrame(part + part[:1], schema).write.mode("append").parquet(base + "/in")
            q = scenes.grow_scenes(stages.watch(spark, base + "/in", schema), base, base + "/checkpoint", 0.5)
            q.awaitTermination()
            assert sum(p["numInputRows"] for p in q.recentProgress) == len(part) + 1
        assert rows_of(scenes.scenes_so_far(spark, base, len(edges) - 1)) == want


def test_first_success_tries_nothing_twice(spark):
    items = spark.createDataFrame([(k, "x") for k in range(30)] + [(3, "again")], "id long, note string")
    fails = lambda bad: lambda df: df.withColumn("value", F.when(~bad, F.concat(F.lit("v"), "id"))).withColumn("error", F.when(bad & (F.col("id") % 2 == 0), F.lit("e")))
    candidates = [("one", fails(F.col("id") >= 10)), ("two", fails(F.col("id") >= 20)), ("three", fails(F.col("id") >= 25))]
    results, tries = attempts.first_success(items, ["id"], candidates)
    got = {r["id"]: (r["candidate"], r["value"], r["error"]) for r in results.collect()}
    for k in range(30):
        name = "one" if k < 10 else "two" if k < 20 else "three" if k < 25 else None
        assert got[k] == (name, f"v{k}" if name else None, None if name else "e" if k % 2 == 0 else "no value")
    assert {(r["candidate"]): r["count"] for r in tries.groupBy("candidate").count().collect()} == {"one": 30, "two": 20, "three": 10}
    assert attempts.first_success(items, ["id"], [])[0].filter("candidate IS NULL").count() == 30


@pytest.mark.parametrize("policy", [attempts.RETRY, attempts.FAIL, attempts.EMPTY])
def test_policies(policy, spark):
    log = tempfile.mkdtemp(prefix="spark-log-") + "/log"
    items = spark.createDataFrame([(k,) for k in range(12)], "id long")
    work = lambda df: df.withColumn("value", F.when(F.col("attempt") > F.col("id") % 4, F.lit("v"))).withColumn("error", F.lit(None).cast("string"))
    counts = [attempts.poll(spark, items, ["id"], log, work, policy, 3).count() for _ in range(5)]
    assert counts == ([12, 9, 6, 0, 0] if policy == attempts.RETRY else [12, 0, 0, 0, 0])
    got = {r["id"]: (r["attempts"], r["status"], r["value"]) for r in attempts.outcome(attempts.logged(spark, log), ["id"]).collect()}
    for k in range(12):
        ok = k % 4 == 0 or policy == attempts.RETRY and k % 4 < 3
        tries = min(k % 4 + 1, 3) if policy == attempts.RETRY else 1
        assert got[k] == (tries, "COMPLETED" if ok or policy == attempts.EMPTY else "FAILED", "v" if ok else None)


def as_looped(faces, least):
    """Takes faces out of the lists it goes over, so the one after a face that is taken is passed over."""
    frames, out, number = {}, [], 0
    for k in sorted(range(len(faces)), key=lambda k: faces[k][:2]):
        frames.setdefault(faces[k][0], []).append(k)
    lists = [frames[f] for f in sorted(frames)]
    while True:
        track = []
        for own in lists:
            for k in own:
                if not track:
                    track.append(k)
                    own.remove(k)
                elif faces[k][0] - faces[track[-1]][0] <= 10:
                    a, b = faces[k][2], faces[track[-1]][2]
                    shared = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
                    both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared
                    if shared / (both + 1e-5) > 0.5:
                        track.append(k)
                        own.remove(k)
                else:
                    break
        if not track:
            return sorted(out)
        if len(track) >= least:
            out += [(k, number) for k in track]
            number += 1


def test_tracks_as_a_removing_loop(spark):
    rng = random.Random(14)
    rows, want = [], []
    for clip in range(25):
        faces, frame = [], 0
        for _ in range(rng.randrange(1, 60)):
            frame += rng.choice((0, 0, 1, 1, 2, 9, 10, 11, 30))
            x = rng.choice((0.0, 40.0)) + rng.randrange(12)
            faces.append((frame, sum(f == frame for f, *_ in faces), (x, 0.0, x + 20.0, 20.0)))
        least = 2
        found = as_looped(faces, least)
        assert sorted(tracking.tracks_of(faces, least, True, True)) == found
        rows += [(clip, f, n, *b) for f, n, b in faces]
        want += [(clip, faces[k][0], faces[k][1], t) for k, t in found]
    df = spark.createDataFrame(rows, "clip long, frame long, face_no long, x1 double, y1 double, x2 double, y2 double")
    got = tracking.greedy_tracks(df, ["clip"], 2, same_frame=True, skipping=True)
    assert rows_of(got) == sorted(want, key=repr)


def test_sources_and_sink(spark):
    datasources.register(spark)
    base = tempfile.mkdtemp(prefix="spark-files-")
    text = "1\n00:00:01,000 --> 00:00:02,000\n[A] one\n\nx\n00:00:02,000 --> 00:00:02,500\n[SPEAKER_02] hi\n\n00:00:03,000 --> 00:00:04,000\ntwo\nlines\n\n3\n00:00:05.000 --> 00:00:06,000\nbad\n\n8\n00:00:06,000 --> 00:00:07,000\nUNKNOWN:\n\n7\n00:00:07,000 --> 00:00:07,000\nempty\n"
    rows = [("a.srt", text), ("b/c.srt", "﻿" + text.replace("\n", "\r\n")), ("d.srt", ""), ("e.txt", "0 10\n# note\n 10 25 x\nbad\n# COMPLETE\n"), ("f.jsonl", '{"a": 1}\n\n[1]\nbroken\n{"b": 2}')]
    files = spark.createDataFrame(rows, "name string, text string")
    files.write.format("entity_files").mode("append").save(base)
    assert sorted(os.listdir(base)) == ["a.srt", "b", "d.srt", "e.txt", "f.jsonl"]
    with open(f"{base}/b/c.srt", encoding="utf-8", newline="") as f:
        assert f.read() == rows[1][1]
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("k")
    got = rows_of(spark.read.format("srt").load(base).select(name, "idx", "start", "end", "text"))
    named = files.filter("name LIKE '%.srt'").select(F.regexp_extract("name", r"([^/]+)$", 1).alias("k"), "text")
    assert got == rows_of(subtitles.srt_cues(named, "k")) and len(got) == 6
    assert rows_of(spark.read.format("shot_list").load(base).drop("path")) == [(0, 0, 10, True), (2, 10, 25, True)]
    assert rows_of(spark.read.format("record_lines").load(base).drop("path")) == [(0, '{"a": 1}'), (4, '{"b": 2}')]
    named.createOrReplaceTempView("named_texts")
    assert rows_of(spark.sql("SELECT k, x.* FROM named_texts, LATERAL explode_srt(text) x")) == got
    # The same files as a stream, in two runs.
    out, checkpoint = base + "-out", base + "-checkpoint"

    def run():
        q = spark.readStream.format("srt").load(base).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 6
    spark.createDataFrame([("g.srt", text)], "name string, text string").write.format("entity_files").mode("append").save(base)
    assert run() == 9


def test_sink_leaves_nothing_of_failures(spark):
    datasources.register(spark)
    base = tempfile.mkdtemp(prefix="spark-files-")
    write = lambda df, mode="append": df.write.format("entity_files").mode(mode).save(base)
    good = spark.createDataFrame([(f"{k}.txt", str(k)) for k in range(20)], "name string, text string").repartition(4)
    for bad in ("../x", "/x", ""):
        with pytest.raises(Exception):
            write(good.union(spark.createDataFrame([(bad, "x")], good.schema)))
        assert os.listdir(base) == []
    with pytest.raises(Exception):
        write(good.union(good))
    assert os.listdir(base) == []
    write(good)
    with pytest.raises(Exception):
        write(good.withColumn("text", F.lit("new")))
    assert len(os.listdir(base)) == 20 and open(f"{base}/7.txt").read() == "7"
    write(good.withColumn("text", F.lit("new")), "overwrite")
    assert open(f"{base}/7.txt").read() == "new"


def test_progress_of_a_stream(spark):
    base = tempfile.mkdtemp(prefix="spark-progress-")
    spark.createDataFrame([("COMPLETED",), ("FAILED",), ("FAILED",), (None,)], "status string").write.parquet(base + "/in")
    listener = progress.ProgressTable(spark, base + "/progress")
    spark.streams.addListener(listener)
    try:
        items = progress.observed_stream(stages.watch(spark, base + "/in", "status string"))
        items.writeStream.queryName("stage_x").format("noop").option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if os.path.exists(base + "/progress/_SUCCESS"):
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    got = spark.read.parquet(base + "/progress").filter("rows > 0").collect()
    assert [(r["query"], r["input_rows"], r["rows"], r["COMPLETED"], r["FAILED"], r["other"]) for r in got] == [("stage_x", 4, 4, 1, 2, 1)]


def test_many_files_are_few_partitions(spark):
    """A task reads many small files; a commit moves files of many folders."""
    datasources.register(spark)
    base = tempfile.mkdtemp(prefix="spark-many-")
    name = F.concat((F.col("id") % 3).cast("string"), F.lit("/"), (F.col("id") % 7).cast("string"), F.lit("/"), F.col("id").cast("string"), F.lit(".jsonl"))
    files = spark.range(700).select(name.alias("name"), F.concat(F.lit('{"a": '), F.col("id").cast("string"), F.lit("}")).alias("text")).repartition(3)
    files.write.format("entity_files").mode("append").save(base)
    read = spark.read.format("record_lines").load(base)
    assert 2 <= read.rdd.getNumPartitions() <= 20
    assert rows_of(read.select(F.regexp_extract("path", r"(\d+)\.jsonl$", 1).cast("long"), "line")) == sorted([(k, f'{{"a": {k}}}') for k in range(700)], key=repr)
    with pytest.raises(Exception):
        files.limit(5).write.format("entity_files").mode("append").save(base)
    assert sorted(os.listdir(base)) == ["0", "1", "2"]


def test_partitions_of_files():
    sizes = lambda files: [len(p.paths) for p in datasources._packed(files)]
    small = [(k, f"{k}.srt", 5000) for k in range(1_000_001)]
    assert len(sizes(small)) <= 1000 and sum(sizes(small)) == len(small) and sizes([]) == []
    assert sizes([(0, "a", 1), (1, "b", 1 << 30), (2, "c", 1 << 30), (3, "d", 1), (4, "e", 1)]) == [1, 1, 1, 2]
    assert [p for part in datasources._packed(small[:250]) for p in part.paths] == [p for _, p, _ in small[:250]]


def test_barrier_keeps_counts_a_film(spark):
    """Events of random kinds, order and repetition, against sets; what Python keeps is a row a film, items are told apart by Spark."""
    rng = random.Random(21)
    base = tempfile.mkdtemp(prefix="spark-barrier-")
    schema = "film string, kind string, item string"
    found, through, upstream, want = {}, {}, set(), {}
    for run in range(4):
        rows = []
        for _ in range(400):
            film, item = f"f{rng.randrange(12)}", rng.choice([None, "found", "through", "", *map(str, range(int(5 + run)))])
            kind = rng.choice(["found", "through", "through", "through"] + ["upstream_done"] * (run > 0))
            rows.append((film, kind, item))
        rows += [(f"f{k}", "through", i) for k in range(12) for i in [None, "found", "through", "", *map(str, range(9))] if k % 3 == 0 or run == 3 and k != 7]
        for film, kind, item in rows:
            {"found": found, "through": through}[kind].setdefault(film, set()).add(item) if kind != "upstream_done" else upstream.add(film)
        for film in upstream:
            if not found.get(film, set()) - through.get(film, set()):
                want.setdefault(film, len(found.get(film, ())))
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(base + "/in")
        done = barrier.stream_barrier(stages.watch(spark, base + "/in", schema)).writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/checkpoint")
        with barrier.rocksdb(spark):
            q = done.trigger(availableNow=True).start()
            q.awaitTermination()
        assert rows_of(spark.read.schema("film string, items long").parquet(base + "/out")) == sorted(want.items(), key=repr)
    kept = {o["operatorName"]: o["numRowsTotal"] for o in [p for p in q.recentProgress if p["numInputRows"]][-1]["stateOperators"]}
    assert kept["transformWithStateInPandasExec"] == 12 and kept["dedupe"] > 12


def test_patience_of_the_barrier(spark):
    """Told once, by a timer, after a quiet while."""
    import time

    base = tempfile.mkdtemp(prefix="spark-barrier-")
    schema = "film string, kind string, item string"
    rows = [("a", "found", "1"), ("a", "through", "1"), ("a", "upstream_done", None), ("b", "upstream_done", None), ("c", "found", "1"), ("c", "upstream_done", None)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(base + "/in")
    done = barrier.stream_barrier(stages.watch(spark, base + "/in", schema), patience=0.2).writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/checkpoint")
    with barrier.rocksdb(spark):
        q = done.trigger(processingTime="1 second").start()
    try:
        for _ in range(120):
            time.sleep(0.5)
            batches = [p["batchId"] for p in q.recentProgress]
            if q.exception() or batches and max(batches) >= 3:
                break
    finally:
        q.stop()
    assert not q.exception()
    assert rows_of(spark.read.schema("film string, items long").parquet(base + "/out")) == [("a", 1), ("b", 0)]
