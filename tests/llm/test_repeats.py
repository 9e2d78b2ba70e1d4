"""Repeated passages, collocations and hard negatives against brute force, and on rows that are out of the ordinary."""

from __future__ import annotations

import math
import os
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm import collocations, exact_dedup, hard_negatives, jaccard, line_dedup, shingles, substring_dedup, toxicity
from reelspark.llm.blocks import blocked
from reelspark.llm.words import hashes, joined, new_seed, rolled, spans

DOCS = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("block", "tile", "id", "ids", "texts", "answers", "n", "rank", "label", "phrase", "score", "a", "langs")


def clashing(df):
    for name in CLASH:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


def test_word_hashes_tell_words_apart():
    """Also the Thue-Morse word and its complement, which polynomials modulo 2^64 confuse, and zero bytes."""
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    words = [thue, thue.translate(str.maketrans("ab", "ba")), "a", "a\0", "\0a", "ab", "b" * 8, "b" * 9, "b" * 16, "é", "é", *map(str, range(2000))]
    data = joined([w.encode() for w in words])
    got = hashes(data, *spans(data), new_seed())
    assert len(got) == len(words) == len(set(got.tolist()))
    seed = new_seed()
    for texts in (["x y x y"], ["x", "y x", "y"]):
        data = joined([t.encode() for t in texts])
        h = hashes(data, *spans(data), seed)
        assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1]
    for k in range(1, 25):
        runs = rolled(got, k)
        assert len(runs) == len(got) - k + 1 == len(set(runs.tolist()))
    assert not len(rolled(got[:3], 4))


def loop_drop(rows, window):
    """Rows (id, text) in order: words, words gone, and what is left, by the first start of each window."""
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    words = [WORD.findall(t or "") for _, t in rows]
    for d in order:
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), (d, i))
    for d, (doc_id, _) in enumerate(rows):
        gone = set()
        for i in range(len(words[d]) - window + 1):
            if first[tuple(words[d][i : i + window])] != (d, i):
                gone |= set(range(i, i + window))
        out.append((doc_id, len(words[d]), len(gone), " ".join(w for k, w in enumerate(words[d]) if k not in gone)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_a_loop(seed, spark):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdé") * rng.randint(1, 12) for _ in range(rng.randint(3, 30))] for _ in range(12)]
    rows = []
    for k in range(150):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [str(rng.random()) for _ in range(rng.randint(1, 9))]
        rows.append((k - 50 if k % 10 else (1 << 63) - 1 - k, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(None, "only here " * 3), (1000, None), (1001, ""), (1002, "\x0b \r")]
    df = clashing(spark.createDataFrame([(*r, "en") for r in rows], DOCS).repartition(5))
    got = substring_dedup.drop_repeats(df, window=5, block_bytes=400, tile_bytes=300)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, loop_drop(rows, 5)))


def test_repeats_of_ids_and_none(spark):
    """Rows that share an id, or have none, are documents: of equal ones exactly one keeps its words; ids go before none."""
    text = " ".join(map(str, range(30)))
    for rows, whole in (([(None, text)] * 3, 1), ([(7, text)] * 3, 1), ([((1 << 63) - 1, text), (None, text)], 1)):
        for parts in (1, 3):
            df = spark.createDataFrame([(*r, "en") for r in rows], DOCS).repartition(parts)
            got = substring_dedup.drop_repeats(df).collect()
            assert sorted(r["n_removed"] for r in got) == [0] * whole + [30] * (len(rows) - whole)
            if rows[0][0] and rows[1][0] is None:
                assert [r["n_removed"] for r in got if r["doc_id"] is None] == [30]
    assert substring_dedup.drop_repeats(spark.createDataFrame([], DOCS)).count() == 0
    long = " ".join(f"w{k}" for k in range(200_000))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.drop_repeats(spark.createDataFrame([(2, long + " end", "x"), (1, long, "x")], DOCS)).collect()}
    assert got == {1: (200_000, 0), 2: (200_001, 200_000)}


def loop_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    gone = set()
    for (lang, p), (_, a, _, _) in found.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                part = lang, p[i : i + m]
                if 100 * a >= 80 * f[part]:
                    gone.add(part)
    out = []
    for lang in n:
        own = sorted((-s, -a, " ".join(p).encode(), l, r) for (x, p), (s, a, l, r) in found.items() if x == lang and (x, p) not in gone)
        out += [(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(own[:top])]
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_phrases_equal_a_loop(seed, spark):
    rng = random.Random(seed)
    words = ["a", "B", "b", "ça", "d", "new", "York", "é", "x" * 40]
    rows = [(k, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "fr", None, "und", ""])) for k in range(200)]
    rows += [(None, None, "en"), (1, "...", "de"), (2, "", None), (3, "the same words here " * 40, "xx")]
    df = clashing(spark.createDataFrame(rows, DOCS).repartition(4))
    got = collocations.mine_phrases(df, least=6, top=25, shard_bytes=700, tile_words=100)
    assert sorted(map(tuple, got.collect())) == sorted(loop_phrases(rows, 6, 25))
    assert collocations.mine_phrases(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.mine_phrases(spark.createDataFrame([(1, None, None), (2, " . ", "en")], DOCS)).count() == 0


def test_scores_are_exact():
    rng = random.Random(5)
    a = [rng.randint(1, 1 << 51) for _ in range(2000)]
    both = [2 * x + rng.randint(0, 1 << 51) for x in a]
    assert collocations.scores(np.array(a), np.array(both)).tolist() == [2_000_000 * x // y for x, y in zip(a, both, strict=True)]


def test_phrase_shards_are_small_and_go_when_compact(spark, monkeypatch):
    """A shard of the usual size takes some tens of MB in Python, and the first table of shards does not stand beside all later ones."""
    rng = random.Random(3)
    text = b" ".join(b"%x" % rng.getrandbits(16) for _ in range(collocations.SHARD_BYTES // 5))
    tracemalloc.start()
    collocations.encoded([text], ["en"], (1, 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20, peak
    stood, written = {}, scratch.written

    def watched(df, name, *a):
        out = written(df, name, *a)
        stood[name] = out._scratch_path, [n for n, (p, _) in stood.items() if os.path.exists(p)]
        return out

    monkeypatch.setattr(scratch, "written", watched)
    df = spark.createDataFrame([(k, "en", "a b c. d e") for k in range(40)], "doc_id long, lang string, text string")
    assert [(r["phrase"], r["a"], r["n"]) for r in collocations.mine_phrases(df).orderBy("rank").collect()] == [("a b c", 40, 200), ("d e", 40, 200)]
    assert stood["phrase-pairs"][1] == ["phrase-sizes", "phrase-compact"]


def test_phrase_shards_hold_no_keys(spark, monkeypatch):
    """Tables of shards are little larger than their texts though each word is new to its shard; keys alone would be 16 bytes a word."""
    rng = random.Random(8)
    words = [f"{k:06x}" for k in rng.sample(range(1 << 24), 3000)]
    rows = [(k, "en", " ".join(rng.sample(words, 1500))) for k in range(40)]
    sizes, written = {}, scratch.written

    def watched(df, name, *a):
        out = written(df, name, *a)
        sizes[name] = sum(os.path.getsize(f"{out._scratch_path}/{f}") for f in os.listdir(out._scratch_path) if f.endswith(".parquet"))
        return out

    monkeypatch.setattr(scratch, "written", watched)
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1)
    collocations.mine_phrases(df, least=2, shard_bytes=15_000).count()
    texts = sum(len(text) for _, _, text in rows)
    assert sizes["phrase-shards"] < 2 * texts and sizes["phrase-compact"] < 2 * texts, (sizes, texts)
    shard = {"langs": ["en"]} | collocations.encoded([b"Bb a, bb c"], ["en"], (1, 2))
    one, two = collocations._word_keys(shard, (1, 2))
    assert (np.diff(one.astype(object)) > 0).all() and len(set(two.tolist())) == 3 and sorted(shard["vocabulary"].split()) == [b"a", b"bb", b"c"]


def test_phrase_shards_are_stored_and_sent_one_at_a_time(spark, monkeypatch):
    """Tables of shards have a row group a shard, so that no task holds all shards of a file at once; and few shards go to Python together."""
    groups, sent, written = {}, {}, scratch.written

    def watched(df, name, *a):
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        out = written(df, name, *a)
        files = [f"{out._scratch_path}/{f}" for f in os.listdir(out._scratch_path) if f.endswith(".parquet")]
        metas = [pq.read_metadata(f) for f in files]
        groups[name] = max((m.row_group(k).num_rows for m in metas for k in range(m.num_row_groups)), default=0)
        if name in ("phrase-shards", "phrase-compact"):
            sent[name] = written(out.mapInArrow(sizes, "n long"), "sizes", *a).agg(F.max("n")).first()[0]
        return out

    monkeypatch.setattr(scratch, "written", watched)
    rng = random.Random(9)
    words = [f"{k:05x}" for k in rng.sample(range(1 << 20), 20_000)]
    rows = [(k, "en", " ".join(rng.choices(words, k=100_000))) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1)
    collocations.mine_phrases(df, least=2, shard_bytes=700_000).count()
    assert groups["phrase-shards"] == groups["phrase-compact"] == 1, groups
    assert max(sent.values()) <= 2, sent


def test_blocks_have_row_groups_of_their_own(spark):
    """No task holds all blocks of a file at once."""
    table = blocked(spark.createDataFrame([(k, f"some words {k} " * 40, "en") for k in range(12)], DOCS).coalesce(1), "doc_id", "text", size=1200)
    metas = [pq.read_metadata(f"{table._scratch_path}/{f}") for f in os.listdir(table._scratch_path) if f.endswith(".parquet")]
    groups = [m.row_group(k).num_rows for m in metas for k in range(m.num_row_groups)]
    assert len(groups) > 3 and max(groups) == 1, groups
    assert sorted(x for r in table.collect() for x in r["ids"]) == list(range(12))


def loop_negatives(rows, positives=5, negatives=3):
    usable = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * x) for x in v]
        if sum(x * x for x in w) < 1 << 62:
            usable.append((i, w, label))
    out = []
    for i, q, label in usable:
        if i % 3:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, w, strict=True)), j, other == label) for j, w, other in usable if j != i and len(w) == len(q))
        for s, j, _ in [x for x in scored if x[2]][:positives]:
            fits = [(t, k) for t, k, alike in scored if not alike and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fits[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("pull", [0.0, 2.0])
def test_negatives_equal_a_loop(pull, spark, monkeypatch):
    """Clusters, ties, odd rows, several lengths, large components; chunks and blocks of anchors are small."""
    for name, value in (("CHUNK", 16), ("ANCHOR_BLOCK", 20), ("STEP", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 8))
    rows = []
    for k in range(200):
        label = int(rng.integers(0, 4))
        v = (pull * centres[label] + rng.normal(size=8)).round(1).tolist()
        rows.append((k, v, label))
    rows += [(k, [float(x) for x in rng.integers(-2, 3, 3)], k % 2) for k in range(300, 330)]
    rows += [(k, [1e6 * x, -1e-20, 2.0**20], k % 2) for k, x in zip(range(400, 410), rng.normal(size=10).tolist(), strict=True)]
    rows += [(501, None, 1), (502, [None] * 8, 1), (503, [float("nan")] * 8, 1), (504, [1.0] * 8, None), (None, [1.0] * 8, 1), (505, [math.inf] * 8, 0), (507, [1e30] * 8, 0), (510, [0.0] * 8, 0), (513, [], 1), (516, [], 0)]
    schema = "vec_id long, embedding array<double>, label long"
    df = clashing(spark.createDataFrame(rows, schema).repartition(3))
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 3 == 0, F.col("label"))
    assert sorted(map(tuple, got.collect())) == loop_negatives(rows)
    assert hard_negatives.hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 3 == 0, F.col("label")).count() == 0


def test_brackets_hold_and_prune(spark, data):
    """No score is outside its bracket, and on clustered vectors few rows are scored."""
    rng = np.random.default_rng(7)
    x = np.floor(40 * (np.repeat(rng.normal(size=(8, 16)) * 4, 100, axis=0) + rng.normal(size=(800, 16))))
    top = (x * x).sum(1).max()
    pivots = hard_negatives.Pivots(x[::50], top)
    q = x[::40]
    scores, to_q, to_x = q @ x.T, pivots.of_anchors(q), pivots.of_rows(x)
    near = np.abs(to_q[:, None] - to_x[None]).max(axis=2)
    far = (to_q[:, None] + to_x[None]).min(axis=2)
    low, high = hard_negatives.brackets((q * q).sum(1)[:, None] + top, near, far)
    assert ((low <= scores) & (scores <= high)).all()
    tenth = np.sort(scores, axis=1)[:, -10, None]
    assert (high >= tenth).mean() < 0.5


def test_links_are_not_made_by_hash_collisions(spark):
    """Long words that polynomials modulo 2^64 confuse share no shingle, in one text or in two."""
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = thue.translate(str.maketrans("ab", "ba"))
    rows = [(1, thue, "en"), (2, other, "en"), (3, " ".join([thue] * 9), "en"), (4, " ".join([other] * 9), "en"), (5, thue.upper(), "en")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_the_largest_id_is_an_id(spark):
    most = (1 << 63) - 1
    for rows, keep in (
        ([(most, "a b"), (most - 1, "c")], {most: (most, True), most - 1: (most - 1, True)}),
        ([(most, "a b"), (None, "a  b"), (None, "x")], {most: (None, False), None: (None, True)}),
        ([(most, "a b"), (None, "a b"), (-(1 << 63), "c")], {most: (most, True), None: (most, False), -(1 << 63): (-(1 << 63), True)}),
        ([(-(1 << 63), "a b"), (most, "a b"), (None, "ab ")], {-(1 << 63): (-(1 << 63), True), most: (-(1 << 63), False), None: (-(1 << 63), False)}),
    ):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for r in exact_dedup.exact_duplicates(df).collect():
            if not (r["doc_id"] is None and r["group_size"] == 1):
                assert (r["keep_id"], r["kept"]) == keep[r["doc_id"]]
        assert exact_dedup.drop_duplicates(df).count() == exact_dedup.keep_one_row(df).count() == len({t.replace(" ", "") for _, t in rows})


def test_rows_keep_their_own_columns(spark):
    """Also those that are named like the key that the operators number rows with."""
    rows = [(1, "a b c d e f", "mine", 7, "x"), (2, "a b c d e f", "yours", 8, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, row_ int, __row string")
    for keep in (exact_dedup.keep_one_row, jaccard.keep_one_row):
        assert [tuple(r) for r in keep(df).collect()] == [rows[0]]


def test_two_page_hosts(spark):
    pages = spark.createDataFrame([(1, "h", ["menu", "one"]), (2, "h", ["menu", "two"]), (3, "solo", ["menu", "three"])], "page_id long, host string, lines array<string>")
    got = {r["page_id"]: r["text"] for r in line_dedup.drop_site_lines(pages, "page_id", F.col("host"), F.col("lines")).collect()}
    assert got == {1: "one", 2: "two", 3: "menu\nthree"}


def test_the_pipeline_leaves_one_table_a_run(spark, data):
    import os

    import corpus_pipeline
    from reelspark import scratch

    folder = scratch.app_dir(spark)
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    found = corpus_pipeline.run(spark, data)
    left = {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before}
    assert found.count() > 0 and left == {"pipeline-mixing", "pack-pieces"}


def test_long_texts_in_pieces(monkeypatch):
    """Pieces give the sets and features of the whole, wherever they are cut; a long word is not cut."""
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["ab", "C", "é" * 9, "long" * 30, "x\ty", "\n"]) for _ in range(n)).encode() for n in (1, 3, 4, 5, 6, 40, 300)] + [b"w" * 500, b" \n", b"a " * 200, b"q" * 300 + b" r s t u v"]
    want = [[s.tolist() for s in shingles.shingle_sets(texts, k, 7)] for k in (1, 2, 5)]
    features = [set(f.tolist()) for t in texts for _, _, f in toxicity._features([t])]
    for size in (1, 16, 100):
        monkeypatch.setattr(shingles, "CHUNK_BYTES", size)
        monkeypatch.setattr(toxicity, "CHUNK_BYTES", size)
        assert [[s.tolist() for s in shingles.shingle_sets(texts, k, 7)] for k in (1, 2, 5)] == want
        assert [set(f.tolist()) for t in texts for _, _, f in toxicity._features([t])] == features
