"""The corpus operators against brute force, and on rows that are out of the ordinary."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark import scratch
from reelspark.llm import ann, exact_dedup, html_extract, jaccard, line_dedup, mixing, packing, tokens, toxicity, url_filter
from reelspark.llm.components import components
from reelspark.llm.queries import QUERIES, SQL
from reelspark.llm.sampling import about
from reelspark.llm.shingles import shingle_sets
from reelspark.llm.signature_tree import linking_pairs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns named like what operators make inside.
CLASH = ("key", "rank", "digest", "size", "cluster", "label", "bin", "shard", "host", "target", "repeats", "doc", "p", "n")


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, data, same):
    same(QUERIES[name](spark, data), SQL[name])


def odd_docs(spark):
    """Nulls, blanks, ties, repeats, long texts, and columns with clashing names."""
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [
        (1, "a b c d e f g", "en", "s1", 1), (2, "a  b c d e f\tg", "en", "s2", 1), (2, "a  b c d e f\tg", "en", "s2", 1), (3, "", "en", None, 1), (4, None, None, "", None),
        (5, "\n \t", "en", "s1", 1), (6, long, "en", "s1", 1), (7, long + " end", "en", "s3", 1), (None, "a b c d e f g", "en", "s1", 1), (None, None, None, None, None),
        (8, "x" * 50_000, "en", "s2", 1), (9, "short", "en", "s2", 1), (10, "SHORT", "en", "s2", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in CLASH:
        df = df.withColumn(name, F.lit("x"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_samples_keep_their_size(spark):
    """Also where the share is far below a millionth: the bound is told, not rounded to none."""
    hashes = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    for wanted in (0, 10, 1_000, 150_000):
        got = hashes.filter(about(F.col("h"), wanted, 200_000)).count()
        assert abs(got - wanted) <= 6 * wanted**0.5
    assert hashes.filter(about(F.col("h"), 200_000, 200_000)).count() == 200_000
    lowest = -(1 << 63)
    tiny = spark.createDataFrame([(lowest + 5_000,), (lowest + 20_000,)], "h long")
    assert [r["h"] for r in tiny.filter(about(F.col("h"), 1, (1 << 64) // 10_000)).collect()] == [lowest + 5_000]
    assert spark.createDataFrame([], "h long").filter(about(F.col("h"), 5, 0)).count() == 0


# --- exact duplicates


def test_exact_duplicates(spark):
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((i, t))
    want = []
    for body, own in groups.items():
        keep = min(own, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0]
        want += [(i, keep, len(own), i == keep, hashlib.sha256(body.encode()).hexdigest()) for i, _ in own]
    got = [tuple(r) for r in exact_dedup.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, k, *_ in want if i is not None and i == k)
    assert exact_dedup.exact_duplicates(empty_docs(spark)).count() == 0


def test_exact_ids_below_zero(spark):
    rows = [(-5, "a"), (3, "a"), (-(2**63), "b"), (2, " b"), (None, "c"), (-1, "c")]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == [(-5, 2, False), (-5, 2, True), (-1, 2, False), (-1, 2, True), (2, 2, False), (2, 2, True)]


def test_exact_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, F.lit("same text")).otherwise(F.col("id").cast("string")).alias("text")).repartition(16)
    got = exact_dedup.exact_duplicates(docs)
    assert got.filter("group_size = 2000 AND keep_id = 0").count() == 2000
    assert got.filter("kept").count() == 1001


# --- mixing


def fill(sizes, weights, most):
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    rest = float(sum(sizes))
    while open_:
        total = sum(weights[k] for k in open_)
        over = {k for k in open_ if rest * weights[k] / total >= most * sizes[k]}
        if not over:
            for k in open_:
                target[k] = rest * weights[k] / total
            break
        for k in over:
            target[k] = float(most * sizes[k])
        rest -= sum(target[k] for k in over)
        open_ -= over
    return target


def test_water_filling_against_rounds(spark):
    rng = random.Random(1)
    for n in (1, 2, 3, 7, 20):
        sizes, weights = [rng.choice([0, 1, 5, 50, 500, 5000]) for _ in range(n)], [(5, 2, 1)[k % 3] for k in range(n)]
        df = spark.createDataFrame([(f"s{k:02d}", w, s) for k, (s, w) in enumerate(zip(sizes, weights, strict=True))], "source string, weight long, source_size long")
        got = [r["target"] for r in mixing.water_fill(df).orderBy("source").collect()]
        assert got == pytest.approx(fill(sizes, weights, 3), rel=1e-9, abs=1e-9)


def test_mix(spark, data):
    got = mixing.mix(odd_docs(spark)).collect()
    assert len(got) == 13 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(empty_docs(spark)).count() == 0
    docs = spark.read.parquet(f"{data}/documents.parquet")
    first, again = (sorted(map(tuple, mixing.mix(d).collect())) for d in (docs, docs.repartition(5)))
    assert first == again
    per = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["g"]) <= r["m"] / 2 + 1 for r in per)
    repeated = mixing.repeat_by_mix(docs)
    assert repeated.columns == docs.columns and repeated.count() == sum(r[-1] for r in first)


def test_mix_of_rows_loaded_many_times(spark):
    """Thousands of rows without an id, or with one, among others: as if ranked one by one, in no large window."""
    rows = [(None, "s", "a b c")] * 3000 + [(7, "s", "a b")] * 2000 + [(k, "t", "x " * (k % 9 + 1)) for k in range(100, 600)] + [(None, "t", "")] * 50
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    got = mixing.mix(df, weights=(3, 5)).collect()
    assert len(got) == len(rows)
    one = {r["size"]: (r["source_size"], r["target"]) for r in got if r["doc_id"] is None and r["size"] or r["doc_id"] == 7}
    (source_size, target), = set(one.values())
    key = lambda i: hashlib.md5(f"mix-1/{'null' if i is None else i}".encode()).hexdigest()
    order = sorted([(key(i), 3 if i is None else 2) for i, s, _ in rows if s == "s"])
    whole, start, want = int(target // source_size), 0, []
    budget = target - whole * source_size
    for _, size in order:
        want.append((size, whole + (2 * start + size < 2 * budget)))
        start += size
    assert sorted((r["size"], r["repeats"]) for r in got if r["source_size"] == source_size) == sorted(want)
    repeated = mixing.repeat_by_mix(df, weights=(3, 5))
    assert repeated.columns == df.columns
    assert repeated.filter("source = 't'").count() == sum(r["repeats"] for r in got if r["source_size"] != source_size)


# --- lines


def test_lines(spark):
    rows = [(k, "h", ["menu", f"text {k}", "menu"]) for k in range(10)] + [(20, None, ["menu"]), (21, "g", ["menu"]), (22, "h", None), (23, "h", []), (None, "h", ["menu", "x"])]
    df = spark.createDataFrame(rows, "id long, site string, ls array<string>").withColumn("lines", F.lit(1)).withColumn("host", F.lit(2)).withColumn("common", F.lit(3))
    got = {r["page_id"]: r for r in line_dedup.drop_site_lines(df, "id", F.col("site"), F.col("ls")).collect()}
    assert got[0]["text"] == "text 0" and got[0]["n_dropped"] == 2
    assert got[20]["text"] == got[21]["text"] == "menu" and got[22]["text"] == got[23]["text"] == "" and got[None]["text"] == "x"
    assert line_dedup.drop_site_lines(df.filter("false"), "id", F.col("site"), F.col("ls")).count() == 0


def test_lines_joined_instead_of_sent(spark, data, same, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", -1)
    same(line_dedup.op4_line_dedup(spark, data), line_dedup.OP4_SQL)


# --- near duplicates


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingled(text, k=5):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [(i, shingled(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        (i, x), (j, y) = sets[a], sets[b]
        if x and y and i is not None and j is not None and 100 * len(x & y) >= 80 * len(x | y):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(s), i if not s or i is None else least[root(k)]) for k, (i, s) in enumerate(sets)]


def check_components(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(repr, map(tuple, jaccard.jaccard_components(df, **options).drop("text_hash").collect())))
    assert got == sorted(map(repr, brute_components(rows)))


def near_copies(seed, families, copies, length, change):
    rng, rows = random.Random(seed), []
    for f in range(families):
        base = [f"f{f}w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(change + 1)):
                w[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_components_of_odd_rows(spark):
    check_components(spark, [(r["doc_id"], r["text"]) for r in odd_docs(spark).collect()])
    assert jaccard.jaccard_components(empty_docs(spark)).count() == 0
    assert jaccard.keep_one(odd_docs(spark)).columns == odd_docs(spark).columns


def test_other_texts_of_an_id_stay(spark):
    """An id, or none, on several rows: what goes is the copy, not the other text."""
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words), (7, words), (7, "alone under seven"), (None, words), (None, "alone under none"), (8, "twice"), (8, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    own = [(7, "alone under seven"), (8, "twice"), (8, "twice"), (None, "alone under none")]
    assert sorted(map(repr, map(tuple, exact_dedup.drop_duplicates(df).collect()))) == sorted(map(repr, [(1, words), *own]))
    assert sorted(map(repr, map(tuple, jaccard.keep_one(df).collect()))) == sorted(map(repr, [(1, words), (None, words), *own]))


def test_components_of_large_clusters_in_small_blocks(spark):
    """Clusters of many blocks, with members that are not like block 0, and a passage that all share."""
    rows = near_copies(1, 3, 60, 200, 9)
    passage = " ".join(f"shared{k}" for k in range(60))
    rows += [(1000 + k, passage + " " + " ".join(f"own{k}w{j}" for j in range(30 + k))) for k in range(40)]
    rows += [(2000 + k, " ".join(f"tiny{k // 2}w{j}" for j in range(5 + k % 2))) for k in range(20)]
    check_components(spark, rows, block=8, bin_tokens=500)
    check_components(spark, rows, block=16, bin_tokens=500, common_sample=100, common_docs=6)


def test_components_of_a_cluster_with_all_sizes(spark, monkeypatch):
    """One cluster by a shared passage whose sets are of 60 to 460 shingles, linked in chains only; tasks hold several bins."""
    monkeypatch.setattr(jaccard, "MAX_TASKS", 3)
    passage = [f"shared{k}" for k in range(60)]
    rows = [(k, " ".join(passage + [f"own{j}" for j in range(0, 4 + 10 * (k // 2))] + ["end"] * (k % 2))) for k in range(80)]
    rows += [(1000 + k, " ".join(passage + [f"alone{k}w{j}" for j in range(5 * k)])) for k in range(60)]
    check_components(spark, rows, block=4, bin_tokens=500)


def test_components_of_long_texts_that_share_a_third(spark, monkeypatch):
    """A cluster held together by passages only: sets move a few times each, not once for each block; and a round's bins go with the round."""
    rng, rows = random.Random(8), near_copies(9, 30, 3, 120, 2)
    passages = [" ".join(f"p{p}w{j}" for j in range(60)) for p in range(4)]
    rows = [(k, f"{passages[k % 4]} {passages[(k + 1) % 4] if k % 3 else ''} {t}") for k, t in rows]
    rows += [(1000 + k, " ".join([*rng.sample(passages, rng.randrange(1, 3)), *(f"own{k}w{j}" for j in range(70 + k % 40))])) for k in range(400)]
    moved, left, join, written = spark.sparkContext.accumulator(0), [], jaccard._join_blocks, jaccard.scratch.written

    def counting(num, den):
        inside = join(num, den)
        return lambda part: (moved.add(len(part)), inside(part))[1]

    def watching(df, name, *more):
        if name == "jaccard-shared":
            left.append(len(list(Path(tables[-1]._scratch_path).glob("round=*"))))
        table = written(df, name, *more)
        if name == "jaccard-bins":
            tables.append(table)
        return table

    tables = []
    monkeypatch.setattr(jaccard, "_join_blocks", counting)
    monkeypatch.setattr(jaccard.scratch, "written", watching)
    check_components(spark, rows, block=8, bin_tokens=500)
    assert moved.value < 10 * len(rows)
    assert left == [4, 3, 2, 1]


def test_components_with_crowded_bins(spark, monkeypatch):
    """A passage that the sample does not show but that crowds the bins of its tokens."""
    seen = []
    keep = jaccard._crowding_tokens
    monkeypatch.setattr(jaccard, "_crowding_tokens", lambda *a: (seen.append(keep(*a)), seen[-1])[1])
    monkeypatch.setattr(jaccard, "CROWDED", 1.2)
    monkeypatch.setattr(jaccard, "CROWD_SHARE", 0.05)
    passage = " ".join(f"shared{k}" for k in range(40))
    rows = [(k, passage + " " + " ".join(f"own{k % 120}w{j}" for j in range(8 + k % 3))) for k in range(150)]
    rows += [(500 + i, t) for i, t in near_copies(4, 5, 8, 60, 4)]
    check_components(spark, rows, block=16, bin_tokens=200, common_sample=1, common_docs=100)
    assert len(seen[0])


@pytest.mark.parametrize("seed", range(3))
def test_components_at_the_limit(spark, seed):
    """Short sets whose similarity is often exactly 0.8, in chains."""
    rng, rows = random.Random(seed), []
    for k in range(150):
        start = rng.randrange(60)
        rows.append((k, " ".join(f"t{j}" for j in range(start, start + rng.randrange(3, 16)))))
    check_components(spark, rows, block=4, bin_tokens=50)


def test_tree_against_all_pairs():
    rng = random.Random(5)
    sets = [np.unique(np.array([rng.randrange(200) for _ in range(rng.randrange(1, 60))], np.uint64)) for _ in range(120)]
    sets += [np.unique(np.append(s[1:], np.uint64(999))) for s in sets]
    near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))

    def groups(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            x, y = label[a], label[b]
            label = [x if v == y else v for v in label]
        return [label.index(v) for v in label]

    want = groups((a, b) for a, b in itertools.combinations(range(len(sets)), 2) if near(sets[a], sets[b]))
    assert groups(linking_pairs(sets, np.arange(len(sets)))) == want


def test_shingle_counts():
    texts = ["", " ", "A b", "a B c d e", "a b c d e a b c d e", "é É x y z w", "x" * 100, None or ""]
    assert [len(s) for s in shingle_sets([t.encode() for t in texts])] == [len(shingled(t)) for t in texts]


@pytest.mark.parametrize("texts", [[], [b""], [b" "], [b"one"], [b"one two"], [b"one two three"], [b"a b", b"", b"c"], [b"a b c d"], [b"a b c d e"], [b"a b c d e f", b"g"]])
def test_few_words(texts):
    """Also where all texts together have fewer words than a shingle."""
    want = [max(len(t.split()) - 4, 1 if t.split() else 0) for t in texts]
    assert [len(s) for s in shingle_sets(texts)] == want


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 105), (105, 103)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 103: 100, 105: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_join_fewer_rows_each_round(spark, monkeypatch):
    """A chain whose smallest node is followed by the largest ones: labels that go from neighbour to neighbour take a round a node."""
    names, written = [], scratch.written
    monkeypatch.setattr(scratch, "written", lambda df, name, *a: names.append(name) or written(df, name, *a))
    chain = [0, *range(60, 0, -1)]
    edges = [*itertools.pairwise(chain), (70, 70), (3, 3), (5, 4), (4, 5), (-9, 80), (-9, 81), (-9, 82)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(chain, 0) | {70: 70} | dict.fromkeys([-9, 80, 81, 82], -9)
    assert len(names) < 40


# --- tokens


ALPHABET = ["a", "B", "é", "É", "é", "Σ", "ς", "ß", "İ", "1", "٣", "½", "'s", "'", "'LL", "!", "<|endoftext|>", "<|END", " ", " ", "\x85", "\x1c", "\x0b", "\n", "\t", "\xa0", "漢", "😀", "​", "ﬁ", "</w>", "the", "worthless", ".", "\x00", "\x7f", "각", "ª", "×"]


def test_tokens_as_the_library_gives_them(spark, data):
    path = tokens.vocabulary_path()
    library = tokens.load(path)
    counter, encoder = tokens.TokenCounter(path, tokens.whole_tokens(path)), tokens.TokenEncoder(path)
    rng = random.Random(2)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(14))) for _ in range(4000)]
    made += [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").limit(100).collect()] + ["x" * 5000]
    ids = [e.ids for e in library.encode_batch(made, add_special_tokens=False)]
    data_ = [t.encode() for t in made]
    assert counter.counts(data_) == [len(i) for i in ids]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(data_)] == ids
    odd = tokens.count_tokens(odd_docs(spark), limit=10).collect()
    assert len(odd) == 13 and all(r["n_tokens"] == 0 and r["n_bytes"] == 0 for r in odd if r["doc_id"] == 4)
    assert tokens.count_tokens(empty_docs(spark)).count() == 0


def test_whole_tokens_are_whole():
    path = tokens.vocabulary_path()
    library, vocab = tokens.load(path), tokens.load(path).get_vocab(False)
    some = random.Random(4).sample(sorted(tokens.whole_tokens(path)), 500)
    assert all(library.encode(w.decode(), add_special_tokens=False).ids == [vocab[w.decode() + "</w>"]] for w in some)


# --- packing


def test_pack(spark):
    docs = odd_docs(spark)
    library = tokens.load(tokens.vocabulary_path())
    got = packing.pack(docs, capacity=64, shard_pieces=400).collect()
    want = []
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for n, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want.append((r["doc_id"], n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(repr, [tuple(r)[:5] for r in got])) == sorted(map(repr, want))
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(empty_docs(spark)).count() == 0


def test_repeated_rows_are_dealt_to_all_shards(spark):
    """Two thousand rows of no id and one text: no shard gets much more than its share, and all are packed."""
    df = spark.createDataFrame([(None, "one text for all")] * 2000, "doc_id long, text string").repartition(4)
    got = packing.pack(df, capacity=64, shard_pieces=100).collect()
    length = got[0]["length"]
    shards: dict[int, int] = {}
    for r in got:
        shards[r["sequence_id"] >> 32] = shards.get(r["sequence_id"] >> 32, 0) + 1
    assert len(got) == 2000 and len(shards) == 20 and max(shards.values()) < 160
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 2000
    # The cost of sharding: at most a part-filled sequence a shard more than one packing of all.
    assert len({r["sequence_id"] for r in got}) <= -(-2000 // (64 // length)) + len(shards)


def test_best_fit_takes_the_tightest():
    rng = random.Random(6)
    lengths = sorted((rng.randrange(1, 101) for _ in range(600)), reverse=True)
    where, offsets = packing.best_fit_decreasing(lengths, 100)
    left: dict[int, int] = {}
    for length, number, offset in zip(lengths, where, offsets, strict=True):
        fitting = [c for c in left.values() if c >= length]
        assert left.get(number, 100) == (min(fitting) if fitting else 100) == 100 - offset
        left[number] = left.get(number, 100) - length


# --- toxicity


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    chain = toxicity.fit(docs, labels.filter(~held), toxicity.default_categories())
    judged = toxicity.judge(docs.join(labels.filter(held).select("doc_id", "toxic"), "doc_id"), chain)
    got = judged.select(F.col("doc.toxic").alias("y"), (F.col("p_toxic") >= chain.thresholds[-1]).cast("int").alias("f")).groupBy("y", "f").count().collect()
    n = {(r["y"], r["f"]): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01


def test_linear_models_are_at_their_optimum():
    """The gradient of the penalised likelihood vanishes, so the fit is the one that any method gives."""
    rng = np.random.default_rng(4)
    x = (rng.random((400, 12)) < 0.3).astype(np.float32)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * x[:, 0] - 3 * x[:, 1])))).astype(float)
    m = toxicity.fit_linear(x, y, penalty=1.0, steps=3000)
    error = m.probability(x) - y
    assert np.abs((x.T @ error + m.weights) / len(y)).max() < 1e-3 and abs(error.mean()) < 1e-3
    assert m.weights[0] > 1 and m.weights[1] < -1


def test_chain_against_a_plain_loop(monkeypatch):
    """Features of a fold's models are chosen without that fold, and later categories see its out-of-fold logits."""
    monkeypatch.setattr(toxicity, "MAX_FEATURES", 9)
    monkeypatch.setattr(toxicity, "MIN_Z", 1.5)
    rng = np.random.default_rng(8)
    n, width, folds = 300, 40, toxicity.FOLDS
    present = (rng.random((n, width)) < 0.25).astype(np.float32)
    first = rng.random(n) < 1 / (1 + np.exp(-(2 * present[:, 0] + 2 * present[:, 1] - 1)))
    second = rng.random(n) < 1 / (1 + np.exp(-(3 * first + 2 * present[:, 2] - 3)))
    y, fold = np.stack([first, second], axis=1).astype(float), rng.integers(0, folds, n)
    tally = np.zeros((width, folds, 3), np.int64)
    for d in range(n):
        for f in np.flatnonzero(present[d]):
            tally[f, fold[d]] += [1, int(y[d, 0]), int(y[d, 1])]
    chain = toxicity.fit_chain(np.arange(width).astype(np.uint64), tally, fold, y, present, ["first", "second"])

    def best(rows, c):
        scored = []
        for f in range(width):
            has = [d for d in rows if present[d, f]]
            k, m = sum(y[d, c] for d in has), len(has)
            base = sum(y[d, c] for d in rows) / len(rows)
            gain = (k * np.log(k / m / base) if k else 0) + ((m - k) * np.log((1 - k / m) / (1 - base)) if k < m else 0)
            z = np.sqrt(2 * max(gain, 0)) if m >= toxicity.MIN_DOCS else 0
            scored.append((-z, f))
        return [f for z, f in sorted(scored)[:9] if -z >= 1.5]

    before, models = np.zeros((n, 0), np.float32), []
    for c in range(2):
        outside = np.zeros(n)
        for k in range(folds):
            train, held = [d for d in range(n) if fold[d] != k], [d for d in range(n) if fold[d] == k]
            cols = best(train, c)
            m = toxicity.fit_linear(np.hstack([present[train][:, cols], before[train]]), y[train, c])
            outside[held] = m.probability(np.hstack([present[held][:, cols], before[held]]))
        cols = best(range(n), c)
        models.append((cols, toxicity.fit_linear(np.hstack([present[:, cols], before]), y[:, c])))
        assert chain.thresholds[c] == pytest.approx(toxicity.best_threshold(outside, y[:, c]), abs=1e-5)
        before = np.hstack([before, toxicity._logit(outside)[:, None]])
    p0 = models[0][1].probability(present[:, models[0][0]])
    p1 = models[1][1].probability(np.hstack([present[:, models[1][0]], toxicity._logit(p0)[:, None]]))
    got = chain.probabilities(present[:, chain.features.astype(int)])
    assert got == pytest.approx(np.stack([p0, p1], axis=1), abs=1e-4)


def test_fitting_stays_bounded_on_repeated_rows(spark):
    """Forty thousand rows of one labelled id, half of them equal, and a bound of a thousand."""
    docs = spark.range(40_000).select(F.lit(1).alias("doc_id"), F.when(F.col("id") < 20_000, F.lit("same words")).otherwise(F.concat(F.lit("word "), F.col("id").cast("string"))).alias("text"))
    docs = docs.union(spark.range(2, 300).select(F.col("id").cast("int"), F.concat(F.lit("clean text "), F.col("id").cast("string"))))
    labels = spark.range(1, 300).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") == 1).cast("int").alias("toxic"))
    seen = []
    keep = toxicity.fit_chain
    toxicity.fit_chain = lambda *a: (seen.append(len(a[3])), keep(*a))[1]
    try:
        toxicity.fit(docs, labels, toxicity.default_categories(), max_labelled=1000)
    finally:
        toxicity.fit_chain = keep
    assert 0 < seen[0] < 1200


def test_toxicity_of_odd_rows(spark):
    docs, none = odd_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 1), (1, None, None), (6, 1, 0), (None, 1, 1), (99, 0, 1)], none.schema)
    for labels in (none, some):
        kept = toxicity.reject_toxic(docs, labels)
        assert kept.columns == docs.columns and kept.count() <= 13
    assert toxicity.reject_toxic(docs, none).count() == 13
    assert toxicity.reject_toxic(empty_docs(spark), some).count() == 0


# --- pages


PAGE = """<html><head><title>no</title><style>p{}</style></head><body><div id="top-nav"><a href="/">home page</a></div><nav><ul><li>x</li></ul></nav>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>
 text.<p>Second one<br>goes on.<div class="ad">buy <p>now</p></div><form><p>mail</p></form><p>Third.</p><div class="comments"><p>I agree</p></div></article>
<script>if (a<b) document.write("<p>no</p>")</script><footer><p>foot</p></footer></body></html>"""


def test_extraction(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    weights = html_extract.fit(pages)
    assert html_extract.main_text(PAGE, weights) == "Title & more\nFirst bold text.\nSecond one goes on.\nThird."
    for page, want in ((None, ""), ("", ""), ("plain", "plain"), ("<p>a &lt; b", "a < b"), ("<script>x", ""), ("<p" * 1000, None), ("<div>" * 3000 + "deep", "deep")):
        assert want is None or html_extract.main_text(page, weights) == want
    parts = "<article><p>Words of it.</p><pre>a\n b</pre><table><tr><td>c</td><td>d</td></tr></table><ul><li>one<li>two</ul></article>"
    assert html_extract.main_text(parts, weights) == "Words of it.\na b\nc\nd\none\ntwo"
    odd = spark.createDataFrame([(1, None, None), (None, "u", "<p>x y</p>"), (2, "u", ""), (2, "u", "")], "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("inside", F.lit(1))
    assert sorted((r["n_chars"], r["text"]) for r in html_extract.extract(odd, weights).collect()) == [(0, ""), (0, ""), (0, ""), (3, "x y")]
    assert html_extract.extract(odd.filter("false"), html_extract.fit(odd.filter("false"))).count() == 0


def test_extraction_equals_the_marked_article(spark, data):
    import html

    got = {r["page_id"]: r["text"] for r in html_extract.op5_html_extract(spark, data).collect()}
    for r in spark.read.parquet(f"{data}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p class=don't>Text here isn't lost</p><p>b c</p>", "Text here isn't lost\nb c"),
        ('<p title="unclosed>text</p> more', "text\nmore"),
        ('<p title="a > b">Alpha <img alt=\'x>y\'> beta</p>', "Alpha beta"),
        ('<div class="layout has-sidebar"><article><p>Kept text</p></article></div>', "Kept text"),
        ('<div class="sidebar"><div><p>Not this one</p></div></div><p>But this</p>', "But this"),
        ("<p>a<!-- b > c --> d</p>", "a d"),
        ("a > b <i", "a > b <i"),
        ("text <!-- open", "text"),
        ("<ul>" + "<li>x" * 50_000, "x\n" * 49_999 + "x"),
        ("<b " * 50_000, ("<b " * 50_000).strip()),
    ],
)
def test_odd_markup(page, want):
    """Stray quotes and brackets, layouts named after parts, very deep and very long pages."""
    assert html_extract.main_text(page, html_extract.Weights({})) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<form id=aspnetForm><nav>menu</nav><article><p>Kept text</p><div class=ad>buy</div></article></form>", "Kept text"),
        ('<div class="elementor-widget-container"><main><article><p>Kept text</p></article></main></div>', "Kept text"),
        ('<p>The text</p><div class="related"><article><p>One card</p></article><article><p>Another card</p></article></div>', "The text"),
        ('<p>The text</p><div class="comments"><article class="comment"><p>I agree</p></article></div>', "The text"),
    ],
)
def test_article_inside_a_part_that_is_none(page, want):
    assert html_extract.main_text(page, html_extract.Weights({})) == want


ARTICLE = "<h1>The title</h1><p>One paragraph of the article here.</p><p>Another one with more words in it.</p>"
ARTICLE_TEXT = "The title\nOne paragraph of the article here.\nAnother one with more words in it."
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">About us</a></li></ul></nav>'
FOOT = "<footer><p>Copyright 2024 by the company, all rights</p></footer>"
WRAPPERS = [
    '<div class="page sidebar-right">', '<div class="layout-with-left-sidebar">', '<section class="legal">', '<div class="post tags-news">', '<div role="main" class="banner-layout">',
    '<form action="x" id="aspnetForm">', '<div class="elementor-widget-container">', '<div class="modal-page">', "<div class=overlay>", '<div class="search-results">',
]


@pytest.mark.parametrize("open_", WRAPPERS)
@pytest.mark.parametrize("whole", [False, True])
def test_article_in_a_wrapper_named_like_a_part(open_, whole):
    close = f"</{re.match('<([a-z]+)', open_)[1]}>"
    page = open_ + MENU + ARTICLE + FOOT + close if whole else MENU + open_ + ARTICLE + close + FOOT
    assert html_extract.main_text(page, html_extract.Weights({})) == ARTICLE_TEXT


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<body><p class="comment-policy">We do allow comments.</p></body>', "We do allow comments."),
        ('<body><p data-class="ad">Text of it.</p></body>', "Text of it."),
        ("<div>" + "".join(f"<div>word {k}</div>" for k in range(30)) + "</div>", "\n".join(f"word {k}" for k in range(30))),
        (f"<article><div>By me</div>{ARTICLE}<div>The end</div></article>", f"By me\n{ARTICLE_TEXT}\nThe end"),
        (f"<div><div>By me</div>{ARTICLE}<div>The end</div></div>", f"By me\n{ARTICLE_TEXT}\nThe end"),
        ('<p>Some text <span class="ad">Buy now</span>goes on.</p>', "Some text goes on."),
        (MENU + f"<div>{ARTICLE}</div>" + '<div id="comments">' + '<div class="comment"><p>I do agree with it very much.</p></div>' * 20 + "</div>", ARTICLE_TEXT),
        (f'<div class="content">{ARTICLE}</div><div class="sidebar-right"><p>{"word " * 60}</p></div>', ARTICLE_TEXT),
        (MENU + FOOT + '<div class="ad">Buy all of it now</div>', ""),
        ("<main><p>Some main text.</p><aside><p>Aside words.</p></aside><p>More.</p></main>", "Some main text.\nMore."),
        ("<header><p>Site</p></header><article><header><h1>Title</h1></header><p>Text here.</p><footer>Share this</footer></article>", "Title\nText here."),
        ('<p>Text.</p><div style="display:none">Not seen</div><p hidden>nor this</p><p>End.</p>', "Text.\nEnd."),
        (f'<div>{ARTICLE}</div><div class="siteFooter">All rights are reserved</div><div id="adContainer">Buy</div>', ARTICLE_TEXT),
        (f"<article>{ARTICLE}" + '<section class="related-posts"><h2>Related</h2><ul><li><a href=x>One more</a></li></ul></section></article>', ARTICLE_TEXT),
        ("<p>See <a href=x>this page</a> for more.</p>", "See this page for more."),
        ("<div class=a>" * 20_000 + "deep", "deep"),
        ("<div class=ad>" * 20_000 + "deep", ""),
    ],
)
def test_parts_and_what_is_none(page, want):
    assert html_extract.main_text(page, html_extract.Weights({})) == want


def test_the_scan_decides(spark, data, monkeypatch):
    """Clutter without any name goes by the scan alone, and without scans nothing would go."""
    soup = f"<div><a href=x>Home</a> <a href=y>About</a></div><div>Login</div><div>{ARTICLE}</div><div><a href=z>Next post here</a></div>"
    weights = html_extract.Weights({})
    assert html_extract.main_text(soup, weights) == ARTICLE_TEXT
    monkeypatch.setattr(html_extract, "best_region", lambda scores: (0, len(scores)))
    assert html_extract.main_text(soup, weights) == f"Home About\nLogin\n{ARTICLE_TEXT}\nNext post here"
    for r in spark.read.parquet(f"{data}/pages.parquet").limit(20).collect():
        assert html_extract.main_text(r["html"], weights) != re.search("<article>(.*)", r["html"], re.S)[1]


def test_names_are_learnt():
    """A name that no list has, seen outside the marked content only, speaks against its part; a listed one seen inside does not."""
    counts: dict = {}
    page = '<section class="teaser"><p>' + "word " * 40 + "</p></section><article><p>" + "word " * 200 + '</p><section class="widget"><p>' + "word " * 40 + "</p></section></article>"
    for _ in range(20):
        html_extract._counts(page, counts)
    weights = html_extract.Weights({k: tuple(v) for k, v in counts.items()})
    assert html_extract.main_text(f'{ARTICLE}<div class="teaser"><p>{"word " * 9}</p></div><div class="widget"><p>Some more of it</p></div>', weights) == ARTICLE_TEXT + "\nSome more of it"


def test_region():
    assert html_extract.best_region([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert html_extract.best_region([-1.0, 0.0]) == (0, 0)
    rng = random.Random(7)
    for _ in range(200):
        s = [rng.randrange(-4, 5) for _ in range(rng.randrange(1, 12))]
        a, b = html_extract.best_region(s)
        assert sum(s[a:b]) == max(0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)))


def test_urls(spark):
    rows = [
        (1, "http://a.B.com/en/x?q#f", None), (2, "https://example.com/en/75", '<a href="http://bad.org/es/1">'), (3, "https://m.example.net/de/88", ""), (4, "x.net/de/", None), (5, None, None),
        (6, "ftp://q.org", None), (7, "http://notcom/en/", '<a href="http://a.b.com/">'), (None, "http://com/en/", None), (8, "http://h.org/es?x", None), (9, "http://h.net/de/7://z", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(1)).withColumn("trust", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df).collect()}
    assert len(got) == len(rows)
    assert got[1] == ("a.b.com", "/en/x", "com/en/", "block")
    assert got[2] == ("example.com", "/en/75", "example.com/en/7", "allow")
    assert got[3] == ("m.example.net", "/de/88", "example.net/de/8", "block")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert got[6][:3] == ("q.org", "", None) and got[7][:3] == ("notcom", "/en/", None) and got[8][2] is None
    assert got[9] == ("h.net", "/de/7://z", "net/de/", "allow") and got[None][3] == "block"
    assert url_filter.judge_urls(df.filter("false")).count() == 0


def test_links_of_all_kinds(spark):
    links = '<A class=x HREF="http://Abs.org/1"><a href=//rel.org/x?y><area href=\'https://area.org\'><a href="/own"><a href="mailto:a@mail.org"><a href="#top"><a data-href="http://no.org/"><link href="http://css.org/">'
    rows = [(1, "http://src.org/a", links), (2, "http://src.org/b", '<a href="http://abs.org/2">'), (3, "http://based.org/", '<base href="//there.org/x/"><a href="y"><a href="z">'), (4, "http://own.org/", '<base href="/x/"><a href="y">'), (5, "http://n.org", None), (6, None, links)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = url_filter.host_edges(df, url_filter.host_of(F.col("url")), F.col("html")).collect()
    assert {(r["src"], r["dst"]): r["weight"] for r in got} == {("src.org", "abs.org"): 2.0, ("src.org", "rel.org"): 1.0, ("src.org", "area.org"): 1.0, ("based.org", "there.org"): 1.0}


def test_verdicts_on_a_planted_graph(spark):
    """Hosts of one domain differ by who links where; all verdicts equal a plain loop run to its fixed point."""
    rng = random.Random(11)
    hosts = [f"h{k}.one.edu" for k in range(24)] + ["good.net", "bad.org", "mixed.com", "far.edu", "alone.edu"]
    linked = {(a, b) for a in hosts[:24] for b in rng.sample(hosts[:24], 2) if a != b}
    linked |= {("good.net", h) for h in hosts[:6]} | {(h, "bad.org") for h in hosts[14:20]} | {("mixed.com", "h3.one.edu"), ("h7.one.edu", "mixed.com"), ("far.edu", "h15.one.edu")}
    pages = [(k, f"http://{h}/x/{k}", "".join(f'<a href="http://{b}/">' for a, b in sorted(linked) if a == h)) for k, h in enumerate(hosts)]
    pages += [(100, "http://good.net/de/1", ""), (101, "http://bad.org/es/1", ""), (102, "http://bad.org/es/2", ""), (103, "http://mixed.com/en/1", "")]
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}

    trusted = {"good.net": 1 / 2}
    blocked = {"bad.org": 2 / 3, "mixed.com": 1 / 2}
    start = {h: (trusted.get(h, 0) / sum(trusted.values()), blocked.get(h, 0) / sum(blocked.values())) for h in hosts}
    out, into = {h: sum(a == h for a, _ in linked) for h in hosts}, {h: sum(b == h for _, b in linked) for h in hosts}
    trust, distrust = {h: start[h][0] for h in hosts}, {h: start[h][1] for h in hosts}
    for _ in range(300):
        t = {h: 0.15 * start[h][0] + 0.85 * sum(trust[a] / out[a] for a, b in linked if b == h) for h in hosts}
        distrust = {h: 0.15 * start[h][1] + 0.85 * sum(distrust[b] / into[b] for a, b in linked if a == h) for h in hosts}
        trust = t
    verdicts = {h: "block" if distrust[h] > (trust[h] + distrust[h]) / 2 else "allow" for h in hosts}
    assert {h: got[k]["verdict"] for k, h in enumerate(hosts)} == verdicts
    assert {verdicts[h] for h in hosts[:24]} == {"allow", "block"} and verdicts["far.edu"] == "block" and verdicts["alone.edu"] == "allow"
    for k, h in enumerate(hosts):
        assert got[k]["trust"] == pytest.approx(trust[h], abs=1e-3) and got[k]["distrust"] == pytest.approx(distrust[h], abs=1e-3)


def test_spreading_ends_when_it_has_settled(spark):
    """Along a chain of forty hosts distrust reaches the first, and a graph without edges ends at once."""
    edges = spark.createDataFrame([(f"n{k:02d}", f"n{k + 1:02d}", 1.0) for k in range(40)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("n40", 0.0, 1.0)], "host string, trusted double, blocked double")
    got = {r["host"]: r["distrust"] for r in url_filter.spread(edges, seeds).collect()}
    assert all(got[f"n{k:02d}"] == pytest.approx(0.15 * 0.85 ** (40 - k), rel=1e-6) for k in range(41))
    assert [tuple(r) for r in url_filter.spread(edges.filter("false"), seeds).collect()] == [("n40", 0.0, pytest.approx(0.15))]


def test_rank_spreads_as_by_hand(spark):
    edges = [("a", "b", 1.0), ("b", "c", 2.0), ("b", "a", 1.0), ("c", "a", 1.0), ("d", "c", 1.0)]
    seeds = {"a": (1.0, 0.0), "c": (0.0, 0.5), "e": (0.5, 0.5)}
    nodes = "abcde"
    out, into = {n: sum(w for s, _, w in edges if s == n) for n in nodes}, {n: sum(w for _, t, w in edges if t == n) for n in nodes}
    start = {n: (seeds.get(n, (0, 0))[0] / 1.5, seeds.get(n, (0, 0))[1] / 1.0) for n in nodes}
    trust, distrust = {n: v[0] for n, v in start.items()}, {n: v[1] for n, v in start.items()}
    for _ in range(7):
        t = {n: 0.15 * start[n][0] + 0.85 * sum(trust[s] * w / out[s] for s, x, w in edges if x == n) for n in nodes}
        distrust = {n: 0.15 * start[n][1] + 0.85 * sum(distrust[x] * w / into[x] for s, x, w in edges if s == n) for n in nodes}
        trust = t
    e = spark.createDataFrame(edges, "src string, dst string, weight double")
    s = spark.createDataFrame([(k, *v) for k, v in seeds.items()], "host string, trusted double, blocked double")
    for r in url_filter.spread(e, s, rounds=7).collect():
        assert r["trust"] == pytest.approx(trust[r["host"]]) and r["distrust"] == pytest.approx(distrust[r["host"]])


# --- vectors


def test_neighbours(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = ann.op2_ann(spark, folder).collect()
    ids, v = zip(*[(r["vec_id"], r["embedding"]) for r in rows.collect()], strict=True)
    ids, v = np.array(ids), np.array(v, np.float64)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    hits = 0
    for q, own in found.items():
        at = int(np.flatnonzero(ids == q)[0])
        score = v @ v[at]
        score[at] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        own.sort()
        assert [r for r, *_ in own] == list(range(1, 21))
        assert all(s == pytest.approx(score[int(np.flatnonzero(ids == i)[0])], abs=1e-12) for _, i, s in own)
        hits += len(set(best.tolist()) & {i for _, i, _ in own})
    assert hits >= 0.9 * 20 * len(found)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 1.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, [2.0, 0.0]), (8, [2.0, 0.0]), (None, [9.0, 9.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("norm", F.lit(1)).withColumn("codes", F.lit(1))
    got = [tuple(r) for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 2.0), (0, 2, 8, 2.0), (0, 3, 20, 1.0), (20, 1, 7, 2.0), (20, 2, 8, 2.0), (20, 3, 0, 1.0)]
    assert ann.nearest(df.filter("false"), F.lit(True)).count() == 0
    assert ann.nearest(df.filter("vec_id = 1"), F.lit(True)).count() == 0


@pytest.mark.parametrize("power", [-400, -130, 130, 400])
def test_very_large_and_small_vectors(spark, power):
    """Beyond single precision, products inside double: the neighbours are those of the same vectors at one."""
    v = np.random.default_rng(3).normal(size=(900, 8))
    plain, scaled = (
        [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(spark.createDataFrame([(k, x) for k, x in enumerate(m.tolist())], "vec_id long, embedding array<double>"), F.col("vec_id") % 90 == 0).orderBy("query_id", "rank").collect()]
        for m in (v, np.ldexp(v, power))
    )
    assert len(plain) == 200 and scaled == plain


def test_equal_vectors_go_by_id(spark):
    """More equal vectors in one task than a shortlist holds, in no order of ids."""
    rows = [(k * 7919 % 2000, [1.0, 2.0]) for k in range(2000)] + [(2000, [1.0, 2.0]), (2001, [0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = ann.nearest(df, F.col("vec_id") == 2000).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(k + 1, k, 5.0) for k in range(20)]


def test_shortlist_takes_first_of_equals():
    rng = np.random.default_rng(2)
    rough = rng.integers(0, 6, (50, 40)).astype(np.float32)
    for width in (1, 7, 39, 40, 60):
        want = [sorted(np.argsort(-r, kind="stable")[:width].tolist()) for r in rough]
        assert ann.shortlisted(rough, width).tolist() == want


def test_recall_on_unclustered_vectors(spark, monkeypatch):
    """Twenty thousand Gaussian vectors of 64 dimensions, in several blocks of queries."""
    monkeypatch.setattr(ann, "QUERY_BLOCK", 300)
    v = np.random.default_rng(9).normal(size=(20_000, 64))
    df = spark.createDataFrame([(k, x) for k, x in enumerate(v.tolist())], "vec_id long, embedding array<double>").repartition(3)
    found: dict[int, set[int]] = {}
    for r in ann.nearest(df, F.col("vec_id") % 40 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(found) == list(range(0, 20_000, 40)) and all(len(x) == 20 for x in found.values())
    score = v[::40] @ v.T
    score[np.arange(500), np.arange(0, 20_000, 40)] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    assert sum(len(set(b) & found[40 * k]) for k, b in enumerate(best.tolist())) >= 0.9 * best.size


def test_lengths_are_searched_apart(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (20, [3.0]), (2, [5.0]), (3, [1.0, 1.0, 1.0]), (40, [])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 2.0), (20, 1, 2, 15.0)]


def test_beam_is_no_worse_than_greedy():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    books = ann.fit_codebooks(x, books=4, words=32)
    error = lambda beam: float(((x - ann.decode(ann.encode(x, books, beam)[0], books)) ** 2).sum())
    assert error(4) <= error(1) < float((x**2).sum())


# --- pipeline


def test_pipeline_stage_by_stage(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, data)
    left = {r["doc_id"] for r in clean.collect()}
    assert sum(labels.get(i, 0) == 0 and i not in left for i in rows) < 0.1 * len(rows)
    unique = stages["exact_dedup"](spark, clean, data)
    body = lambda i: re.sub(r"[\x20\x09-\x0D]", "", rows[i]["text"])
    kept = [r["doc_id"] for r in unique.collect()]
    assert len({body(i) for i in kept}) == len(kept) and {body(i) for i in kept} == {body(i) for i in left}
    alone = stages["ngram_jaccard"](spark, unique, data)
    want = {c if c is not None else i for i, _, c in brute_components([(i, rows[i]["text"]) for i in kept])}
    assert {r["doc_id"] for r in alone.collect()} == want
    mixed = stages["mixing"](spark, alone, data)
    assert mixed.columns == docs.columns
    packed = stages["packing"](spark, mixed, data)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_pipeline_keeps_one_row_of_each_group(spark, data):
    """Rows loaded many times, groups without any id, and copies without an id of a row that has one."""
    words = [f"w{k}" for k in range(30)]
    near = " ".join([*words[:29], "other"])
    rows = [(8, "twice")] * 3 + [(None, "no id")] * 3 + [(5, " ".join(words)), (None, "  ".join(words)), (None, near), (9, near)] + [(4, "a b"), (4, "a  b"), (2, "ab"), (None, None), (None, "")]
    df = spark.createDataFrame([(*r, "s", k) for k, r in enumerate(rows)], "doc_id long, text string, source string, n long").repartition(4)
    stages = dict(corpus_pipeline.STAGES)
    unique = stages["exact_dedup"](spark, df, data)
    assert unique.columns == df.columns
    got = [(r["doc_id"], r["text"] or "") for r in unique.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [(8, "twice"), (None, "no id"), (None, "  ".join(words)), (9, near), (4, "a  b"), (None, "")]))
    alone = stages["ngram_jaccard"](spark, df.filter("text <> ''"), data)
    assert alone.columns == df.columns
    got = sorted(repr((r["doc_id"], " ".join(r["text"].split()))) for r in alone.collect())
    assert got == sorted(map(repr, [(2, "ab"), (4, "a b"), (5, " ".join(words)), (8, "twice"), (None, "no id")]))


def test_pipeline_of_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    folder = tmp_path / "none"
    empty_docs(spark).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).count() == 0
