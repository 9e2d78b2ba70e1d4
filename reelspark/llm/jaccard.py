"""Self-join of documents on the Jaccard similarity of word shingles, by signature trees.

A tree's upper nodes only prune if what is below is alike, so Spark first brings together, without
losing a pair, what may be similar; trees then do the joining inside small blocks.

1. *Classes*: documents with the same set are one class from here on.
2. *Shared tokens*: of each class the tokens with the smallest hashes go to the bin of their hash;
   a bin tells which occur in several classes. Two similar sets share at least
   ``1 + n // SHARE`` of these first ``n - need + 1 + n // SHARE`` tokens, so a class with fewer
   shared ones has no partner: this is the corpus-wide root of the tree, and it ends most classes.
3. *Clusters*: of its shared tokens each class keeps the rarest that any partner must hold one of;
   classes with a kept token in common form clusters (components).
4. *Blocks*: a cluster is dealt by hash into blocks of about ``BLOCK`` classes. First every block is
   joined with the cluster's block 0, each by a signature tree with dual traversal and exact
   comparison at the leaves. In a cluster of near copies that already connects nearly all.
5. *Parting*: a cluster of several blocks that is not one component by then is taken apart. Steps 2 and 3
   are done again inside it, on whole sets instead of first tokens, and a token only counts for a class if
   one of another component and a size near enough has it too; most classes end here, since what
   held the cluster together is less than what two similar sets must share. Step 4 joins the clusters
   that come of it. This goes on while step 6 would move more sets than a share of all classes, and each time halves that at least.
6. *Rest*: classes outside their cluster's largest component are dealt into groups of their own, by
   bands of set size, and joined, by trees again, with every block of the cluster, of which only the
   sets of the same and the next bands move: sizes further apart prove a pair dissimilar. A pair
   inside one component is skipped.

Tokens that are very common are known to be shared and come last among the rare: they bypass the
bins, so that no bin gathers a large part of all classes, and in step 3 their classes meet in salted
groups. A sample tells the most common ones before anything is dealt; what it misses shows in the
measured sizes of the bins, and goes from those that are too large. Both decide only that order and where tokens
go, not what is found.

Nothing is capped: pairs are left out only if proven dissimilar or already connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark import scratch
from reelspark.llm.components import components
from reelspark.llm.sampling import about
from reelspark.llm.shingles import set_key, shingle_sets
from reelspark.llm.textcols import free_name
from reelspark.llm.signature_tree import linking_pairs
from reelspark.llm.words import mix, new_seed

#: Slack of the token prefix, as a divisor of the set size.
SHARE = 8
#: Documents, at most (in expectation; chosen by hash), that tell common tokens, and in how many of them such a token is.
COMMON_SAMPLE, COMMON_DOCS = 8_192, 128
#: Groups that the classes of a common token meet in, and the document count that stands for common.
SALTS, MANY = 64, 0xFFFFFFFF
#: Tokens in a bin, and classes in a block.
BIN_TOKENS, BLOCK = 400_000, 256
#: A bin is crowded if it has so many times the mean; common there is what has that share of the mean, but at most MOST_COMMON tokens are.
CROWDED, CROWD_SHARE, MOST_COMMON = 2, 0.25, 1_000_000
#: Rounds in which bins are taken from their table, at most: only the tokens of a round are in the shuffle as well.
ROUNDS = 4
#: Moves of sets in step 6, for each class of all documents, up to which clusters are not parted first: so few grow no faster than the input.
MOVES = 0.25
#: Bundles of blocks that a task joins.
TASK_BUNDLES = 32
#: Tasks of a stage at most, as many as a driver can keep track of; beyond, tasks hold several bins or bundles, one after the other.
MAX_TASKS = 100_000


_BINNED = "bin long, owners binary, counts binary, high binary, low binary, size long"


def _prefix(n, num: int, den: int):
    """Tokens of a set of size n that go to the bins, and how many of them must be shared."""
    need = -(-num * n // den)
    return n - need + 1 + n // SHARE, 1 + need // SHARE


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("data"), F.xxhash64(text).alias("text_hash"))


def _texts(batch: pa.RecordBatch, column: int = 1) -> list[bytes]:
    return [t or b"" for t in batch.column(column).to_pylist()]


def _described(rows: DataFrame, k: int, seed: int) -> DataFrame:
    """doc_id, n, key, key2, text_hash of every document."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for s in shingle_sets(_texts(batch), k, seed):
                sizes.append(len(s))
                keys.append(set_key(s))
            one, two = (pa.array([x[p] for x in keys], pa.int64()) for p in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), one, two, batch.column(2)], ["doc_id", "n", "key", "key2", "text_hash"])

    return rows.mapInArrow(describe, "doc_id long, n long, key long, key2 long, text_hash long")


def _common_tokens(rows: DataFrame, described: DataFrame, k: int, seed: int, num: int, den: int, sample: int, least: int) -> np.ndarray:
    """Tokens that stand among the first of at least ``least`` classes of a sample, chosen by hash of the text; bounded by the sample, sorted."""
    total = described.count()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(_texts(batch, 0), k, seed) if len(s)]
            keys = [set_key(s)[0] for s in sets]
            blobs = [(s[: _prefix(len(s), num, den)[0]] >> np.uint64(16)).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["key", "tokens"])

    picked = rows.filter(about(F.xxhash64("text_hash", F.lit(5)), sample, total))
    found = picked.filter("doc_id IS NOT NULL").select("data").mapInArrow(first, "key long, tokens binary").dropDuplicates(["key"])
    return _standing_in(found, least)


def _standing_in(found: DataFrame, least: int) -> np.ndarray:
    """Tokens that at least ``least`` rows (key, tokens) hold, sorted."""
    # Counted where they are: a token common in the sample is common in some task's share of it or summed up from all.
    counts = found.withColumn("share", F.pmod(F.col("key"), F.lit(8))).groupBy("share").applyInPandas(_token_counts, "tokens binary, counts binary").collect()
    tokens = np.concatenate([np.frombuffer(r["tokens"], np.uint64) for r in counts] or [np.zeros(0, np.uint64)])
    names, at = np.unique(tokens, return_inverse=True)
    sums = np.bincount(at, np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in counts] or [np.zeros(0, np.uint32)]), len(names))
    return names[sums >= least]


def _token_counts(part: pd.DataFrame) -> pd.DataFrame:
    names, counts = np.unique(np.frombuffer(b"".join(part["tokens"]), np.uint64), return_counts=True)
    several = counts >= max(1, COMMON_DOCS // 64)
    return pd.DataFrame({"tokens": [names[several].tobytes()], "counts": [counts[several].astype(np.uint32).tobytes()]})


def _binned(rows: DataFrame, k: int, seed: int, bins: int, num: int, den: int, common) -> DataFrame:
    """(bin, class keys, tokens per class, tokens as 32 + 16 bits, number of tokens) for the first tokens of every class a task sees.

    Common tokens go to a bin below zero, which is one of the class, not of the token.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            owner, sizes, tokens = [], [], []
            for s in shingle_sets(_texts(batch, 0), k, seed):
                if not len(s) or (key := set_key(s)[0]) in seen:
                    continue
                seen.add(key)
                first = s[: _prefix(len(s), num, den)[0]]
                owner.append(key)
                sizes.append(len(first))
                tokens.append(first >> np.uint64(16))
            if not owner:
                continue
            token = np.concatenate(tokens)
            who, keys = np.repeat(np.arange(len(owner)), sizes), np.array(owner, np.int64)
            bin_of = (token % np.uint64(bins)).astype(np.int64)
            frequent = _contains(common.value, token)
            bin_of[frequent] = -1 - (keys[who[frequent]] % bins)
            yield _dealt(bin_of, token, keys[who])

    return rows.filter("doc_id IS NOT NULL").select("data").mapInArrow(deal, _BINNED)


def _dealt(bin_of: np.ndarray, token: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """One row a bin of (token, class) pairs; see ``_BINNED``."""
    order = np.lexsort((owner, bin_of))
    token, owner, bin_of = token[order], owner[order], bin_of[order]
    out = ([], [], [], [], [], [])
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bin_of)) + 1, [len(token)])) if len(token) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own, count = np.unique(owner[a:b], return_counts=True)
        part = token[a:b]
        blobs = (own, count.astype(np.uint32), (part >> np.uint64(16)).astype(np.uint32), (part & np.uint64(0xFFFF)).astype(np.uint16))
        for column, value in zip(out, (int(bin_of[a]), *(x.tobytes() for x in blobs), int(b - a)), strict=True):
            column.append(value)
    kinds = (pa.int64(), *[pa.binary()] * 4, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["bin", "owners", "counts", "high", "low", "size"])


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, token and class of each pair in rows of ``_BINNED``."""
    owners, counts, high, low = (b"".join(batch.column(c).to_pylist()) for c in ("owners", "counts", "high", "low"))
    token = (np.frombuffer(high, np.uint32).astype(np.uint64) << np.uint64(16)) | np.frombuffer(low, np.uint16)
    bin_of = np.repeat(batch.column("bin").to_numpy(), batch.column("size").to_numpy())
    return bin_of, token, np.repeat(np.frombuffer(owners, np.int64), np.frombuffer(counts, np.uint32))


def _crowding_tokens(binned: DataFrame, bins: int) -> np.ndarray:
    """Tokens that make bins crowded, sorted: at most ``MOST_COMMON``.

    Bins are measured first; only in the crowded ones are tokens counted, in the tasks as far as they go.
    """
    sizes = binned.filter("bin >= 0").groupBy("bin").agg(F.sum("size").alias("tokens"))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    crowded = sizes.filter(F.col("tokens") > CROWDED * total / bins).select("bin")
    if not crowded.limit(1).count():
        return np.zeros(0, np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, n = np.unique(_pairs(batch)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(n)], ["token", "n"])

    counts = binned.join(crowded, "bin", "left_semi").select(*binned.columns).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    least = max(2, int(CROWD_SHARE * total / bins), total // MOST_COMMON)
    return np.sort(np.array([r["token"] for r in counts.filter(F.col("n") >= least).select("token").collect()], np.int64).astype(np.uint64))


def _thinned(binned: DataFrame, bins: int, crowding) -> DataFrame:
    """``binned`` with the ``crowding`` tokens moved to the bins of their classes."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bin_of, token, owner = _pairs(batch)
            out = _contains(crowding.value, token) & (bin_of >= 0)
            if not out.any():
                yield batch
                continue
            bin_of = np.where(out, -1 - owner % bins, bin_of)
            yield _dealt(bin_of, token, owner)

    return binned.mapInArrow(move, _BINNED)


def _contains(names: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in sorted ``names``."""
    if not len(names):
        return np.zeros(len(x), bool)
    return names[np.minimum(np.searchsorted(names, x), len(names) - 1)] == x


def _unbin(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (token, class) pairs of a bin, sorted by token."""
    owners = np.frombuffer(b"".join(part["owners"]), np.int64)
    counts = np.frombuffer(b"".join(part["counts"]), np.uint32)
    token = (np.frombuffer(b"".join(part["high"]), np.uint32).astype(np.uint64) << np.uint64(16)) | np.frombuffer(b"".join(part["low"]), np.uint16)
    who = np.repeat(owners, counts)
    order = np.lexsort((who, token))
    token, who = token[order], who[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (who[1:] != who[:-1])
    return token[new], who[new]


def _shared_tokens(part: pd.DataFrame) -> pd.DataFrame:
    """For each class of a bin, its tokens that other classes have too, with the number of classes."""
    token, who = _unbin(part)
    runs = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    df = np.repeat(np.diff(np.concatenate((runs, [len(token)]))), np.diff(np.concatenate((runs, [len(token)]))))
    if part["bin"].iloc[0] < 0:
        df[:] = MANY
    shared = df > 1
    token, who, df = token[shared], who[shared], df[shared].astype(np.uint32)
    order = np.argsort(who, kind="stable")
    token, who, df = token[order], who[order], df[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(who)) + 1, [len(who)])) if len(who) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pd.DataFrame({"key": [int(who[a]) for a, _ in spans], "tokens": [token[a:b].tobytes() for a, b in spans], "dfs": [df[a:b].tobytes() for a, b in spans]}, columns=["key", "tokens", "dfs"])


def _kept_tokens(bins: int, least, common):
    """Classes that may have a partner, each with the tokens of which every partner has one, dealt to bins.

    Rows: key, a number of which ``least`` tells how many tokens a partner must share, tokens, dfs.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, sizes, tokens = [], [], []
            for key, n, token, df in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                token, df = np.frombuffer(b"".join(token), np.uint64), np.frombuffer(b"".join(df), np.uint32)
                must = least(n)
                if len(token) >= must:
                    rare = np.lexsort((token, df))[: len(token) - must + 1]
                    owner.append(key)
                    sizes.append(len(rare))
                    tokens.append(token[rare])
            token = np.concatenate([*tokens, np.zeros(0, np.uint64)])
            who = np.repeat(np.array(owner, np.int64), sizes)
            bin_of = (token % np.uint64(bins)).astype(np.int64)
            frequent = _contains(common.value, token)
            bin_of[frequent] = -1 - ((who[frequent] % SALTS) * bins + bin_of[frequent])
            order = np.argsort(bin_of, kind="stable")
            token, who, bin_of = token[order], who[order], bin_of[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bin_of)) + 1, [len(token)])) if len(token) else np.zeros(1, np.int64)
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            columns = [[int(bin_of[a]) for a, _ in spans], [token[a:b].tobytes() for a, b in spans], [who[a:b].tobytes() for a, b in spans]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bin", "tokens", "owners"])

    return keep


def _stars(part: pd.DataFrame) -> pd.DataFrame:
    """Each class of a token with the token's smallest class, once for all tokens of a bin.

    In a salted bin the smallest class is linked on to the token itself, so that all salts meet there.
    """
    token = np.frombuffer(b"".join(part["tokens"]), np.uint64)
    who = np.frombuffer(b"".join(part["owners"]), np.int64)
    order = np.lexsort((who, token))
    token, who = token[order], who[order]
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    hub = np.repeat(who[starts], np.diff(np.concatenate((starts, [len(token)]))))
    pairs = np.stack([hub[hub != who], who[hub != who]])
    if part["bin"].iloc[0] < 0:
        pairs = np.hstack([pairs, np.stack([who[starts], token[starts].astype(np.int64)])])
    pairs = np.unique(pairs, axis=1)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def _whole(cluster: int, hashes: bytes) -> np.ndarray:
    """48-bit tokens of a whole set, other ones in each cluster."""
    with np.errstate(over="ignore"):
        return np.unique(mix(np.frombuffer(hashes, np.uint64) ^ mix(np.array([cluster]).astype(np.uint64))) >> np.uint64(16))


def _whole_binned(open_: DataFrame, bins: int, common) -> DataFrame:
    """All tokens of the sets of ``open_`` (key, cluster, label, hashes), dealt as in ``_binned``; with each class its label, its size, and by how many its tokens are fewer."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, cluster, label = (batch.column(c).to_numpy() for c in range(3))
            hashes = batch.column(3).to_pylist()
            tokens = [_whole(c, h) for c, h in zip(cluster, hashes, strict=True)]
            count = np.array([len(t) for t in tokens], np.int64)
            size = np.array([len(h) // 8 for h in hashes], np.int64)
            token, who = np.concatenate([*tokens, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(tokens)), count)
            bin_of = (token % np.uint64(bins)).astype(np.int64)
            frequent = _contains(common.value, token)
            bin_of[frequent] = -1 - key[who[frequent]] % bins
            order = np.lexsort((who, bin_of))
            token, who, bin_of = token[order], who[order], bin_of[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bin_of)) + 1, [len(token)])) if len(token) else np.zeros(1, np.int64)
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own, times = np.unique(who[a:b], return_counts=True)
                blobs = (key[own], label[own], size[own].astype(np.uint32), (size - count)[own].astype(np.uint32), times.astype(np.uint32), (token[a:b] >> np.uint64(16)).astype(np.uint32))
                rows.append((int(bin_of[a]), *(x.tobytes() for x in blobs), (token[a:b] & np.uint64(0xFFFF)).astype(np.uint16).tobytes()))
            names = ["bin", "owners", "labels", "sizes", "fewer", "counts", "high", "low"]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary() if k else pa.int64()) for k, c in enumerate(columns)], names)

    return open_.select("key", "cluster", "label", "hashes").mapInArrow(deal, "bin long, owners binary, labels binary, sizes binary, fewer binary, counts binary, high binary, low binary")


def _open_tokens(num: int, den: int):
    """For each class of a bin of ``_whole_binned``, its tokens that a class of another label and a size near enough has too."""

    def find(part: pd.DataFrame) -> pd.DataFrame:
        times = np.frombuffer(b"".join(part["counts"]), np.uint32)
        key, label = (np.repeat(np.frombuffer(b"".join(part[c]), np.int64), times) for c in ("owners", "labels"))
        size, fewer = (np.repeat(np.frombuffer(b"".join(part[c]), np.uint32), times).astype(np.int64) for c in ("sizes", "fewer"))
        token = (np.frombuffer(b"".join(part["high"]), np.uint32).astype(np.uint64) << np.uint64(16)) | np.frombuffer(b"".join(part["low"]), np.uint16)
        order = np.lexsort((key, label, size, token))
        token, key, label, size, fewer = (x[order] for x in (token, key, label, size, fewer))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key, label, size, fewer = (x[new] for x in (token, key, label, size, fewer))
        first = np.concatenate(([True], token[1:] != token[:-1]))
        group = np.cumsum(first) - 1
        df = np.bincount(group)[group].astype(np.uint32)
        if part["bin"].iloc[0] < 0:
            df[:] = MANY
        else:
            # Those of a size near enough stand together; next to a run of one label stands another label or another token.
            run = np.flatnonzero(first | np.concatenate(([True], label[1:] != label[:-1])))
            at = np.repeat(np.arange(len(run)), np.diff(np.concatenate((run, [len(token)]))))
            after, before = np.concatenate((run, [len(token)]))[at + 1], run[at] - 1
            place = (group << 33) + size
            low = np.searchsorted(place, (group << 33) - (-num * size // den))
            high = np.searchsorted(place, (group << 33) + np.minimum(den * size // num, (1 << 33) - 1), side="right")
            open_ = (after < high) | (before >= low)
            token, key, size, fewer, df = (x[open_] for x in (token, key, size, fewer, df))
        order = np.argsort(key, kind="stable")
        token, key, size, fewer, df = (x[order] for x in (token, key, size, fewer, df))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)])) if len(key) else np.zeros(1, np.int64)
        must = -(-num * size // den) - fewer
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        columns = {"key": [int(key[a]) for a, _ in spans], "must": [int(must[a]) for a, _ in spans], "tokens": [token[a:b].tobytes() for a, b in spans], "dfs": [df[a:b].tobytes() for a, b in spans]}
        return pd.DataFrame(columns, columns=list(columns))

    return find


def _parted(open_: DataFrame, total: int, num: int, den: int, bin_tokens: int, sample: int, least: int) -> DataFrame:
    """(key, cluster): clusters of the classes of ``open_`` (key, cluster, label, hashes; ``total`` rows) that may have a partner of another label.

    As steps 2 and 3, inside each cluster and on whole sets: a class ends whose tokens in other classes, of another label and
    a size near enough, are fewer than a partner must share.
    """
    spark = open_.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = open_.agg(F.sum(F.octet_length("hashes"))).first()[0] // 8
    bins = max(parts, -(-tokens // bin_tokens))
    tasks = min(bins, MAX_TASKS)

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_whole(c, h).tobytes() for c, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["key", "tokens"])

    picked = open_.filter(about(F.xxhash64("key", F.lit(5)), sample, total)).select("key", "cluster", "hashes")
    common = spark.sparkContext.broadcast(_standing_in(picked.mapInArrow(blobs, "key long, tokens binary").dropDuplicates(["key"]), least))
    found = _whole_binned(open_, bins, common).repartition(tasks, "bin").groupBy("bin").applyInPandas(_open_tokens(num, den), "key long, must long, tokens binary, dfs binary")
    found = scratch.written(found, "jaccard-open")
    shared = found.groupBy("key").agg(F.max("must").alias("must"), F.collect_list("tokens").alias("tokens"), F.collect_list("dfs").alias("dfs"))
    kept = shared.mapInArrow(_kept_tokens(bins, lambda must: must, common), "bin long, tokens binary, owners binary")
    stars = scratch.written(kept.repartition(tasks, "bin").groupBy("bin").applyInPandas(_stars, "a long, b long").distinct(), "jaccard-stars")
    clusters = components(stars, "jaccard-clusters").select(F.col("node").alias("key"), F.col("label").alias("cluster"))
    clusters = scratch.written(clusters.join(found.select("key").distinct(), "key", "left_semi"), "jaccard-members")
    scratch.removed(found, stars)
    return clusters


def _blocked(clusters: DataFrame, block: int) -> DataFrame:
    """``clusters`` (key, cluster) with members and blocks of the cluster, and the block of the class."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    return clusters.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("members") / block)).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))


def _within(sets: DataFrame, parts: int, block: int, join) -> DataFrame:
    """Links inside the clusters of one block, and inside each other block of a larger cluster and its block 0."""
    # A bundle is either a share of the clusters of one block, or a block of a larger cluster with that cluster's block 0.
    bundles = max(parts, -(-(sets.count()) // block))
    spread = F.when(F.col("blocks") == 1, F.array(F.pmod(F.xxhash64("cluster"), F.lit(bundles)))).otherwise(
        F.when(F.col("block") > 0, F.array("block")).otherwise(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1))
    )
    of = F.when(F.col("blocks") > 1, F.col("cluster"))
    first = sets.select(of.alias("of"), F.explode(spread).alias("bundle"), "cluster", "key", "label", F.lit(True).alias("marked"), "hashes")
    first = first.repartition(max(parts, min(MAX_TASKS, bundles // TASK_BUNDLES)), "of", "bundle")
    return first.groupBy("of", "bundle").applyInPandas(join, "a long, b long")


def _join_blocks(num: int, den: int):
    """Links inside the clusters of a group of rows (cluster, key, label, marked, hashes)."""

    def join(part: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, own in part.groupby("cluster", sort=False):
            own = own.sort_values("marked", ascending=False, kind="stable").drop_duplicates("key")
            keys, labels = own["key"].to_numpy(), own["label"].to_numpy()
            if len(keys) < 2 or (labels == labels[0]).all():
                continue
            sets = [np.frombuffer(h, np.uint64) for h in own["hashes"]]
            edges += [(int(keys[x]), int(keys[y])) for x, y in linking_pairs(sets, labels, own["marked"].to_numpy(bool), num, den)]
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return join


def _labelled(members: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``members`` with the component of each key, its own key where it has no link."""
    labels = components(links, name).select(F.col("node").alias("key"), F.col("label").alias("found"))
    return members.join(labels, "key", "left").withColumn("label", F.coalesce("found", "key")).drop("found")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, bin_tokens: int = BIN_TOKENS, common_sample: int = COMMON_SAMPLE, common_docs: int = COMMON_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, text_hash (of the row's text, to find the row again).

    Two documents link when den * |A and B| >= num * |A or B| of their sets of ``k``-word shingles
    (see ``shingles``); component_id is the smallest doc_id reachable by links, itself included.

    Null and blank texts have the empty set, link with nothing and are their own component. Texts
    with equal sets, repeated rows among them, link. A row without an id takes no part: its
    component_id is null. Other columns are not read. Empty in, empty out.
    """
    spark, seed = docs.sparkSession, new_seed()
    rows = _documents(docs, id_col, text_col)
    described = scratch.written(_described(rows, k, seed), "jaccard-documents")
    classes = described.filter("n > 0 AND doc_id IS NOT NULL").groupBy("key", "key2", "n").agg(F.min("doc_id").alias("rep"))
    classes = scratch.written(classes, "jaccard-classes")
    total, many = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = max(parts, -(-total // (2 * bin_tokens)))

    common = _common_tokens(rows, described, k, seed, num, den, common_sample, common_docs)  # bounded by the sample
    rounds = max(1, min(ROUNDS, bins // (2 * parts)))
    binned = _binned(rows, k, seed, bins, num, den, spark.sparkContext.broadcast(common)).withColumn("round", F.pmod("bin", F.lit(rounds)))
    binned = dealt = scratch.written(binned, "jaccard-bins", ["round"])
    crowding = _crowding_tokens(binned, bins)
    if len(crowding):
        common = np.union1d(common, crowding)
    # As many tasks as bins, so that none reads more when the input grows; memory is that of a bin even where a task has several.
    tasks, shared = min(bins, MAX_TASKS), []
    for r in range(rounds):
        own = binned.filter(F.col("round") == r).select(*dealt.columns[:-1])
        if len(crowding):
            own = _thinned(own, bins, spark.sparkContext.broadcast(crowding))
        found = own.drop("size").repartition(-(-tasks // rounds), "bin").groupBy("bin").applyInPandas(_shared_tokens, "key long, tokens binary, dfs binary")
        shared.append(scratch.written(found, "jaccard-shared"))
        scratch.removed_part(dealt, f"round={r}")
    common = spark.sparkContext.broadcast(common)
    found = reduce(DataFrame.union, shared).groupBy("key").agg(F.collect_list("tokens").alias("tokens"), F.collect_list("dfs").alias("dfs"))
    kept = found.join(classes.select("key", "n"), "key").select("key", "n", "tokens", "dfs").mapInArrow(_kept_tokens(bins, lambda n: _prefix(n, num, den)[1], common), "bin long, tokens binary, owners binary")
    kept = scratch.written(kept, "jaccard-kept")
    scratch.removed(dealt, *shared)
    stars = scratch.written(kept.repartition(tasks, "bin").groupBy("bin").applyInPandas(_stars, "a long, b long").distinct(), "jaccard-stars")
    clusters = components(stars, "jaccard-clusters").select(F.col("node").alias("key"), F.col("label").alias("cluster"))
    clusters = scratch.written(clusters.join(classes.select("key"), "key", "left_semi"), "jaccard-members")  # without the tokens among the nodes
    scratch.removed(stars, kept)

    wanted = _blocked(clusters, block).join(classes.select("key", "rep"), "key")
    sets = scratch.written(_with_sets(rows, wanted, k, seed).withColumn("label", F.col("key")), "jaccard-sets")
    scratch.removed(clusters)

    join, found, last = _join_blocks(num, den), [], None
    while True:
        found.append(scratch.written(_within(sets, parts, block, join), "jaccard-links"))
        links = reduce(DataFrame.union, found)
        large = sets.filter("blocks > 1")
        if not large.limit(1).count():
            break
        # Similar sets are at most one band of sizes apart; the width is a little above the ratio, for the logarithm's last digits.
        width = max(math.log(den / num), 1e-6) * (1 + 1e-6)
        large = large.withColumn("band", F.floor(F.log(F.octet_length("hashes")) / width))
        state = scratch.written(_labelled(large.drop("hashes", "label"), links, "jaccard-first"), "jaccard-state")
        by_label = state.groupBy("cluster", "blocks", "label").agg(F.count(F.lit(1)).alias("size"))
        main = by_label.groupBy("cluster", "blocks").agg(F.max(F.struct("size", "label")).alias("m"), F.sum("size").alias("members"))
        main = main.select("cluster", "blocks", "members", F.col("m.label").alias("main"), (F.col("members") - F.col("m.size")).alias("apart")).filter("apart > 0")
        taking_part, moves = main.agg(F.sum("members"), F.sum(F.col("apart") * F.col("blocks"))).first()
        if not taking_part:
            scratch.removed(state)
            break
        if moves > MOVES * many and (last is None or 2 * moves < last):
            last = moves
            open_ = large.select("key", "hashes").join(state.join(main.select("cluster"), "cluster", "left_semi").select("cluster", "key", "label"), "key")
            open_ = scratch.written(open_.select("key", "cluster", "label", "hashes"), "jaccard-apart")
            clusters = _parted(open_, taking_part, num, den, bin_tokens, common_sample, common_docs)
            finer = scratch.written(open_.drop("cluster").join(_blocked(clusters, block), "key"), "jaccard-sets")
            scratch.removed(sets, state, open_, clusters)
            sets = finer
            continue
        main = main.select("cluster", "main")
        outside = state.join(main, "cluster").filter("label <> main").groupBy("cluster", "main", "band").agg(F.ceil(F.count(F.lit(1)) / block).alias("groups"))
        # One row a cluster: the bands of its outside classes, as many as sizes have, each with its number of groups.
        outside = outside.groupBy("cluster", "main").agg(F.collect_list(F.struct("band", "groups")).alias("bands"))
        open_ = state.join(outside, "cluster").select("cluster", "key", "block", "blocks", "band", "label", "main", "bands")
        open_ = large.select("key", "hashes").join(open_, "key")
        close = F.filter("bands", lambda b: F.abs(b["band"] - F.col("band")) <= 1)
        own = F.filter("bands", lambda b: b["band"] == F.col("band"))[0]["groups"]
        every = F.explode(F.flatten(F.transform(close, lambda b: F.transform(F.sequence(F.lit(0).cast("long"), b["groups"] - 1), lambda g: F.struct(b["band"].alias("band"), g.alias("group"))))))
        wide = open_.select("cluster", every.alias("to"), "block", "key", "label", F.lit(False).alias("marked"), "hashes")
        to = F.struct("band", F.pmod(F.xxhash64("key", F.lit(1)), own).alias("group"))
        across = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        rest = open_.filter("label <> main").select("cluster", to.alias("to"), across.alias("block"), "key", "label", F.lit(True).alias("marked"), "hashes")
        more = wide.union(rest).groupBy("cluster", "to", "block").applyInPandas(join, "a long, b long")
        found.append(scratch.written(more, "jaccard-rest"))
        links = reduce(DataFrame.union, found)
        scratch.removed(state)
        break

    linked = components(links, "jaccard-final").select(F.col("node").alias("key"), "label")
    scratch.removed(sets, *found)
    linked = linked.join(classes.select("key", "rep"), "key")
    smallest = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
    linked = linked.join(smallest, "label").select("key", "component_id")
    final = classes.select("key", "key2", "rep").join(linked, "key", "left").select("key", "key2", F.coalesce("component_id", "rep").alias("component_id"))
    return described.join(final, ["key", "key2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "text_hash"
    )


def _with_sets(rows: DataFrame, wanted: DataFrame, k: int, seed: int) -> DataFrame:
    """``wanted`` (key, rep and more) with ``hashes``: the whole set, made again from the text of ``rep``."""
    columns = [c for c in wanted.columns if c != "rep"]
    schema = T.StructType([*(f for f in wanted.schema.fields if f.name != "rep"), T.StructField("hashes", T.BinaryType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # An id that stands on several rows brings all their texts; the key says which is meant.
            made = [s.tobytes() if set_key(s)[0] == key else None for s, key in zip(shingle_sets(_texts(batch, len(columns)), k, seed), batch.column("key").to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], [*columns, "hashes"])
            yield out.filter(out.column("hashes").is_valid())

    texts = rows.join(wanted, rows["doc_id"] == wanted["rep"]).select(*columns, "data")
    return texts.mapInArrow(add, schema)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id. All columns stay.

    Rows go by id and text, so another text under the same id stays; rows without an id stay.
    """
    found = jaccard_components(docs, id_col=id_col, text_col=text_col)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_text")).distinct()
    same = (docs[id_col].cast("long") == gone["__gone_id"]) & (F.xxhash64(docs[text_col].cast("string")) == gone["__gone_text"])
    return docs.join(gone, same, "left_anti")


def keep_one_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, with all its columns: of the smallest id, null last.

    Every row takes part under a key made once in a table in the shared folder, so rows without an
    id and rows that repeat one link like others, and of rows that tie only one stays. Rows of
    null and blank texts link with nothing and stay.
    """
    row = free_name("row", docs.columns)
    keyed = scratch.written(docs.withColumn(row, F.monotonically_increasing_id()), "jaccard-rows")
    found = jaccard_components(keyed, id_col=row, text_col=text_col).select(F.col("doc_id").alias("row"), "component_id")
    ids = keyed.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "row")
    stay = found.join(ids, "row").groupBy("component_id").agg(F.min(order).alias("m")).select(F.col("m.row").alias(row))
    return keyed.join(stay, row, "left_semi").select(*[keyed[c] for c in docs.columns])


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS s
  FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM g),
l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (
  SELECT doc_id, doc_id AS c FROM g
  UNION
  SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, m.c AS component_id
FROM g JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = g.doc_id
"""
