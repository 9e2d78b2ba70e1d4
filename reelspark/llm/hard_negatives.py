"""Hard negatives by a pivot table: brackets of inner products from stored distances, exact checks of what they leave.

With M the largest norm, a row x gets one more coordinate sqrt(M^2 - |x|^2) and an anchor q gets 0, so
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x: the larger the inner product, the nearer. Every row is stored with its
distances to a few pivots. Those of the anchor to the same pivots bracket the distance, by the triangle
inequality, and so the score, first for a whole chunk of rows, then row by row. Only rows whose bracket
can still change an answer are scored, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.blocks import table_of
from reelspark.llm.sampling import about

#: Pivots, the rows with the smallest hashes; rows of a chunk; anchors searched together, sent to every task.
PIVOTS, CHUNK, ANCHOR_BLOCK = 16, 1_024, 4_096
#: Anchors compared with a chunk at once.
STEP = 256
#: Squared norms stay below, so that every score fits 64 bits.
NORM_LIMIT = float(1 << 62)

_CHUNKS = {"chunk": pa.int64(), "ids": pa.binary(), "labels": pa.binary(), "vectors": pa.binary(), "norms": pa.binary(), "distances": pa.binary()}
_CHUNKS_SQL = "chunk long, ids binary, labels binary, vectors binary, norms binary, distances binary"
_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label, vector (floor(256 x) of each component, as doubles), norm2 of the rows that take part; see ``hard_negatives``."""
    x = F.col(vector_col).cast("array<double>")
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    good = good.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    good = good.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * 256).cast("double")).alias("vector"))
    norm2 = F.aggregate("vector", F.lit(0.0), lambda s, c: s + c * c)
    return good.withColumn("norm2", norm2).filter(F.col("norm2") < NORM_LIMIT)


def distances(scalar: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of augmented vectors, from their inner products and squared norms."""
    return np.sqrt(np.maximum(one[:, None] + other[None, :] - 2 * scalar, 0))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products of integer vectors, exactly: in doubles where no sum can pass 2^53."""
    if q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


class Pivots:
    """Pivot vectors with what makes inner products distances; ``top`` is the largest squared norm."""

    def __init__(self, vectors: np.ndarray, top: float):
        self.vectors, self.top = vectors, top
        self.more = np.sqrt(np.maximum(top - (vectors * vectors).sum(1), 0))

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))
        full = np.full(len(x), self.top), np.full(len(self.vectors), self.top)
        return distances(x @ self.vectors.T + more[:, None] * self.more, *full)

    def of_anchors(self, q: np.ndarray) -> np.ndarray:
        return distances(q @ self.vectors.T, (q * q).sum(1), np.full(len(self.vectors), self.top))


def brackets(both: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores are between these if distances are between ``near`` and ``far``; ``both``: |q|^2 + M^2.

    Wider by what rounding may do: a distance near 0 is off by the square root of a double's last digits.
    """
    slack = 1e-6 * both + 1
    return (both - far * far) / 2 - slack, (both - near * near) / 2 + slack


def build_table(good: DataFrame, dim: int, top: float, total: int) -> tuple[DataFrame, Pivots]:
    """Every row of ``good`` with its distances to the pivots, in chunks of rows near the same pivot, as a table in the shared folder."""
    hashed = F.xxhash64("vec_id", "vector")
    picked = good.filter(about(hashed, 4 * PIVOTS, total)).orderBy(hashed, "vec_id").limit(PIVOTS).select("vector").collect()
    pivots = Pivots(np.array([r["vector"] for r in picked], np.float64).reshape(len(picked), dim), top)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            v = np.asarray(batch.column(2).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ids), dim)
            away = pivots.of_rows(v)
            nearest = away.argmin(axis=1)
            order = np.lexsort((away[np.arange(len(ids)), nearest], nearest))
            for a in range(0, len(ids), CHUNK):
                own = order[a : a + CHUNK]
                own = own[np.argsort(ids[own], kind="stable")]
                number += 1
                yield table_of(_CHUNKS, [(number, ids[own].tobytes(), labels[own].tobytes(), v[own].astype(np.int32).tobytes(), (v[own] ** 2).sum(1).tobytes(), away[own].tobytes())])

    return scratch.written(good.select("vec_id", "label", "vector").mapInArrow(pack, _CHUNKS_SQL), "pivot-table"), pivots


class _Chunk:
    def __init__(self, row: dict, dim: int):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(self.ids), dim).astype(np.int64)
        self.away = np.frombuffer(row["distances"], np.float64).reshape(len(self.ids), -1)
        self.low, self.high = self.away.min(axis=0), self.away.max(axis=0)


class Anchors:
    """A block of anchors, by id."""

    def __init__(self, rows: list, pivots: Pivots):
        self.ids, self.labels = np.array([r["vec_id"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64)
        self.vectors = np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), -1).astype(np.int64)
        self.away = pivots.of_anchors(self.vectors.astype(np.float64))
        self.both = (self.vectors.astype(np.float64) ** 2).sum(1) + pivots.top

    def scored(self, chunk: _Chunk, least: np.ndarray, most: np.ndarray, same_label: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores) of the rows of a chunk, of the anchor's label or of others, that may score between ``least`` and ``most``."""
        near = np.maximum(np.maximum(self.away - chunk.high, chunk.low - self.away), 0).max(axis=1, initial=0)
        far = (self.away + chunk.high).min(axis=1, initial=np.inf)
        low, high = brackets(self.both, near, far)
        open_ = np.flatnonzero((high >= least) & (low <= most))
        for a in range(0, len(open_), STEP):
            own = open_[a : a + STEP]
            near, far = np.zeros((len(own), len(chunk.ids))), np.full((len(own), len(chunk.ids)), np.inf)
            for p in range(self.away.shape[1]):
                q, x = self.away[own, p, None], chunk.away[None, :, p]
                np.maximum(near, np.abs(q - x), out=near)
                np.minimum(far, q + x, out=far)
            low, high = brackets(self.both[own, None], near, far)
            left = (high >= least[own, None]) & (low <= most[own, None]) & ((self.labels[own, None] == chunk.labels) == same_label) & (self.ids[own, None] != chunk.ids)
            rows = np.flatnonzero(left.any(axis=0))
            if not len(rows):
                continue
            score = products(self.vectors[own], chunk.vectors[rows])
            left = left[:, rows]
            for k in np.flatnonzero(left.any(axis=1)).tolist():
                yield int(own[k]), rows[left[k]], score[k, left[k]]


class _Best:
    """For each of ``n`` lists the best ``k`` (score, id) so far; equal scores go by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores, self.ids = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
        self.least = np.full(n, -np.inf)

    def add(self, at: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores[at], scores)), np.concatenate((self.ids[at], ids))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[at], self.ids[at] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[at] = self.scores[at][-1]

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = [len(x) for x in self.ids]
        return np.repeat(np.arange(len(n)), n), np.concatenate([*self.ids, np.zeros(0, np.int64)]), np.concatenate([*self.scores, np.zeros(0, np.int64)])


def _ranked(found: DataFrame, keys: list[str], id_col: str, score_col: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score_col).desc(), id_col)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(table: DataFrame, anchors: Anchors, dim: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = table.sparkSession
    sent = spark.sparkContext.broadcast(anchors)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        best, top = _Best(len(a.ids), positives), np.full(len(a.ids), np.inf)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, dim)
                for k, rows, scores in a.scored(chunk, best.least, top, True):
                    best.add(k, chunk.ids[rows], scores)
        at, ids, scores = best.flat()
        yield pa.RecordBatch.from_arrays([pa.array(a.ids[at]), pa.array(ids), pa.array(scores)], ["anchor_id", "positive_id", "positive_score"])

    found = _ranked(table.mapInArrow(alike, _POSITIVES), ["anchor_id"], "positive_id", "positive_score", positives)
    chosen = found.select("anchor_id", "positive_id", "positive_score").collect()  # a few for each anchor of the block
    place = np.searchsorted(anchors.ids, [r["anchor_id"] for r in chosen])
    pairs = spark.sparkContext.broadcast((place, np.array([r["positive_id"] for r in chosen], np.int64), np.array([r["positive_score"] for r in chosen], np.int64)))

    def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        place, positive, score = pairs.value
        hundreds, rest = np.divmod(score, 100)  # so that no product passes 64 bits
        floor, roof = low * hundreds - (-low * rest // 100), high * hundreds + high * rest // 100
        of = [np.flatnonzero(place == k) for k in range(len(a.ids))]
        best = _Best(len(place), negatives)
        least, most = np.full(len(a.ids), np.inf), np.full(len(a.ids), -np.inf)
        np.minimum.at(least, place, floor)
        np.maximum.at(most, place, roof)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, dim)
                for k, rows, scores in a.scored(chunk, least, most, False):
                    for pair in of[k].tolist():
                        fits = (scores >= max(floor[pair], best.least[pair])) & (scores <= roof[pair])
                        if fits.any():
                            best.add(pair, chunk.ids[rows[fits]], scores[fits])
                    least[k] = np.maximum(floor[of[k]], best.least[of[k]]).min()
        at, ids, scores = best.flat()
        columns = a.ids[place[at]], positive[at], score[at], ids, scores
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    found = table.mapInArrow(unlike, f"{_POSITIVES}, negative_id long, negative_score long")
    found = _ranked(found, ["anchor_id", "positive_id", "positive_score"], "negative_id", "negative_score", negatives)
    out = scratch.written(found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives-found")
    sent.destroy()
    pairs.destroy()
    return out


def hard_negatives(rows: DataFrame, anchor_filter: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as floor(256 x), scores are integer inner products, higher first, ties to the smaller id.
    An anchor (a row that ``anchor_filter``, a condition on vec_id, picks) has its first ``positives`` rows of the same label
    as positives. For each, the first ``negatives`` rows of other labels with low * positive <= 100 * negative <= high * positive.

    No part take rows with a null id, a null label (after ``label``), a null vector, a null or non-finite component, or a squared norm
    from 2^62 up, with which scores need not fit 64 bits. Vectors of different length have no inner product: each
    length is searched by itself. An anchor's own id is no candidate; rows that repeat an id are candidates each, and of anchors
    that repeat one the smallest vector of the smallest label stands. Fewer candidates: all of them. Other columns are not read. Empty in, empty out.

    Anchors go over the table in blocks of about ``ANCHOR_BLOCK``; a task holds a block and a chunk of rows,
    and sends its best few of each anchor. The driver holds a block and its positives.
    """
    spark = rows.sparkSession
    good = scratch.written(usable(rows, id_col, vector_col, label), "negatives-rows")
    out = None
    for dim, total, top in good.groupBy(F.size("vector")).agg(F.count(F.lit(1)), F.max("norm2")).collect():
        own = good.filter(F.size("vector") == dim)
        table, pivots = build_table(own, dim, top, total)
        anchors = own.filter(anchor_filter).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("a")).select("vec_id", "a.label", "a.vector")
        anchors = scratch.written(anchors, "negatives-anchors")
        blocks = -(-anchors.count() // ANCHOR_BLOCK)
        for b in range(blocks):
            block = anchors.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)) == b).orderBy("vec_id").collect()
            if block:
                found = _search(table, Anchors(block, pivots), dim, positives, negatives, low, high)
                out = found if out is None else out.union(found)
        scratch.removed(table, anchors)
    scratch.removed(good)
    return out if out is not None else spark.createDataFrame([], _FOUND)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, label)


OP13_SQL = r"""
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3
"""
