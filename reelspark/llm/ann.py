"""Nearest neighbours by inner product over an additive quantiser.

A vector is stored as one codeword of each of ``BOOKS`` full-dimensional codebooks whose sum is
near it. Codebooks are fitted one after the other on what the earlier ones leave over, on a bounded
sample; every row is encoded, by beam search over the sums. A query scores rows by looking up its
inner products with all codewords, corrected by the stored norm; the best of a task's rows are
ranked anew by the original vectors, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.sampling import about

BOOKS, WORDS, BEAM = 12, 256, 4
#: Vectors that codebooks are fitted on, at most (chosen by hash), and passes of their fit.
MAX_FIT, PASSES = 8_192, 8
#: Queries searched together, sent to every task; rows scored together, of which the best are ranked anew, per query.
QUERY_BLOCK, ROW_SLICE, SHORTLIST = 4_096, 8_192, 300
#: Queries scored at once in a task.
QUERY_STEP = 64

_FOUND = "query_id long, rank int, vec_id long, score double"


class _Beam:
    """Partial sums of codewords for each of ``x``: residuals, costs and codes of the ``width`` best."""

    def __init__(self, x: np.ndarray, width: int):
        self.width = width
        self.left, self.cost, self.codes = x[:, None, :], np.zeros((len(x), 1), np.float32), np.zeros((len(x), 1, 0), np.uint8)

    def extend(self, book: np.ndarray) -> None:
        """Add a word of ``book`` to every sum; adding w to a sum that leaves r changes the squared distance by |w|^2 - 2 w.r."""
        n, beam, dim = self.left.shape
        total = (self.left.reshape(-1, dim) @ (-2 * book.T)).reshape(n, beam, len(book))
        total += (book * book).sum(1)
        total += self.cost[:, :, None]
        flat, row = total.reshape(n, -1), np.arange(n)
        best = np.empty((n, min(self.width, flat.shape[1])), np.int64)
        self.cost = np.empty(best.shape, np.float32)
        for k in range(best.shape[1]):
            best[:, k] = flat.argmin(axis=1)
            self.cost[:, k] = flat[row, best[:, k]]
            flat[row, best[:, k]] = np.inf
        parent, word = best // len(book), best % len(book)
        self.left = self.left[row[:, None], parent] - book[word]
        self.codes = np.concatenate((self.codes[row[:, None], parent], word[:, :, None].astype(np.uint8)), axis=2)


def fit_codebooks(x: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 5) -> np.ndarray:
    """(books, words, dimensions) by k-means on residuals; each book sees what beam search leaves to it."""
    rng, dim = np.random.default_rng(seed), x.shape[1]
    out = np.zeros((books, words, dim), np.float32)
    if not len(x):
        return out
    beam, row = _Beam(x, BEAM), np.arange(len(x))
    for m in range(books):
        left = beam.left[row, beam.cost.argmin(axis=1)]
        book = left[rng.choice(len(left), words, replace=len(left) < words)]
        for _ in range(PASSES):
            own = np.argmin((book * book).sum(1) - 2 * (left @ book.T), axis=1)
            count = np.bincount(own, minlength=words)
            sums = np.bincount((own[:, None] * dim + np.arange(dim)).ravel(), left.ravel(), words * dim).reshape(words, dim)
            book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book).astype(np.float32)
        out[m] = book
        beam.extend(book)
    return out


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, books) by beam search, and the squared norms of what they stand for."""
    codes = np.zeros((len(x), len(books)), np.uint8)
    for a in range(0, len(x), 1024):
        sums = _Beam(x[a : a + 1024], beam)
        for book in books:
            sums.extend(book)
        codes[a : a + 1024] = sums.codes[np.arange(len(sums.cost)), sums.cost.argmin(axis=1)]
    made = decode(codes, books)
    return codes, (made * made).sum(1)


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum((book[codes[:, m]] for m, book in enumerate(books)), np.zeros((len(codes), books.shape[2]), np.float32))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dim)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part.

    Out are null ids, and vectors that are null, empty, all zero, or hold a null or a number that is not finite.
    """
    v = F.col(vector_col).cast("array<double>")
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    )


def build_index(good: DataFrame, dim: int, max_fit: int = MAX_FIT) -> tuple[DataFrame, np.ndarray]:
    """Every row of ``good``, all of ``dim`` components, with its codes and norms as a table in the shared folder, and the codebooks (of fixed size).

    Codes are of the vectors over one power of two, above all components, so that single precision neither overflows nor loses digits.
    """
    total, largest = good.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    power = math.frexp(largest or 1.0)[1]
    hashed = F.xxhash64("vec_id", "vector")
    picked = good.filter(about(hashed, max_fit, total)).orderBy(hashed, "vec_id").limit(max_fit)  # repeated rows are picked together
    x = np.ldexp(np.array([r["vector"] for r in picked.select("vector").collect()], np.float64).reshape(-1, dim), -power).astype(np.float32)
    books = fit_codebooks(x)
    sent = good.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.ldexp(_vectors(batch.column(1), dim), -power).astype(np.float32)
            codes, norms = encode(v, sent.value)
            ratio = np.sqrt((v * v).sum(1) / np.maximum(norms, 1e-12))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(ratio, pa.float32())], ["vec_id", "vector", "codes", "norm"])

    index = scratch.written(good.mapInArrow(add, "vec_id long, vector array<double>, codes binary, norm float"), "ann-index")
    sent.destroy()
    return index, books


def shortlisted(rough: np.ndarray, width: int) -> np.ndarray:
    """For each row of ``rough`` the places of its ``width`` largest, in order of place; of equals the first ones."""
    if width >= rough.shape[1]:
        return np.broadcast_to(np.arange(rough.shape[1]), rough.shape)
    cut = np.partition(rough, rough.shape[1] - width, axis=1)[:, rough.shape[1] - width, None]
    keep, tied = rough > cut, rough == cut
    need = width - keep.sum(axis=1)
    more = tied.sum(axis=1) > need
    tied[more] &= np.cumsum(tied[more], axis=1) <= need[more, None]
    return np.nonzero(keep | tied)[1].reshape(len(rough), width)


def search(index: DataFrame, books: np.ndarray, queries: DataFrame, dim: int, k: int = 20, shortlist: int = SHORTLIST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the largest inner products found for each of ``queries`` (vec_id, vector).

    Queries go over the index in blocks of about ``QUERY_BLOCK``. A block is searched, its result
    appended to a table in the shared folder and its broadcast given back before the next is read,
    so neither driver nor tasks hold more than a block. A task scores slices of ``ROW_SLICE`` rows
    by lookup tables and ranks the ``shortlist`` best of each anew by the original vectors; rows whose rough
    scores tie enter it by vec_id. ``k`` a query and task are ranked once more.
    """
    spark = index.sparkSession
    queries = scratch.written(queries.groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-queries")
    blocks = -(-queries.count() // QUERY_BLOCK)
    table = spark.sparkContext.broadcast(books)
    folder = f"{scratch.shared_dir(spark)}/{scratch.unique('ann-found')}"
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)) == b).collect()
        ids, vectors = np.array([r["vec_id"] for r in block], np.int64), np.array([r["vector"] for r in block], np.float64).reshape(-1, dim)
        sent = spark.sparkContext.broadcast((ids, vectors))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, q = sent.value
            level = np.ldexp(q, -np.frexp(np.abs(q).max(axis=1, initial=0))[1][:, None]).astype(np.float32)  # a query's own power of two changes no order
            lookup = np.stack([level @ book.T for book in table.value])  # books x queries x words
            best_id = np.zeros((len(ids), 0), np.int64)
            best_score = np.zeros((len(ids), 0))
            for batch in batches:
                for a in range(0, batch.num_rows, ROW_SLICE):
                    part = batch.slice(a, ROW_SLICE)
                    by_id = np.argsort(part.column(0).to_numpy(), kind="stable")
                    rows, v = part.column(0).to_numpy()[by_id], _vectors(part.column(1), dim)[by_id]
                    codes = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(rows), -1)[by_id].T.astype(np.int64)
                    norm = part.column(3).to_numpy()[by_id]
                    width = min(shortlist, len(rows))
                    got_id, got_score = np.zeros((len(ids), width), np.int64), np.zeros((len(ids), width))
                    for n in range(0, len(ids), QUERY_STEP):
                        own = slice(n, n + QUERY_STEP)
                        rough = lookup[0, own].take(codes[0], axis=1)
                        for m in range(1, len(codes)):
                            rough += lookup[m, own].take(codes[m], axis=1)
                        rough *= norm
                        near = shortlisted(rough, width)
                        got_id[own] = rows[near]
                        got_score[own] = np.where(rows[near] == ids[own, None], -np.inf, (v[near] * q[own, None]).sum(axis=2))
                    new_id, new_score = np.hstack((best_id, got_id)), np.hstack((best_score, got_score))
                    order = np.lexsort((new_id, -new_score), axis=1)[:, :k]
                    best_id, best_score = np.take_along_axis(new_id, order, 1), np.take_along_axis(new_score, order, 1)
            n = best_id.shape[1]
            keep = np.isfinite(best_score.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)[keep]), pa.array(best_id.ravel()[keep]), pa.array(best_score.ravel()[keep])], ["query_id", "vec_id", "score"])

        found = index.mapInArrow(scan, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        best.write.mode("append").parquet(folder)
        sent.destroy()
    table.destroy()
    if not blocks:
        return spark.createDataFrame([], _FOUND)
    return spark.read.schema(_FOUND).parquet(folder)


def nearest(rows: DataFrame, query_filter, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest of all rows for those that ``query_filter`` (a condition on vec_id) picks; see ``search``.

    Rows that ``usable`` leaves out are neither queries nor candidates. Vectors of different length
    have no inner product: each length that has queries gets an index of its own. A query's own id is no
    candidate, so repeats of its row are none either; other repeated rows are candidates each.
    Ties go to the smaller id. Fewer candidates than ``k``: all of them. Other columns are not
    read. Empty in, empty out.
    """
    good = usable(rows, id_col, vector_col)
    out = None
    for (dim,) in good.filter(query_filter).select(F.size("vector")).distinct().collect():
        index, books = build_index(good.filter(F.size("vector") == dim), dim)
        found = search(index, books, index.filter(query_filter).select("vec_id", "vector"), dim, k)
        out = found if out is None else out.union(found)
    return out if out is not None else rows.sparkSession.createDataFrame([], _FOUND)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
