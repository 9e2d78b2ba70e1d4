"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.tokens import TokenEncoder, vocabulary_path

#: Pieces that one task packs together. About 12,000 sequences, of which one or two stay part empty.
SHARD_PIECES = 50_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_NUMBER = "task int, number long"


class OpenBins:
    """Open bins by remaining capacity, in a segment tree whose nodes say whether any bin is below.

    ``tightest(need)`` finds the smallest remaining capacity of at least ``need`` in time
    logarithmic in the capacity; bins of equal capacity are taken last in, first out.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, remaining: int, number: int) -> None:
        self.bins[remaining].append(number)
        node = remaining + self.leaves
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """The fullest bin that still has ``need`` left, taken out: (remaining, number)."""
        node = need + self.leaves
        while not self.some[node]:
            while node & 1:  # no sibling on the right: go up
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.some[2 * node])
        remaining = node - self.leaves
        number = self.bins[remaining].pop()
        if not self.bins[remaining]:
            self.some[node] = 0
            node >>= 1
            while node and not (self.some[2 * node] or self.some[2 * node + 1]):
                self.some[node] = 0
                node >>= 1
        return remaining, number


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each length, in the given order; lengths must not increase."""
    open_bins, where, offsets, count = OpenBins(capacity), [], [], 0
    for length in lengths:
        found = open_bins.tightest(length)
        if found is None:
            found = (capacity, count)
            count += 1
        remaining, number = found
        where.append(number)
        offsets.append(capacity - remaining)
        if remaining > length:
            open_bins.put(remaining - length, number)
    return where, offsets


def pieces(docs: DataFrame, capacity: int = 4096, end_id: int = 1, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32; and the task that cut it, with a running number there.

    A document is its ids and then ``end_id``; only one longer than ``capacity`` is cut, into full
    pieces and a last one that may be shorter. The sum is that of the ids as little-endian unsigned
    32-bit numbers. Narrow: ids stay in the task.
    """
    path = vocabulary or vocabulary_path()
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, count = TokenEncoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, numbers, starts, lengths, sums = [], [], [], [], []
            for doc_id, data in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1)), strict=True):
                data += end
                for n, start in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[start : start + 4 * capacity]
                    ids.append(doc_id)
                    numbers.append(n)
                    starts.append(start // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = (ids, numbers, starts, lengths, sums, [task] * len(ids), range(count, count + len(ids)))
            count += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("data"))
    return rows.mapInArrow(cut, f"{_PIECES}, {_NUMBER}")


def pack(docs: DataFrame, capacity: int = 4096, end_id: int = 1, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pieces of every document with their places: adds sequence_id and offset.

    Pieces are written, then dealt into shards of about ``shard_pieces`` by a hash of the task that
    cut them and their number there, so every shard has the same mix of lengths and repeated rows
    spread like all others. Each shard is packed by best-fit decreasing; no task holds much more than a shard,
    whatever the input. Against one packing of everything this costs at most the few part-filled
    sequences that end each shard. Places are gapless from 0.

    Null and empty texts are a document of ``end_id`` alone. Null ids are kept and sort first;
    repeated rows are packed once each; ties go by id and piece. Other columns are not read.
    Empty in, empty out.
    """
    cut = scratch.written(pieces(docs, capacity, end_id, vocabulary, id_col, text_col), "pack-pieces")
    shards = max(1, -(-cut.count() // shard_pieces))

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], na_position="first", kind="stable")
        where, offsets = best_fit_decreasing(part["length"].tolist(), capacity)
        number = part["shard"].iloc[0] * (1 << 32) + pd.Series(where, index=part.index, dtype="int64")
        return part.drop(columns="shard").assign(sequence_id=number, offset=pd.Series(offsets, index=part.index, dtype="int64"))

    shard = F.pmod(F.xxhash64("task", "number"), F.lit(shards))
    return cut.withColumn("shard", shard).drop("task", "number").groupBy("shard").applyInPandas(place, f"{_PIECES}, sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
