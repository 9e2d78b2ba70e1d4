"""Documents in blocks: rows of some megabytes of text, the unit that tasks hash and get answers for.

Work that must know where else a window or phrase occurs goes in three moves. Each block sends what
it holds as sorted hashes, cut into *tiles* by hash; a tile sees what all blocks sent; it answers each
block by bits or numbers in the order the block sent. So a window moves a few bytes, and the text
stays with its block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark import scratch

#: Bytes of text in a block, and of all texts per tile.
BLOCK_BYTES, TILE_BYTES = 1 << 22, 1 << 23
#: Tasks of a stage at most, as many as a driver can keep track of; beyond, tasks hold several tiles, one after the other.
MAX_TASKS = 100_000

_KINDS = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def blocked(docs: DataFrame, id_col: str, text_col: str, carry: dict[str, str] | None = None, size: int = BLOCK_BYTES) -> DataFrame:
    """A table in the shared folder: block, n_bytes, ids, texts (arrays, by id), and an array for each of ``carry`` (name: string column).

    Blocks are filled by each task in turn, from about ``size`` bytes of text; a longer text is alone. Each has a row group of its own.
    Rows without an id are in blocks of their own, in which ids are null. Null texts are empty.
    """
    carry = carry or {}
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), *[F.col(c).cast("string").alias(n) for n, c in carry.items()]
    )
    arrays = {"ids": pa.int64(), "texts": pa.binary(), **dict.fromkeys(carry, pa.string())}
    names = ["block", "n_bytes", *arrays]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        open_: dict[bool, tuple[list, int]] = {True: ([], 0), False: ([], 0)}

        def closed(rows: list, held: int) -> pa.RecordBatch:
            nonlocal number
            rows.sort(key=lambda r: (r[0] or 0, *r[1:2]))
            columns = [pa.array([list(c)], pa.list_(t)) for c, t in zip(zip(*rows, strict=True), arrays.values(), strict=True)]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([held]), *columns], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = row[0] is None
                own, held = open_[kind]
                if own and held + len(row[1]) > size:
                    yield closed(own, held)
                    own, held = [], 0
                own.append(row)
                open_[kind] = own, held + len(row[1])
        for own, held in open_.values():
            if own:
                yield closed(own, held)

    schema = ", ".join(["block long", "n_bytes long", "ids array<long>", "texts array<binary>", *(f"{c} array<string>" for c in carry)])
    return scratch.written(rows.mapInArrow(fill, schema), "blocks", None, "8m", 1)


def tiles_of(blocks: DataFrame, size: int = TILE_BYTES) -> int:
    """Number of tiles: in proportion to the bytes of all texts, so that a tile stays as large as it is."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size))


def by_tile(tile: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(tile, begin, end) of the runs of a sorted array."""
    if len(tile):
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield int(tile[a]), a, b


def table_of(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.values(), strict=True)], list(schema))


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of some megabytes, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def with_answers(blocks: DataFrame, *answers: DataFrame, how: str = "inner") -> DataFrame:
    """``blocks`` with ``answers``: an array of the answer rows (block, and columns of one kind each) of a block.

    Answers are far smaller than texts, so they are the side that is hashed, and texts are not sorted.
    """
    every = None
    for k, a in enumerate(answers):
        rows = a.select("block", F.struct(F.lit(k).alias("kind"), *[c for c in a.columns if c != "block"]).alias("answer"))
        every = rows if every is None else every.union(rows)
    grouped = every.groupBy("block").agg(F.collect_list("answer").alias("answers"))
    return blocks.join(grouped.hint("shuffle_hash"), "block", how)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs."""
    for width in (1, 2, 4):
        if numbers.max(initial=0) < 1 << 8 * width:
            return numbers.astype(f"<u{width}").tobytes()
    return numbers.astype("<u8").tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // count}" if count else np.uint8).astype(np.int64)
