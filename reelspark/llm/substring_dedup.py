"""Removing passages that repeat, by a count-min prefilter and exact grouping of what it leaves.

1. *Sketches*: every block of texts makes a sketch of its distinct windows of words: one row of
   counters, ``2^32`` wide for each tile of hashes, so its width grows with the corpus; a block's
   counter is one at most and only those that are set are sent. Merged by tile, a counter is at
   least the number of blocks that hold a window of it: no repeat between blocks is lost.
2. *Exact groups*: windows whose merged counter shows another block (and few others) are sent with
   128 bits of hash and their document, once a block, to be grouped exactly; each block learns which of its windows
   start earlier elsewhere. Repeats inside a block are grouped where they are.

A window in a third of all documents moves once a block. Texts move only to meet their block's answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.blocks import BLOCK_BYTES, MAX_TASKS, TILE_BYTES, blocked, by_tile, each_row, packed, table_of, tiles_of, with_answers
from reelspark.llm.words import hashes, joined, new_seed, per_text, rolled, spans

#: Words of a window.
WINDOW = 20

_SKETCH = {"tile": pa.int32(), "block": pa.int64(), "cells": pa.binary()}
_EXACT = {"tile": pa.int32(), "block": pa.int64(), "base": pa.int64(), "one": pa.binary(), "two": pa.binary(), "docs": pa.binary()}
_BITS = {"block": pa.int64(), "tile": pa.int32(), "bits": pa.binary()}
_BITS_SQL = "block long, tile int, bits binary"


class _Windows:
    """The windows of a block's texts, in the order of ids and words: hashes, and each one's (tile, counter) as one number."""

    def __init__(self, texts: list[bytes], width: int, tiles: int, seeds: tuple[int, int]):
        self.data = joined(texts)
        self.first, self.last = spans(self.data)
        self.bounds = per_text(texts, self.first)
        n = np.maximum(np.diff(self.bounds) - width + 1, 0)
        self.start = np.repeat(self.bounds[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))  # word that a window begins with
        self.doc = np.repeat(np.arange(len(texts)), n)
        self.width, self.seeds = width, seeds
        self.one = rolled(hashes(self.data, self.first, self.last, seeds[0]), width)[self.start]
        self.cell = ((self.one >> np.uint64(32)) % np.uint64(tiles) << np.uint64(32)) | (self.one & np.uint64(0xFFFFFFFF))

    def two(self) -> np.ndarray:
        return rolled(hashes(self.data, self.first, self.last, self.seeds[1]), self.width)[self.start]


def _tile(cell: np.ndarray) -> np.ndarray:
    return (cell >> np.uint64(32)).astype(np.int64)


def _marked(sorted_tile: np.ndarray, answers: list[dict], kind: int) -> np.ndarray:
    """Bits that tiles answered, for what the block sent, in its order."""
    bits = {a["tile"]: a["bits"] for a in answers if a["kind"] == kind}
    out = np.zeros(len(sorted_tile), bool)
    for tile, a, b in by_tile(sorted_tile):
        if tile in bits:
            out[a:b] = np.unpackbits(np.frombuffer(bits[tile], np.uint8), count=b - a)
    return out


class _Candidates:
    """The windows of a block that other blocks seem to hold, grouped exactly inside the block."""

    def __init__(self, w: _Windows, answers: list[dict]):
        cells = np.unique(w.cell)
        hit = _marked(_tile(cells), answers, 0)
        at = np.flatnonzero(hit[np.searchsorted(cells, w.cell)])
        one, two = w.one[at], w.two()[at]
        order = np.lexsort((at, two, one, _tile(w.cell[at])))
        self.at, one, two = at[order], one[order], two[order]
        new = np.ones(len(at), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.group, self.heads = np.cumsum(new) - 1, self.at[new]  # heads: each one's earliest window of the block
        self.one, self.two, self.tile = one[new], two[new], _tile(w.cell[self.heads])


def _later_inside(w: _Windows) -> np.ndarray:
    """Windows of the block that start earlier in the block, whether others hold them or not."""
    out = np.zeros(len(w.one), bool)
    order = np.argsort(w.one, kind="stable")
    same = np.flatnonzero(w.one[order[1:]] == w.one[order[:-1]])
    if len(same):
        at = order[np.union1d(same, same + 1)]
        one, two = w.one[at], w.two()[at]
        order = np.lexsort((at, two, one))
        again = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        out[at[order[1:][again]]] = True
    return out


def _sketch_merged(group: pa.Table) -> pa.Table:
    """To each block of a tile, which of its counters another block has set too."""
    cells = [np.frombuffer(c, np.uint32) for c in group["cells"].to_pylist()]
    names, counts = np.unique(np.concatenate(cells), return_counts=True)
    several, rows = names[counts > 1], []
    for block, own in zip(group["block"].to_pylist(), cells, strict=True):
        if len(several):
            bits = several[np.minimum(np.searchsorted(several, own), len(several) - 1)] == own
            if bits.any():
                rows.append((block, group["tile"][0].as_py(), np.packbits(bits).tobytes()))
    return pa.Table.from_batches([table_of(_BITS, rows)])


def _exact_merged(group: pa.Table) -> pa.Table:
    """To each block of a tile, which of its windows start earlier in another block."""
    ones, twos, ids, none, who, sizes = [], [], [], [], [], []
    for block, base, one, two, docs in zip(*(group[c].to_pylist() for c in ("block", "base", "one", "two", "docs")), strict=True):
        ones.append(np.frombuffer(one, np.uint64))
        twos.append(np.frombuffer(two, np.uint64))
        n = len(ones[-1])
        sizes.append(n)
        who.append(np.full(n, block))
        none.append(np.full(n, base is None))
        with np.errstate(over="ignore"):
            ids.append(np.frombuffer(docs, f"u{len(docs) // n}").astype(np.uint64) + np.int64(base or 0).astype(np.uint64))
    one, two, who, none = (np.concatenate(x) for x in (ones, twos, who, none))
    order = np.lexsort((who, np.concatenate(ids).astype(np.int64), none, two, one))
    later = np.zeros(len(one), bool)
    later[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
    ends, rows = np.cumsum(sizes), []
    for block, b, n in zip(group["block"].to_pylist(), ends, sizes, strict=True):
        if later[b - n : b].any():
            rows.append((block, group["tile"][0].as_py(), np.packbits(later[b - n : b]).tobytes()))
    return pa.Table.from_batches([table_of(_BITS, rows)])


def _kept(w: _Windows, removed: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Words removed of each text, and the text of the others, joined by one space."""
    gone = np.zeros(len(w.first) + 1, np.int64)
    gone[w.start[removed]] += 1
    gone[w.start[removed] + w.width] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    per_word = np.concatenate(([0], np.cumsum(keep)))
    stay = np.diff(per_word[w.bounds])
    first, last = w.first[keep], w.last[keep]
    # Each word that stays with the byte before it, which becomes a space.
    edge = np.zeros(len(w.data) + 1, np.int8)
    edge[last] -= 1
    edge[first - 1] += 1
    data = w.data.copy()
    data[first - 1] = 32
    data = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    ends = np.concatenate(([0], np.cumsum(last - first + 1)))[per_word[w.bounds]]
    texts = [data[a + 1 : b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return np.diff(w.bounds) - stay, texts


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, text (the words that stay, joined by one space).

    Words are runs without [\\x20\\x09-\\x0D]. A word goes if it is in a run of ``window`` words of its document that
    also starts earlier: in a document with a smaller id, or before in the same one; this is judged on the texts as they come in.

    Null texts have no words; texts of fewer words than ``window`` stay whole. Rows that share an id
    are documents of their own, and so are rows without one, which come after all others; which of such rows is the earlier
    is the order of their texts where one task reads them, else that of the tasks. Other columns are not read.
    Empty in, empty out. A text is held whole in one task, at some 15 bytes a byte.

    Windows are equal by 128 bits of hash with seeds drawn anew for each run.
    """
    blocks = blocked(docs, id_col, text_col, size=block_bytes)
    tiles, seeds = tiles_of(blocks, tile_bytes), (new_seed(), new_seed())
    tasks = min(tiles, MAX_TASKS)

    def windows(texts: list[bytes]) -> _Windows:
        return _Windows(texts, window, tiles, seeds)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            cells = np.unique(windows(row["texts"]).cell)
            low = (cells & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield table_of(_SKETCH, [(tile, row["block"], low[a:b].tobytes()) for tile, a, b in by_tile(_tile(cells))])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            w = windows(row["texts"])
            c = _Candidates(w, row["answers"])
            base = row["ids"][0]  # the smallest
            with np.errstate(over="ignore"):
                docs = (np.array(row["ids"], np.int64) - np.int64(base)).astype(np.uint64)[w.doc[c.heads]] if base is not None else np.zeros(len(c.heads), np.uint64)
            yield table_of(_EXACT, [(tile, row["block"], base, c.one[a:b].tobytes(), c.two[a:b].tobytes(), packed(docs[a:b])) for tile, a, b in by_tile(c.tile)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each_row(batches):
            w = windows(row["texts"])
            removed = _later_inside(w)
            if row["answers"]:
                c = _Candidates(w, row["answers"])
                removed[c.heads[_marked(c.tile, row["answers"], 1)]] = True
            n, left = _kept(w, removed)
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(np.diff(w.bounds)), pa.array(n), pa.array([t.decode("utf-8", "replace") for t in left], pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    sent = blocks.select("block", "texts").mapInArrow(sketch, "tile int, block long, cells binary")
    hits = scratch.written(sent.repartition(tasks, "tile").groupBy("tile").applyInArrow(_sketch_merged, _BITS_SQL), "repeats-hits")
    sent = with_answers(blocks.select("block", "ids", "texts"), hits).select("block", "ids", "texts", "answers")
    sent = sent.mapInArrow(candidates, "tile int, block long, base long, one binary, two binary, docs binary")
    later = scratch.written(sent.repartition(tasks, "tile").groupBy("tile").applyInArrow(_exact_merged, _BITS_SQL), "repeats-later")
    found = with_answers(blocks.select("block", "ids", "texts"), hits, later, how="left").select("ids", "texts", "answers")
    return found.mapInArrow(cut, "doc_id long, n_words long, n_removed long, text string")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
g AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gone FROM r GROUP BY doc_id),
k AS (
  SELECT w.doc_id, ws, CASE WHEN gone IS NULL THEN ws ELSE list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
  FROM w LEFT JOIN g ON g.doc_id = w.doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(kept) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
