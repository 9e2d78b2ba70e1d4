"""Collocations: phrases whose words keep company, from suffix arrays of word ids.

1. *Shards*: texts become sequences of word ids, of some megabytes each, with a break between pieces.
2. *Counts*: a shard's suffix array comes from prefix doubling of word ranks to four words. Runs of
   suffixes with a common prefix of n words (LCP intervals) are its phrases of n words with their
   counts. Sorted keys and counts go, cut into tiles by hash, to be added up over all shards; each shard
   learns which of its phrases reach the threshold, and their counts in all.
3. A phrase is no more frequent than its parts. So words are counted first and infrequent ones become breaks, then pairs of
   words, then phrases of three and four whose pairs are all frequent; the rest never leaves its shard.
4. A shard that holds a phrase also holds its parts, and knows their counts. One shard of those
   that hold a phrase scores it and tells which of its parts it makes superfluous.

Keys are 96 bits of hash with seeds drawn anew for each run; a language is part of the key. They do not compress, so
no table of shards holds them: each step hashes a shard's distinct words again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.blocks import MAX_TASKS, by_tile, each_row, packed, table_of, unpacked, with_answers
from reelspark.llm.words import follow, hashes, joined, mix, new_seed, per_text, spans

LEAST, LONGEST, COVERED, TOP = 30, 4, 80, 2000
#: Bytes of text in a shard, and words in all per tile.
SHARD_BYTES, TILE_WORDS = 1 << 21, 1 << 20
#: Salts that a language's phrases are ranked in first.
SALTS = 64

#: Bytes that go to Python at once; a usual shard is more, so it goes alone. Its tables have a row group for each shard.
BATCH = "1m"

_U = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_IN_WORD = ~_BREAK
_IN_WORD[[9, 32]] = False

_SHARD = {"block": pa.int64(), "langs": pa.list_(pa.string()), "lang_words": pa.list_(pa.int64()), "seq": pa.binary(), "vocabulary": pa.binary(), "lang_of": pa.binary(), "n": pa.binary()}
_SHARD_SQL = "block long, langs array<string>, lang_words array<long>, seq binary, vocabulary binary, lang_of binary, n binary"
_COMPACT = {"block": pa.int64(), "langs": pa.list_(pa.string()), "seq": pa.binary(), "vocabulary": pa.binary(), "lang_of": pa.binary(), "totals": pa.binary()}
_COMPACT_SQL = "block long, langs array<string>, seq binary, vocabulary binary, lang_of binary, totals binary"
_SENT = {"tile": pa.int32(), "block": pa.int64(), "one": pa.binary(), "two": pa.binary(), "n": pa.binary()}
_SENT_SQL = "tile int, block long, one binary, two binary, n binary"
_ANSWER = {"block": pa.int64(), "tile": pa.int32(), "frequent": pa.binary(), "own": pa.binary(), "totals": pa.binary()}
_ANSWER_SQL = "block long, tile int, frequent binary, own binary, totals binary"
_PHRASES = {"lang": pa.string(), "phrase": pa.string(), "a": pa.int64(), "l": pa.int64(), "r": pa.int64(), "score": pa.int64(), "dropped": pa.bool_()}
_PHRASES_SQL = "lang string, phrase string, a long, l long, r long, score long, dropped boolean"


def encoded(texts: list[bytes], langs: list[str], seeds: tuple[int, int]) -> dict:
    """A shard: its words as ids from 1 in ``seq``, 0 between pieces, and of each id the word, language and count; ids rise with the first key."""
    data = joined(texts, lower=True)
    first, last = spans(data, _IN_WORD)
    names = sorted(set(langs))
    lang_of_text = np.searchsorted(names, langs)
    lang = np.repeat(lang_of_text, np.diff(per_text(texts, first)))
    key = hashes(data, first, last, seeds[0]) ^ _names(names, seeds[0])[lang]
    _, at, ids, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    piece = np.searchsorted(np.flatnonzero(_BREAK[data]), first)
    new = np.concatenate(([True], piece[1:] != piece[:-1])) if len(piece) else np.zeros(0, bool)
    seq = np.zeros(len(ids) + int(new.sum()), np.int32)
    seq[np.arange(len(ids)) + np.cumsum(new)] = ids + 1
    words = [data[a:b].tobytes() for a, b in zip(first[at].tolist(), last[at].tolist(), strict=True)]
    return {
        "langs": names, "lang_words": np.bincount(lang, minlength=len(names)).tolist(), "seq": _planes(seq), "vocabulary": b" ".join(words),
        "lang_of": lang[at].astype(np.int32).tobytes(), "n": n.astype(np.int64).tobytes(),
    }


def _word_keys(row: dict, seeds: tuple[int, int]) -> list[np.ndarray]:
    """Both keys of each word of a shard's vocabulary."""
    data = joined([row["vocabulary"]])
    first, last = spans(data, _IN_WORD)
    lang_of = np.frombuffer(row["lang_of"], np.int32)
    return [hashes(data, first, last, seed) ^ _names(row["langs"], seed)[lang_of] for seed in seeds]


def _names(names: list[str], seed: int) -> np.ndarray:
    """A key for each language, whatever is in its name."""
    out = np.zeros(len(names), _U)
    with np.errstate(over="ignore"):
        for k, name in enumerate(names):
            raw = name.encode()
            lanes = np.frombuffer(raw + bytes(-len(raw) % 8), "<u8")
            key = mix(np.array([len(raw)], _U) + _U(seed))
            for lane in lanes:
                key = follow(key, mix(np.array([lane], _U)))
            out[k] = key[0]
    return out


class Suffixes:
    """The suffixes of ``seq`` in order of their first four words, by prefix doubling of ranks."""

    def __init__(self, seq: np.ndarray):
        self.seq = np.concatenate((seq, np.zeros(LONGEST, seq.dtype))).astype(np.int64)
        self.size = len(seq)
        self.ranks = {1: self.seq[: self.size]}
        for width in (1, 2):
            rank = self.ranks[width]
            ahead = np.concatenate((rank[width:], np.zeros(min(width, self.size), np.int64)))
            self.ranks[2 * width] = np.unique(rank * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1]
        self.order = np.argsort(self.ranks[4], kind="stable")
        # The gap in ranks past the end stands for a break: no phrase reaches over it.

    def phrases(self, n: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """LCP intervals of ``n`` words: a place and the count of each, and for every place that ``allowed`` has the number of its interval, else -1."""
        order = self.order[allowed[self.order]]
        if n == 3:
            rank, third = self.ranks[2][order], self.seq[order + 2]
            new = np.concatenate(([True], (rank[1:] != rank[:-1]) | (third[1:] != third[:-1])))[: len(order)]
        else:
            rank = self.ranks[n][order]
            new = np.concatenate(([True], rank[1:] != rank[:-1]))[: len(order)]
        starts = np.flatnonzero(new)
        number = np.full(self.size, -1)
        number[order] = np.cumsum(new) - 1
        return order[starts], np.diff(np.concatenate((starts, [len(order)]))), number


def _keys(seq: np.ndarray, at: np.ndarray, n: int, word: np.ndarray) -> np.ndarray:
    """One of the two keys of the phrases of ``n`` words at places ``at``."""
    key = word[seq[at] - 1]
    with np.errstate(over="ignore"):
        for j in range(1, n):
            key = follow(key, word[seq[at + j] - 1])
        return mix(key + _U(n))


def _planes(ids: np.ndarray) -> bytes:
    """Numbers below 2^32 with all their first bytes before all their second ones and so on, as compression likes them."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int32)


def _order(one: np.ndarray, two: np.ndarray, tiles: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that keys are sent in, and the tiles in that order."""
    tile = (one >> _U(32)) % _U(tiles)
    order = np.lexsort((two, one, tile))
    return order, tile[order].astype(np.int64)


def _rows(shard: int, tiles: int, one: np.ndarray, two: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    order, tile = _order(one, two, tiles)
    one, two, n = one[order], two[order].astype(np.uint32), n[order]
    return table_of(_SENT, [(t, shard, one[a:b].tobytes(), two[a:b].tobytes(), packed(n[a:b])) for t, a, b in by_tile(tile)])


def _told(answers: list[dict], kind: int, tiles: int, one: np.ndarray, two: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts in all of what was sent (0 where below the threshold), and whether this shard is to score it."""
    order, tile = _order(one, two, tiles)
    by = {a["tile"]: a for a in answers or () if a["kind"] == kind}
    totals, own = np.zeros(len(one), np.int64), np.zeros(len(one), bool)
    for t, a, b in by_tile(tile):
        if t in by:
            frequent, mine = (np.unpackbits(np.frombuffer(by[t][c], np.uint8), count=b - a).astype(bool) for c in ("frequent", "own"))
            totals[order[a:b][frequent]] = unpacked(by[t]["totals"], int(frequent.sum()))
            own[order[a:b]] = mine
    return totals, own


def _words(row: dict, seeds: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    every = np.arange(len(row["n"]) // 8)
    one, two = (_keys(every + 1, every, 1, word) for word in _word_keys(row, seeds))
    return one, two, np.frombuffer(row["n"], np.int64)


def _compacted(row: dict, tiles: int, seeds: tuple[int, int]) -> tuple:
    """A row of ``_COMPACT``: the shard with only its frequent words, the most frequent first; others are breaks, and runs of breaks one."""
    totals = _told(row["answers"], 0, tiles, *_words(row, seeds))[0]
    keep = np.argsort(-totals, kind="stable")[: int((totals > 0).sum())]
    renamed = np.zeros(len(totals) + 1, np.int32)
    renamed[keep + 1] = np.arange(1, len(keep) + 1)
    seq = renamed[_unplaned(row["seq"])]
    seq = seq[(seq > 0) | np.concatenate(([False], seq[:-1] > 0))] if len(seq) else seq
    words = row["vocabulary"].split(b" ")
    lang_of = np.frombuffer(row["lang_of"], np.int32)[keep]
    return row["block"], row["langs"], _planes(seq), b" ".join([words[i] for i in keep]), lang_of.tobytes(), totals[keep].tobytes()


class _Shard:
    """A compacted shard as far as answers tell its frequent phrases; each level is worked out from the answers to the one before."""

    def __init__(self, row: dict, tiles: int, seeds: tuple[int, int]):
        self.row, self.tiles, self.answers = row, tiles, row.get("answers")
        self.one, self.two = _word_keys(row, seeds)
        self.suffixes = Suffixes(_unplaned(row["seq"]))
        self.seq, size = self.suffixes.seq, self.suffixes.size
        self.total = {1: np.concatenate(([0], np.frombuffer(row["totals"], np.int64)))[self.seq]}
        self.allowed = {2: (self.seq[:size] > 0) & (self.seq[1 : size + 1] > 0)}

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.at, count, self.number = self.suffixes.phrases(2, self.allowed[2])
        return _keys(self.seq, self.at, 2, self.one), _keys(self.seq, self.at, 2, self.two), count

    def know_pairs(self) -> None:
        sent = self.pairs()
        totals, self.own2 = _told(self.answers, 0, self.tiles, *sent)
        self.at2, size = self.at, self.suffixes.size
        self.total[2] = self._by_place(totals, self.number)
        pair = self.total[2] > 0
        self.allowed[3] = pair[:size] & pair[1 : size + 1]
        self.allowed[4] = self.allowed[3] & pair[2 : size + 2]

    def _by_place(self, totals: np.ndarray, number: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.seq), np.int64)
        out[: self.suffixes.size] = np.concatenate((totals, [0]))[number]
        return out

    def longer(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.at3, count3, self.number3 = self.suffixes.phrases(3, self.allowed[3])
        self.at4, count4, self.number4 = self.suffixes.phrases(4, self.allowed[4])
        keys = (np.concatenate((_keys(self.seq, self.at3, 3, w), _keys(self.seq, self.at4, 4, w))) for w in (self.one, self.two))
        return *keys, np.concatenate((count3, count4))

    def scored(self) -> pa.RecordBatch:
        """Rows of ``_PHRASES``: the phrases that this shard is to score, and parts that they make superfluous."""
        sent = self.longer()
        totals, own = _told(self.answers, 1, self.tiles, *sent)
        three = len(self.at3)
        self.total[3], self.total[4] = self._by_place(totals[:three], self.number3), self._by_place(totals[three:], self.number4)
        words, langs = self.row["vocabulary"].split(b" "), self.row["langs"]
        lang_of = np.frombuffer(self.row["lang_of"], np.int32)
        t, out = self.total, {c: [] for c in _PHRASES}

        def add(at: np.ndarray, n: int, **values) -> None:
            for p in at.tolist():
                ids = self.seq[p : p + n] - 1
                out["lang"].append(langs[lang_of[ids[0]]])
                out["phrase"].append(b" ".join([words[i] for i in ids]).decode())
            for c in ("a", "l", "r", "score"):
                out[c] += values[c].tolist() if c in values else [None] * len(at)
            out["dropped"] += ["a" not in values] * len(at)

        for n, at in ((2, self.at2[self.own2]), (3, self.at3[own[:three]]), (4, self.at4[own[three:]])):
            a = t[n][at]
            left, right = np.stack([t[k][at] for k in range(1, n)]), np.stack([t[n - k][at + k] for k in range(1, n)])
            score = scores(a, left + right)
            cut = score.argmin(axis=0)  # the first of equals
            column = np.arange(len(at))
            add(at, n, a=a, l=left[cut, column], r=right[cut, column], score=score[cut, column])
            for m in range(2, n):
                for shift in range(n - m + 1):
                    add(at[100 * a >= COVERED * t[m][at + shift]] + shift, m)
        return pa.RecordBatch.from_arrays([pa.array(out[c], kind) for c, kind in _PHRASES.items()], list(_PHRASES))


def scores(a: np.ndarray, both: np.ndarray) -> np.ndarray:
    """floor(2000000 * a / both) in two steps, so that no product passes 64 bits for counts below 2^52."""
    thousands, rest = np.divmod(2000 * a, both)
    return 1000 * thousands + 1000 * rest // both


def _added(least: int):
    """Counts over all shards of the keys in a tile; to each shard those that reach ``least``, and which of them it is to score."""

    def add(group: pa.Table) -> pa.Table:
        shards = group["block"].to_pylist()
        one, two = (np.concatenate([np.frombuffer(x, kind) for x in group[c].to_pylist()]) for c, kind in (("one", _U), ("two", np.uint32)))
        sizes = [len(x) // 8 for x in group["one"].to_pylist()]
        n = np.concatenate([unpacked(x, size) for x, size in zip(group["n"].to_pylist(), sizes, strict=True)])
        order = np.lexsort((np.repeat(shards, sizes), two, one))
        new = np.concatenate(([True], (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])))
        starts = np.flatnonzero(new)
        totals, held = np.add.reduceat(n[order], starts), np.diff(np.concatenate((starts, [len(n)])))
        owner = order[starts + (one[order[starts]] % held.astype(_U)).astype(np.int64)]
        total, own = np.zeros(len(n), np.int64), np.zeros(len(n), bool)
        total[order] = np.repeat(np.where(totals >= least, totals, 0), held)
        own[owner] = total[owner] > 0
        rows, end = [], 0
        for shard, size in zip(shards, sizes, strict=True):
            mine = slice(end, end + size)
            end += size
            frequent = total[mine] > 0
            if frequent.any():
                rows.append((shard, group["tile"][0].as_py(), np.packbits(frequent).tobytes(), np.packbits(own[mine]).tobytes(), packed(total[mine][frequent])))
        return pa.Table.from_batches([table_of(_ANSWER, rows)])

    return add


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, shard_bytes: int = SHARD_BYTES, tile_words: int = TILE_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two to four words.

    A-Z are lower-cased; texts are split at [.,;:!?\\x0A-\\x0D] into pieces, these at spaces and tabs into
    words. f counts all occurrences within pieces, overlaps included, n all words of the language. A phrase with
    f >= ``least`` is a candidate. Cut after k words its score is floor(2000000 f / (f(left) + f(right)));
    the lowest cut counts, of equals the first. A candidate inside a longer one that is at least 80 % as
    frequent is dropped. Order: score, then a, both falling, then the phrase by its bytes.

    A null language is ``und``; null and empty texts have no words; repeated rows count each. Other columns are
    not read. Languages without candidates have no rows; empty in, empty out. A text is in one shard, so it
    is held whole in one task, at some 30 bytes a byte.
    """
    spark, seeds = docs.sparkSession, (new_seed(), new_seed())
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        texts, langs, held = [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal number
            number += 1
            return table_of(_SHARD, [(number, *encoded(texts, langs, seeds).values())])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if texts and held + len(text) > shard_bytes:
                    yield closed()
                    texts, langs, held = [], [], 0
                texts.append(text)
                langs.append(lang)
                held += len(text)
        if texts:
            yield closed()

    table = scratch.written(rows.mapInArrow(shards, _SHARD_SQL), "phrase-shards", None, BATCH, 1)
    sizes = table.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.lang_words").alias("n"))
    sizes = scratch.written(sizes, "phrase-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    tiles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // tile_words))
    tasks = min(tiles, MAX_TASKS)

    def each(work):
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in each_row(batches):
                yield work(row)

        return over

    def send_words(row: dict) -> pa.RecordBatch:
        return _rows(row["block"], tiles, *_words(row, seeds))

    def send_pairs(row: dict) -> pa.RecordBatch:
        return _rows(row["block"], tiles, *_Shard(row, tiles, seeds).pairs())

    def send_longer(row: dict) -> pa.RecordBatch:
        shard = _Shard(row, tiles, seeds)
        shard.know_pairs()
        return _rows(row["block"], tiles, *shard.longer())

    def score(row: dict) -> pa.RecordBatch:
        shard = _Shard(row, tiles, seeds)
        shard.know_pairs()
        return shard.scored()

    def counted(rows: DataFrame, send, name: str) -> DataFrame:
        sent = rows.mapInArrow(each(send), _SENT_SQL)
        return scratch.written(sent.repartition(tasks, "tile").groupBy("tile").applyInArrow(_added(least), _ANSWER_SQL), name, None, BATCH)

    words = counted(table.select("block", "langs", "vocabulary", "lang_of", "n"), send_words, "phrase-words")
    compact = with_answers(table.drop("lang_words"), words).mapInArrow(each(lambda row: table_of(_COMPACT, [_compacted(row, tiles, seeds)])), _COMPACT_SQL)
    compact = scratch.written(compact, "phrase-compact", None, BATCH, 1)
    scratch.removed(table, words)
    pairs = counted(compact, send_pairs, "phrase-pairs")
    longer = counted(with_answers(compact, pairs), send_longer, "phrase-longer")
    found = scratch.written(with_answers(compact, pairs, longer).mapInArrow(each(score), _PHRASES_SQL), "phrase-found", None, BATCH)
    scratch.removed(compact, pairs, longer)
    best = found.groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in ("a", "l", "r", "score")], F.bool_or("dropped").alias("dropped")).filter("NOT dropped").drop("dropped")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t
  FROM documents),
w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[i:i+k-1], ' ') AS t
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) v(k) WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, k, t, lang || chr(10) || t AS id, count(*) AS c FROM g GROUP BY lang, k, t),
n AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang),
a AS MATERIALIZED (SELECT lang, k, t, c, string_split(t, ' ') AS ws FROM f WHERE k > 1 AND c >= 30),
cuts AS (SELECT lang, k, t, c, ws, unnest(range(1, k)) AS j FROM a),
s AS (
  SELECT cuts.lang, cuts.k, cuts.t, cuts.c, j, x.c AS l, y.c AS r, CAST(CAST(2000000 AS HUGEINT) * cuts.c // (x.c + y.c) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.id = cuts.lang || chr(10) || array_to_string(ws[1:j], ' ')
            JOIN f y ON y.id = cuts.lang || chr(10) || array_to_string(ws[j+1:], ' ')),
b AS MATERIALIZED (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, t ORDER BY score, j) = 1),
parts AS (
  SELECT lang, c, array_to_string(ws[i:i+m-1], ' ') AS t
  FROM (SELECT lang, c, ws, k, m, unnest(range(1, k - m + 2)) AS i FROM a, (VALUES (2), (3)) v(m) WHERE m < k)),
d AS (SELECT DISTINCT b.lang, b.t FROM b JOIN parts ON parts.lang = b.lang AND parts.t = b.t AND 100 * parts.c >= 80 * b.c),
o AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, c DESC, encode(b.t)) AS rank, b.t AS phrase, c AS a, l, r, score
  FROM b ANTI JOIN d ON d.lang = b.lang AND d.t = b.t)
SELECT o.lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""
