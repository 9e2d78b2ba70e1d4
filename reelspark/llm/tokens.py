"""Token ids and counts by a public tokenizer, from a table of the parts that texts are made of.

In a text of printable ASCII, white space and Latin-1 letters the pre-tokens are certain: lower
case changes letters one by one, nothing composes, and one pattern cuts the text as the library
does. Any other text is cut at ASCII white space, which no pre-token, special string or composed
character spans, and where a run of it is not certain either, the run as a whole is the part. A text's
tokens are its parts' tokens in order (tests compare whole texts with the library). Parts repeat,
so each worker keeps a bounded table of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
#: Parts kept by a worker, and the longest one kept, in bytes: about 70 MB at most.
TABLE_PARTS, TABLE_BYTES = 400_000, 48
#: Bytes of text handled at once, and parts given to the library in one string.
CHUNK_BYTES, TOGETHER = 2 << 20, 256

#: Pre-tokens of lower-case text whose other bytes are those of Latin-1 letters: fixed values of the vocabulary's pre-tokenizer.
_PRE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xff]+|[0-9]|[!-/:-@\[-`{-~]+")
_LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")
_LATIN = re.compile(rb"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")
_PLAIN_BYTES = bytes([*range(9, 14), *range(32, 127)])
_PLAIN = re.compile(rb"[\x21-\x7e]+\Z")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(path: str) -> frozenset[bytes]:
    """The vocabulary's plain words that the library itself encodes, alone, as exactly one token.

    Run once, on the driver: every vocabulary string that ends a word is encoded, and only what
    comes back as its own single id is kept. Bounded by the vocabulary.
    """
    tokenizer = load(path)
    words = [(w.removesuffix("</w>"), i) for w, i in tokenizer.get_vocab(False).items() if w.endswith("</w>")]
    found = tokenizer.encode_batch([w for w, _ in words], add_special_tokens=False)
    # A word that the pre-tokenizer would split is no pre-token, even where its parts merge into one id.
    return frozenset(w.encode() for (w, i), e in zip(words, found, strict=True) if e.ids == [i] and _PLAIN.match(w.encode()) and _PRE.fullmatch(w.encode()))


class _Parts:
    """What a text's parts give; ``_made`` makes it by the library, once for a part that the table keeps."""

    def __init__(self, path: str):
        self.tokenizer, self.table = load(path), {}
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def _certain(self, data: bytes) -> bytes | None:
        """The text in lower case if its pre-tokens are certain."""
        other = data.translate(None, _PLAIN_BYTES)
        if not _LATIN.fullmatch(other) or any(s in data for s in self.special):
            return None
        return data.decode().lower().encode() if other else data.lower()

    def split(self, data: bytes) -> list[bytes]:
        if (low := self._certain(data)) is not None:
            return _PRE.findall(low)
        parts: list[bytes] = []
        for unit in data.split():
            low = self._certain(unit)
            parts += [unit] if low is None else _PRE.findall(low)
        return parts

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """The library's ids of each part, four bytes each. Certain words go in together, with spaces between."""
        out: list = [None] * len(parts)
        words = [k for k, p in enumerate(parts) if _LETTERS.fullmatch(p) and _LATIN.fullmatch(p.translate(None, _PLAIN_BYTES))]
        groups = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for group in groups:
            e = self.tokenizer.encode_batch_fast([b" ".join([parts[k] for k in group]).decode()], add_special_tokens=False)[0]
            ids = np.asarray(e.ids, "<u4")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()  # a pre-token's last id, and no other, ends a word
            if len(cuts) == len(group):
                data, at = ids.tobytes(), 0
                for k, cut in zip(group, cuts, strict=True):
                    out[k] = data[at:cut]
                    at = cut
        for k, own in enumerate(out):
            if own is None:
                out[k] = np.asarray(self.tokenizer.encode(parts[k].decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        return out

    def of_texts(self, texts: list[bytes]) -> Iterator[Iterator]:
        """For each text, what its parts give; a chunk of texts looks up what is new to it together."""
        if len(self.table) > TABLE_PARTS:
            self.table.clear()
        split = list(map(self.split, texts))
        new = list(set().union(*split).difference(self.table))
        self.table.update(zip(new, self._made(new), strict=True))
        for parts in split:
            yield map(self.table.__getitem__, parts)
        for p in new:
            if len(p) > TABLE_BYTES:
                del self.table[p]


def chunks(texts: pa.Array | list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about CHUNK_BYTES together, null as empty; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        t = (t.as_py() if isinstance(t, pa.Scalar) else t) or b""
        if run and size + len(t) > CHUNK_BYTES:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


class TokenCounter(_Parts):
    """Token counts: pre-tokens proven whole count one each, only the rest is merged by the library."""

    def __init__(self, path: str, whole: frozenset[bytes]):
        super().__init__(path)
        self.whole = whole

    def _made(self, parts: list[bytes]) -> list[int]:
        rest = [p for p in parts if p not in self.whole]
        merged = {p: len(ids) // 4 for p, ids in zip(rest, self._ids(rest), strict=True)}
        return [merged.get(p, 1) for p in parts]

    def counts(self, texts: pa.Array | list[bytes]) -> list[int]:
        return [sum(got) for chunk in chunks(texts) for got in self.of_texts(chunk)]


class TokenEncoder(_Parts):
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def _made(self, parts: list[bytes]) -> list[bytes]:
        return self._ids(parts)

    def ids(self, texts: pa.Array | list[bytes]) -> Iterator[bytes]:
        for chunk in chunks(texts):
            for got in self.of_texts(chunk):
                yield b"".join(got)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    Counts are the library's for the whole text, without added special tokens; special strings in
    a text count as the library takes them. Null and empty texts have 0 bytes and tokens; null ids
    and repeated rows are kept; other columns are not read. Narrow: no shuffle, one Arrow batch at
    a time. Empty in, empty out.
    """
    path = vocabulary or vocabulary_path()
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path, whole.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            tokens = counter.counts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("data"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
