"""Words of many texts at once in numpy, named by seeded 64-bit hashes.

White space is [\\x20\\x09-\\x0D]. A word is read in lanes of eight bytes; the sum of the mixed lanes
and the mixed length is its hash, so words of up to eight bytes and of one length never collide, and
no pair of longer words can be made to without the seed. Seeds are drawn anew for every run.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_STEP, _ODD = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)
#: Of the last eight bytes of a word, those that are its own, by their number.
_OWN = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)
#: Lanes mixed at once.
_LANES = 1 << 17


def new_seed() -> int:
    return int.from_bytes(os.urandom(8), "little")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def joined(texts: list[bytes], lower: bool = False) -> np.ndarray:
    """The bytes of ``texts``, a newline before each and nine bytes after the last, so that no word spans two."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n" * 9, np.uint8)
    return _LOWER[data] if lower else data


def spans(data: np.ndarray, in_word: np.ndarray = _IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word; ``in_word``: which of the 256 bytes words are made of."""
    in_word = in_word[data]
    edges = np.flatnonzero(in_word[1:] != in_word[:-1]) + 1
    return edges[::2], edges[1::2]


def per_text(texts: list[bytes], first: np.ndarray) -> np.ndarray:
    """Where the words of each text begin among all, and the number of all."""
    ends = np.cumsum([len(t) + 1 for t in texts]) + 1
    return np.concatenate(([0], np.searchsorted(first, ends)))


def hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """The hash of each word."""
    out = np.empty(len(first), _U)
    if not len(first):
        return out
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    start = _U(seed)
    with np.errstate(over="ignore"):
        length = last - first
        lanes = (length + 7) >> 3
        ends = np.cumsum(lanes)
        a = 0
        while a < len(first):  # words are taken in runs of about _LANES lanes
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + _LANES)))
            n = lanes[a:b]
            begins = ends[a:b] - n - done
            if n.max() == 1:
                value = mix((eight[first[a:b]] & _OWN[length[a:b]]) + start)
            else:
                place = np.arange(int(n.sum())) - np.repeat(begins, n)
                left = np.minimum(np.repeat(length[a:b], n) - 8 * place, 8)
                lane = eight[np.repeat(first[a:b], n) + 8 * place] & _OWN[left]
                value = np.add.reduceat(mix(lane + start + place.astype(_U) * _STEP), begins)
            out[a:b] = mix(value + length[a:b].astype(_U) * _ODD)
            a = b
    return out


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of ``k`` words, from those of its halves."""
    with np.errstate(over="ignore"):
        out, size = None, 0
        power, width = words, 1
        while True:
            if k & width:
                out, size = (power, width) if out is None else (_pair(out, power, size), size + width)
            if width * 2 > k:
                return out[: max(0, len(words) - k + 1)]
            power, width = _pair(power, power, width), width * 2


def _pair(a: np.ndarray, b: np.ndarray, offset: int) -> np.ndarray:
    """Hashes of runs that go on with the run of ``b`` that begins ``offset`` words later."""
    n = max(0, min(len(a), len(b) - offset))
    return follow(a[:n], b[offset : offset + n])


def follow(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hashes of sequences that hash to ``a`` and then to ``b``."""
    return mix(a + _STEP) * _ODD + b


def batches(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    """``texts`` in runs of about ``size`` bytes; a longer text is alone."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t) > size:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run


def pieces(text: bytes, size: int, in_word: np.ndarray = _IN_WORD) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes that end between words; a longer word is a piece of its own."""
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(data):
        end = min(at + size, len(data))
        if end < len(data):
            gaps = np.flatnonzero(~in_word[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < len(data) and not len(gaps := np.flatnonzero(~in_word[data[end : end + size]])):
                    end = min(end + size, len(data))
                end += int(gaps[0]) + 1 if end < len(data) else 0
        yield text[at:end]
        at = end
