"""Sets of hashed word shingles, many texts at a time in numpy.

Words are maximal runs without [\\x20\\x09-\\x0D], A-Z lower-cased. A set holds the distinct k-word
shingles as sorted 64-bit hashes; with fewer words the whole sequence is the only shingle; a text
without words has the empty set. Two shingles count as equal when their hashes are; hashes are seeded
(see ``words``), and callers draw a seed for each run, so no text can be made to share a hash with another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from reelspark.llm.words import batches, hashes, joined, mix, per_text, pieces, rolled, spans

#: Bytes hashed at once, at some ten bytes a byte; a longer text is hashed in pieces.
CHUNK_BYTES = 1 << 21

_U = np.uint64


def _chunk_sets(texts: list[bytes], k: int, seed: int) -> Iterator[np.ndarray]:
    data = joined(texts, lower=True)
    first, last = spans(data)
    bounds = per_text(texts, first)
    words = hashes(data, first, last, seed)
    del data, first, last
    runs = rolled(words, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(runs[a : b - k + 1])
        else:
            with np.errstate(over="ignore"):
                yield mix(rolled(words[a:b], b - a) + _U(b - a)) if b > a else np.zeros(0, _U)


def _long_set(text: bytes, k: int, seed: int) -> np.ndarray:
    """The set of one long text: each piece is hashed with the last words of the one before."""
    found, held, carry, total = [], 0, np.zeros(0, _U), 0
    for piece in pieces(text, CHUNK_BYTES):
        data = joined([piece], lower=True)
        words = hashes(data, *spans(data), seed)
        total += len(words)
        carry = np.concatenate((carry, words))
        found.append(np.unique(rolled(carry, k)))
        carry = carry[-k + 1 :] if k > 1 else carry[:0]
        held += len(found[-1])
        if held > 2 * len(found[0]) + CHUNK_BYTES:
            found = [np.unique(np.concatenate(found))]
            held = 0
    if 0 < total < k:
        return next(_chunk_sets([b" ".join(text.split())], k, seed))
    return np.unique(np.concatenate([np.zeros(0, _U), *found]))


def shingle_sets(texts: list[bytes], k: int = 5, seed: int = 0) -> Iterator[np.ndarray]:
    """One sorted array of distinct hashes per text, in order."""
    for run in batches(texts, CHUNK_BYTES):
        if len(run[0]) > CHUNK_BYTES:
            yield _long_set(run[0], k, seed)
        else:
            yield from _chunk_sets(run, k, seed)


def set_key(numbers: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed 64-bit numbers."""
    with np.errstate(over="ignore"):
        mixed = mix(numbers + _U(len(numbers)))
        one, two = mixed.sum(dtype=_U), np.bitwise_xor.reduce(mix(mixed * _U(0xD6E8FEB86659FD93))) if len(mixed) else _U(0)
    return int(np.int64(one.astype(np.int64))), int(np.int64(two.astype(np.int64)))
