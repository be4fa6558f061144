"""Words of many texts at once, as numpy arrays over the texts' bytes.

A batch's texts lie one behind another in one byte array. Words are found with a table of word bytes, and
each gets a 64-bit polynomial hash from prefix sums; sequences of words get theirs from the words' hashes the
same way (Rabin-Karp modulo 2**64, then mixed). Two short sequences that are not made to collide agree with
probability 2**-64 or so. There are long ones that agree whatever the base, of two values in the order of Thue and
Morse, from 1,024 values on; sequences of LONG values or more get a cryptographic hash instead. Whole texts are read;
only the number of texts held at once is bounded.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text taken at once (a longer text is taken alone), and bytes hashed at once.
CHUNK_BYTES, BLOCK_BYTES = 1 << 20, 1 << 18

#: Values from which on a sequence is not hashed as a polynomial.
LONG = 256

U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_LENGTH = U(0xA0761D6478BD642F)


def word_bytes(*gaps: tuple[int, int]) -> np.ndarray:
    """Table of the bytes of words: all but those in the gaps (first, last)."""
    table = np.ones(256, dtype=bool)
    for first, last in gaps:
        table[first : last + 1] = False
    return table


#: Words as `[^\x20\x09-\x0D]+`.
NOT_BLANK = word_bytes((0x20, 0x20), (0x09, 0x0D))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words(NamedTuple):
    """Of the texts of a chunk: its rows, bytes, and each word's first byte, end and hash; words of text i
    are first[i] to first[i + 1]."""

    rows: pa.RecordBatch
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def release_memory() -> None:
    """Give freed memory back to the machine; a worker process lives on and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    both = []
    for b in (base, inverse):
        run = np.full(size, b, dtype=U)
        run[0] = 1
        both.append(np.cumprod(run, dtype=U))
    return both[0], both[1]


def _powers_for(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << max(18, int(n).bit_length()))


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span; spans lie in the order of their starts."""
    out = np.empty(len(start), dtype=U)
    at = 0
    while at < len(start):
        origin = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, origin + BLOCK_BYTES, "right")))
        size = int(end[stop - 1]) - origin
        power, inverse = _powers_for(base, size + 1)
        sums = np.zeros(size + 1, dtype=U)
        np.cumsum((values[origin : origin + size].astype(U) + U(1)) * power[:size], out=sums[1:])
        s, e = start[at:stop] - origin, end[at:stop] - origin
        out[at:stop] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U) * _LENGTH)
        at = stop
    for i in np.flatnonzero(end - start >= LONG):
        digest = hashlib.blake2b(values[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def _chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    texts = batch.column(column)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data or b"", dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(i, j - i), whole[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words_of(
    batches: Iterator[pa.RecordBatch], column: str = "text", *, table: np.ndarray = NOT_BLANK, lower: bool = False
) -> Iterator[Words]:
    for batch in batches:
        for rows, data, offsets in _chunks(batch, column):
            if lower:
                data = _LOWER[data]
            inside = np.zeros(len(data) + 1, dtype=bool)
            np.take(table, data, out=inside[:-1])
            starts = inside[:-1].copy()
            starts[1:] &= ~inside[:-2]
            ends = inside[:-1] & ~inside[1:]
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            starts[edges] = inside[edges]
            ends[edges - 1] = inside[edges - 1]
            start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
            first = np.searchsorted(start, offsets)
            yield Words(rows, data, start, end, spans_hash(data, start, end, _BYTE_BASE), first)
        release_memory()


def sequence_hash(words: Words) -> np.ndarray:
    """Hash of each text's whole sequence of words."""
    return spans_hash(words.hash, words.first[:-1], words.first[1:], _WORD_BASE)


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` consecutive words, whichever texts they are of."""
    if len(values) < width:
        return np.empty(0, dtype=U)
    if width <= 8:
        total = values[: len(values) - width + 1].copy()
        for k in range(1, width):
            total = total * U(_WORD_BASE) + values[k : len(values) - width + 1 + k]
        return mix(total)
    power, inverse = _powers_for(_WORD_BASE, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * inverse[: len(values) - width + 1])
