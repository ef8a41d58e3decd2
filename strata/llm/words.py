"""Words and their hashes for whole batches of texts, in numpy.

A chunk of texts is one byte array.  Words are its maximal runs of bytes other than
ASCII white space, so UTF-8 needs no decoding.  Hashes of words and of windows of words
come from running sums of ``value * base**position`` modulo 2**64: the sum over a range,
divided by ``base**start``, depends on the range's content only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Odd bases of the two independent hashes, for bytes and for words.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WORD_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE_VALUES = [mix(np.arange(1, 257, dtype=_U) * _U(b)) for b in BYTE_BASES]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES // 4), base, _U)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=_U)
    return have[:n]


@lru_cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _ranges(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * _power(base, len(values)), out=total[1:])
    return (total[ends] - total[starts]) * _power(_inverse(base), len(values) + 1)[starts]


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of each range of bytes."""
    return mix(_ranges(_BYTE_VALUES[which][data], BYTE_BASES[which], starts, ends))


class Words:
    """The words of some texts: ``first[d] .. first[d + 1]`` are those of text ``d``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, offsets = text_bytes(texts)
        if lower:
            data = _LOWER[data]
        self.data = data
        n = len(data)
        word = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins, ends = word.copy(), word
        if n:
            begins[1:] &= ~word[:-1] | edge[1:n]
            ends = word.copy()
            ends[:-1] &= ~word[1:] | edge[1:n]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends, which)

    def fits(self, length: int) -> np.ndarray:
        """Whether ``length`` words from each word on are of one text."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return left >= length


def windows(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """The hash of the ``length`` words that start at each word; zero at the end of the array."""
    out = np.zeros(len(hashes), _U)
    n = len(hashes) - length + 1
    if n > 0:
        at = np.arange(n)
        out[:n] = mix(_ranges(hashes, WORD_BASES[which], at, at + length))
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts together and where each begins; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at, n = 0, batch.num_rows
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), n)
            yield batch.slice(at, end - at)
            at = end


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def ragged(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of an array of lists and where each list begins; a null list is empty."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    first = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(sizes, out=first[1:])
    return np.asarray(lists.flatten()), first
