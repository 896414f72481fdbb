"""Words and shingles of whole Arrow columns of text, as 64-bit hashes in numpy.

A word is a run, in the lower-cased text, of ASCII letters and digits and of other
characters outside U+0080 to U+00BF (but with ª, µ, º), ×, ÷, U+2000 to U+206F and
U+3000 to U+303F. ``WORD`` is the same as a pattern. Null counts as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = "[0-9a-zªµºÀ-ÖØ-öø-῿⁰-⿿぀-\U0010ffff]+"
SHINGLE = 5

#: Bytes of text worked on at once; a longer document is a part of its own.
PART = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values; a bijection for every seed."""
    x = x + np.uint64((int(seed) * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the n + 1 offsets of its texts in them."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def _mark(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to words."""
    inside = _IS_WORD[data]
    if len(data) and data.max() >= 0x80:
        follow = np.append(data[1:], np.zeros(2, np.uint8))  # that of a lead byte at its place, the one after it at the next
        lead = {x: np.flatnonzero(data == x) for x in (0xC2, 0xC3, 0xE2, 0xE3)}
        two = np.concatenate((lead[0xC2][~np.isin(follow[lead[0xC2]], (0xAA, 0xB5, 0xBA))], lead[0xC3][np.isin(follow[lead[0xC3]], (0x97, 0xB7))]))
        inside[two] = inside[two + 1] = False
        second, third = follow[lead[0xE2]], follow[lead[0xE2] + 1]
        three = np.concatenate((lead[0xE2][(second == 0x80) | (second == 0x81) & (third <= 0xAF)], lead[0xE3][follow[lead[0xE3]] == 0x80]))
        for i in range(3):
            inside[three + i] = False
    return inside


def _polynomials(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, from running sums modulo 2**64."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        first = start[i]
        j = max(i + 1, int(np.searchsorted(end, first + PART, "right")))
        size = int(end[j - 1] - first)
        if not _POWERS or len(_POWERS[0]) < size:
            n = max(size, PART)
            _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, b, np.uint64)))) for b in (_BASE, _UNBASE)]
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[first : first + size].astype(np.uint64) + np.uint64(1)) * _POWERS[0][:size], out=total[1:])
        s, e = start[i:j] - first, end[i:j] - first
        out[i:j] = (total[e] - total[s]) * _POWERS[1][s] + (e - s).astype(np.uint64)
        i = j
    return out


class Words:
    """Words of some texts: ``hashes``, byte ``start`` and ``end`` in the lower-cased
    text, and ``first``: the number of each text's first word (n + 1 values)."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = buffers(pc.utf8_lower(texts))
        inside = _mark(self.data)
        before = np.concatenate(([False], inside[:-1]))
        heads = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        before[heads] = False
        after = np.append(inside[1:], False)
        tails = self.offsets[1:][self.offsets[1:] > 0] - 1
        after[tails] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.hashes = mix(_polynomials(self.data, self.start, self.end))

    def shingles(self, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of ``width`` words and the number of each text's first one.

        A text with fewer words, but some, has one shingle of all of them.
        """
        count = np.diff(self.first)
        each = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        first = np.concatenate(([0], np.cumsum(each)))
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], each)
        padded = np.concatenate((self.hashes, np.zeros(width, np.uint64)))
        rolled = np.zeros(len(self.hashes) + 1, np.uint64)
        for j in range(width):
            rolled *= _BASE
            rolled += padded[j : j + len(rolled)]
        out = rolled[at]
        for i in np.flatnonzero((count > 0) & (count < width)):
            value = 0
            for j in range(width):
                value = value * int(_BASE) + (int(self.hashes[self.first[i] + j]) if j < count[i] else 0)
            out[first[i]] = np.uint64(value % (1 << 64))
        return mix(out, 1), first

    def fingerprints(self) -> np.ndarray:
        """One 64-bit value for each text's sequence of words."""
        return sequence_hash(self.hashes, self.first)


def sequence_hash(values: np.ndarray, first: np.ndarray, seed: int = 2) -> np.ndarray:
    """Order-dependent hash of each run of values."""
    place = np.arange(len(values)) - np.repeat(first[:-1], np.diff(first))
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(values + mix(place.astype(np.uint64), seed), seed + 1))))
    return mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64), seed)


def parts(batch: pa.RecordBatch, *columns: str, size: int = PART) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes each in its columns of text."""
    offsets = sum(buffers(batch.column(c))[1] for c in columns or ("text",))
    i, n = 0, batch.num_rows
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1))
        yield batch.slice(i, j - i)
        i = j
