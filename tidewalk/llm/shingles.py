"""Word shingles of whole texts as sorted 64-bit hashes, computed on Arrow string buffers.

The kernel works on the UTF-8 bytes of a chunk of documents at once: a word is a
maximal run of bytes outside the separator set, its hash a rolling polynomial over
the bytes (taken as a difference of prefix sums), and a shingle's hash a mix of its
words' hashes.  Nothing here is per row; memory is bounded by ``CHUNK_BYTES`` or one
document, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _inverse(odd: int) -> int:
    """Inverse of an odd number modulo 2**64 (Newton's iteration)."""
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) & _MASK
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base, of its inverse, and the byte values; grown on demand."""

    def __init__(self) -> None:
        self.n = 0
        rng = np.random.Generator(np.random.PCG64(20240229))
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.exact = self.byte.copy()
        upper = np.arange(65, 91)
        self.byte[upper] = self.byte[upper + 32]  # A-Z count as a-z
        self.space = np.zeros(256, dtype=bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, CHUNK_BYTES + 1)
            self.up, self.down = _powers(_BASE, self.n), _powers(_inverse(_BASE), self.n)
        return self.up, self.down


_T = _Tables()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that nearby values become unrelated ones."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Words:
    """Words of a chunk of documents: where each starts and stops, its document, and its hash."""

    starts: np.ndarray
    stops: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    sums: np.ndarray  # prefix sums of the rolling hash, for other spans


def span_hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, from the chunk's prefix sums."""
    _, down = _T.upto(len(sums))
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def find_words(data: np.ndarray, ends: np.ndarray, fold: bool = True) -> Words:
    """All words; ``ends`` are the documents' byte ends in ``data``; with ``fold`` A-Z count as a-z in the hashes."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(1, np.uint64))
    inside = ~_T.space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = ends[(ends > 0) & (ends < n)]  # a word never spans two documents
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    stops = np.flatnonzero(last) + 1
    up, _ = _T.upto(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_T.byte if fold else _T.exact)[data] * up[:n], out=sums[1:])
    return Words(starts, stops, np.searchsorted(ends, starts, side="right"), span_hashes(sums, starts, stops), sums)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document index of every word."""
    words = find_words(data, ends)
    return words.hash, words.doc


def chunks(text: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, ends within them) of pieces of a string array; null counts as empty."""
    text = text.cast(pa.large_string())
    if text.null_count:
        text = text.fill_null("")
    if len(text) == 0:
        return
    _, offs, buf = text.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(text):
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), len(text))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i]
        i = j


def sort_each(values: np.ndarray, starts: np.ndarray) -> None:
    """Sort each document's run in place."""
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a > 1:
            values[a:b].sort()


def sums_each(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each document's run modulo 2**64; 0 for an empty one."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def shingle_sets(text: pa.Array, words: int = 3) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Distinct shingles of each document, chunk by chunk.

    Yields (first row, row after the last, hashes, starts): the sorted distinct hashes
    of row ``first + k`` are ``hashes[starts[k]:starts[k + 1]]``.  A document with
    fewer words than ``words`` has its whole sequence as its one shingle; one without
    words, or null, has none.
    """
    for i, j, data, ends in chunks(text):
        word, doc = word_hashes(data, ends)
        per = np.bincount(doc, minlength=j - i).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(per)])
        total = len(word)
        acc = np.zeros(total, dtype=np.uint64)
        here = np.zeros(total, dtype=np.int64)
        within = begin[doc + 1] - np.arange(total) if total else here  # words left, this one included
        for k in range(words):
            ok = within > k
            here[ok] += 1
            shifted = np.zeros(total, dtype=np.uint64)
            shifted[: max(0, total - k)] = word[k:]
            step = acc * np.uint64(0xD6E8FEB86659FD93) + shifted
            acc = np.where(ok, step, acc)
        hashes = mix(acc ^ (here.astype(np.uint64) << np.uint64(58)))
        position = np.arange(total) - begin[doc] if total else here
        keep = (within >= words) | (position == 0)
        hashes, doc = hashes[keep], doc[keep]
        if len(hashes):
            sort_each(hashes, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=j - i))]))
            fresh = np.ones(len(hashes), dtype=bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            hashes, doc = hashes[fresh], doc[fresh]
        starts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=j - i))]).astype(np.int64)
        yield i, j, hashes, starts
