"""Batch encoding by a tokenizers-library tokenizer, each distinct segment once.

A text is cut before every run of white space, so a segment is a run of white space and
the word after it.  Where no id ever spans such a cut, and what a segment becomes doesn't
depend on its neighbours, a text's ids are its segments' ids in a row, and each distinct
segment is encoded by the library only once while the memory of them lasts.  Whether a
tokenizer is of that kind is told from its file and tried on sample texts
(``cuts_at_space``); any other gets whole texts.  Texts with white space outside ASCII
could join two segments' white space, and special tokens may take white space beside
them, so texts with either go to the library whole.
"""

from __future__ import annotations

import contextlib
import itertools
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tidewalk.llm.common import HELD
from tidewalk.llm.shingles import _T, chunks, mix

#: Distinct segments remembered by one Python worker before it starts anew.
REMEMBERED = 1_000_000

#: Recent segments that are looked up apart, so that learning a few doesn't move all.
RECENT = 50_000

#: Stands between segments that are encoded together.
MARK = "\x01"

ASCII_SPACE = bytes([0x20, *range(0x09, 0x0E)])


def odd_space(data: np.ndarray) -> np.ndarray:
    """Places of the last byte of white space outside ASCII, by its UTF-8 bytes."""
    found = []
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data == lead)
        b, c = padded[at + 1], padded[at + 2]
        if lead == 0xC2:
            ok = (b == 0x85) | (b == 0xA0)
        elif lead == 0xE1:
            ok = (b == 0x9A) & (c == 0x80)
        elif lead == 0xE2:
            ok = ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))
        else:
            ok = (b == 0x80) & (c == 0x80)
        found.append(at[ok])
    return np.concatenate(found)


class SegmentEncoder:
    """``encode(texts)`` gives the ids of each string; ``spaces`` are the bytes that start a segment, ``odd`` finds what sends a text to the library whole, ``apart`` are strings that do so too; ids below 65,536 are kept ``narrow``."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], spaces: bytes = ASCII_SPACE, odd: Callable[[np.ndarray], np.ndarray] = odd_space, narrow: bool = False, apart: list[str] | None = None) -> None:
        self.encode, self.odd = encode, odd
        found = sorted(apart or [], key=len, reverse=True)
        self.apart = re.compile("|".join(map(re.escape, found)).encode()) if found else None
        self.space = np.zeros(256, dtype=bool)
        self.space[list(spaces)] = True
        rng = np.random.Generator(np.random.PCG64(7))
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.narrow, self.gap = narrow, spaces[0]
        self.mark = encode([f"{chr(self.gap)}{MARK}"])[0]
        if self.mark.count(self.mark[-1]) != 1:
            raise ValueError("the mark's last id must be the mark's alone")
        self.forget()

    def forget(self) -> None:
        #: Known keys in two sorted tables: most of them, and recent ones that join the first from time to time.
        self.known = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]
        self.count = 0
        self.begin = np.zeros(1 << 12, np.int32)
        self.flat = np.zeros(1 << 16, np.uint16 if self.narrow else np.uint32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where the keys' ids are kept, -1 for what isn't known."""
        out = np.full(len(keys), -1, np.int32)
        for table, slots in self.known:
            if len(table):
                place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                hit = table[place] == keys
                out[hit] = slots[place[hit]]
        return out

    def _is_space(self, char: str) -> bool:
        return ord(char) < 128 and bool(self.space[ord(char)])

    def _encode_distinct(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and how many each has.

        The library is called on long strings, in which a mark stands after each segment;
        one that begins without white space, is nothing else, or has the mark's character goes alone.
        """
        alone = [k for k, x in enumerate(texts) if MARK in x or not self._is_space(x[0]) or self._is_space(x[-1]) or (self.apart and self.apart.search(x.encode()))]
        found: dict[int, np.ndarray] = dict(zip(alone, (np.array(x, np.uint32) for x in self.encode([texts[k] for k in alone])), strict=True)) if alone else {}
        rest = [k for k in range(len(texts)) if k not in found]
        tail = f"{chr(self.gap)}{MARK}"
        joined = [tail.join(texts[k] for k in rest[a : a + 2048]) + tail for a in range(0, len(rest), 2048)]
        runs, counts = [], np.zeros(len(texts), np.int64)
        done = []
        for x in self.encode(joined) if joined else []:
            ids = np.array(x, np.uint32)
            ends = np.flatnonzero(ids == self.mark[-1])
            keep = np.ones(len(ids), dtype=bool)
            for k in range(len(self.mark)):
                keep[ends - k] = False
            runs.append(ids[keep])
            done.append(np.diff(ends, prepend=-1) - len(self.mark))
        if rest:
            counts[rest] = np.concatenate(done)
        flat = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
        if alone:
            starts = np.cumsum(counts) - counts
            where = np.repeat([starts[k] for k in alone], [len(found[k]) for k in alone])
            flat = np.insert(flat, where, np.concatenate([found[k] for k in alone]))
            counts[alone] = [len(found[k]) for k in alone]
        return flat, counts

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        ids, lengths = self._encode_distinct(texts)
        used, more, n = int(self.begin[self.count]), len(ids), len(texts)
        while used + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + n >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[used : used + more] = ids
        self.begin[self.count + 1 : self.count + n + 1] = used + np.cumsum(lengths)
        most, recent = self.known
        recent = self._joined(recent, (keys, np.arange(self.count, self.count + n, dtype=np.int32)))
        self.count += n
        if len(recent[0]) > RECENT:
            most, recent = self._joined(most, recent), (recent[0][:0], recent[1][:0])
        self.known = [most, recent]

    @staticmethod
    def _joined(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(a[0], b[0])
        return np.insert(a[0], place, b[0]), np.insert(a[1], place, b[1])

    def _segments(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        gap = self.space[data]
        first = gap.copy()
        first[1:] &= ~gap[:-1]
        first[0] = True
        first[ends[ends < n]] = True
        starts = np.flatnonzero(first)
        return starts, np.append(starts[1:], n)

    def _chunk(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in a row, and how many ids each document has."""
        docs = len(ends)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(docs, np.int64)
        starts, stops = self._segments(data, ends)
        up, down = _T.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.byte[data] * up[: len(data)], out=sums[1:])
        keys = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
        each, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if self.count + len(each) > REMEMBERED:
            self.forget()
        slot = self._slots(each)
        new = slot < 0
        if new.any():
            raw = data.tobytes()
            at = first[new]
            self._learn(each[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at].tolist(), stops[at].tolist(), strict=True)])
            slot[new] = np.arange(self.count - int(new.sum()), self.count)
        slot = slot[back]
        count = (self.begin[slot + 1] - self.begin[slot]).astype(np.int64)
        before = np.cumsum(count) - count
        total = int(count.sum())
        ids = self.flat[np.repeat(self.begin[slot] - before, count) + np.arange(total)].astype(np.uint32)
        owner = np.searchsorted(ends, starts, side="right")
        per = np.bincount(owner, weights=count, minlength=docs).astype(np.int64)
        return ids, per

    def batches(self, text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, ids in a row, starts by row) over a string array; null counts as empty."""
        for i, j, data, ends in chunks(text):
            odd = self.odd(data) if len(data) else np.zeros(0, np.int64)
            if self.apart and len(data):
                odd = np.concatenate([odd, np.array([m.start() for m in self.apart.finditer(data.tobytes())], np.int64)])
            ids, per = self._chunk(data, ends)
            starts = np.concatenate([[0], np.cumsum(per)])
            if len(odd):
                parts = [ids[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                whole = np.unique(np.searchsorted(ends, odd, side="right")).tolist()
                for k, found in zip(whole, self.encode(text.take(pa.array([i + k for k in whole])).to_pylist()), strict=True):
                    parts[k] = np.array(found, np.uint32)
                starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
                ids = np.concatenate(parts) if parts else ids
            yield i, j, ids, starts


class WholeEncoder:
    """Batches as ``SegmentEncoder`` gives them, every text encoded whole."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]) -> None:
        self.encode = encode

    def batches(self, text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for i, j, _, _ in chunks(text):
            part = self.encode(text.slice(i, j - i).fill_null("").to_pylist())
            starts = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64)
            yield i, j, np.fromiter((x for one in part for x in one), np.uint32, starts[-1]), starts


#: Parts of the sample texts: every pair and triple of them is tried, in one order each.
_SAMPLES = ["a", "Word", "don't", "12", "3.5", "é", "日本", "😀", "-", "...", "(", "x_y", "\x01", "A1b"]
_GAPS = [" ", "  ", "   ", "\n", " \n", "\n\n ", "\t", "\r\n", " \t "]


def cuts_at_space(tokenizer) -> bool:
    """Whether segments can be encoded by themselves.

    The file must say that text is cut at white space before the model sees it (byte
    level with its pattern, or a split that removes white space, behind normalisers that
    look at no neighbours across it), and on sample texts the segments' ids must be the
    whole text's.
    """
    told = json.loads(tokenizer.to_str())
    before = told.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    byte_level = len(steps) == 1 and steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex") and not steps[0].get("add_prefix_space")
    split = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") and all(x.get("type") == "ByteLevel" and not x.get("add_prefix_space") for x in steps[1:])
    normal = told.get("normalizer") or {"type": "Sequence", "normalizers": []}
    local = all(x.get("type") in ("NFC", "Lowercase") or (x.get("type") == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " ") for x in normal.get("normalizers", [normal]))
    if not (byte_level or split or before.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")) or not local:
        return False
    texts = []
    for k, (a, b) in enumerate(itertools.product(_SAMPLES, repeat=2)):
        x, y = _GAPS[k % len(_GAPS)], _GAPS[(k // 3) % len(_GAPS)]
        texts += [f"{a}{x}{b}", f"{x}{a}{y}{b}{x}", f"{a}{b}{y}{a}"]
    cut = [re.findall(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+", t) for t in texts]
    with one_thread():
        ids = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        parts = tokenizer.encode_batch_fast([x for segments in cut for x in segments], add_special_tokens=False)
    each = iter(parts)
    return all(whole.ids == [i for _ in segments for i in next(each).ids] for whole, segments in zip(ids, cut, strict=True))


#: The library's own switch for threads.
THREADS = "TOKENIZERS_PARALLELISM"


@contextlib.contextmanager
def one_thread() -> Iterator[None]:
    """The tokenizers library without threads, unless the environment says what it wants.

    Tasks already fill an executor's cores, and each thread keeps memory of its own.
    """
    told = THREADS in os.environ
    if not told:
        os.environ[THREADS] = "false"
    try:
        yield
    finally:
        if not told:
            del os.environ[THREADS]


_ENCODERS: dict[tuple[str, bool], SegmentEncoder | WholeEncoder] = {}
HELD.append(_ENCODERS)


def library_encoder(path: str, special_as_text: bool = False) -> SegmentEncoder | WholeEncoder:
    """The encoder of a tokenizers-library file.

    Strings of special tokens in a text become those tokens, as the library's plain call
    has it, or with ``special_as_text`` ordinary text.
    """
    key = path, special_as_text
    if key not in _ENCODERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = special_as_text
        tokenizer.no_truncation()
        tokenizer.no_padding()
        added = [x.content for x in tokenizer.get_added_tokens_decoder().values() if not (special_as_text and x.special)]

        def encode(texts: list[str]) -> list[list[int]]:
            with one_thread():
                return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        narrow = tokenizer.get_vocab_size() <= 1 << 16
        # Other added tokens may stand inside words or be normalised first; then texts stay whole.
        simple = all(x.special and not x.normalized and x.content for x in tokenizer.get_added_tokens_decoder().values())
        _ENCODERS[key] = SegmentEncoder(encode, narrow=narrow, apart=added) if simple and cuts_at_space(tokenizer) else WholeEncoder(encode)
    return _ENCODERS[key]


def crc32(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
