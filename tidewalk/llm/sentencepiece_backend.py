"""SentencePiece models run by the tokenizers library.

The model file is a protobuf message; its wire format is read here field by field, so no
generated code is needed.  What it says is rebuilt:

* the normaliser (``Normalizer``): the character map, user-defined pieces left as they
  are, white space runs and ends, the dummy prefix, and the white-space mark;
* a tokenizers-library tokenizer: the unigram scores or, for a merge model, the merges
  that its ranks imply; user-defined pieces; bytes for what no piece covers.

Two things are the library's own: it adds up unigram scores in double precision, the
model's own library in single, rounding from a text's start on, so paths whose scores
are equal to seven digits may be told apart otherwise; and merges of equal score are
ranked by piece before place.  Where the ids are verified, a text whose paths were told
apart otherwise is searched again in single precision, which settles ties up to a total score
of 65,536 (some 15,000 pieces); beyond that ``parity`` may still be false.  Models with
unused pieces or with marks behind words are refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewalk.llm.common import HELD, map_arrow
from tidewalk.llm.segments import SegmentEncoder, crc32

SPACE = "▁"

# Fixed values of the public model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; lengths-delimited and fixed values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 0x7F) << shift
            if byte < 0x80:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} in a model file")
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What a model file says, as far as encoding and decoding need it."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    space_as_suffix: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True
    unk_surface: str = " \u2047 "

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        out = cls()
        for number, value in wire_fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in wire_fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                out.pieces.append((piece, score, kind))
            elif number == 2:
                told = dict(wire_fields(value))
                out.kind = told.get(3, UNIGRAM)
                out.space_as_suffix = bool(told.get(24, 0))
                out.byte_fallback = bool(told.get(35, 0))
                out.unk_id = told.get(40, 0)
                out.unk_surface = told[44].decode("utf-8") if 44 in told else out.unk_surface
            elif number == 3:
                told = dict(wire_fields(value))
                out.charsmap = told.get(2, b"")
                out.add_dummy_prefix = bool(told.get(3, 1))
                out.remove_extra_spaces = bool(told.get(4, 1))
                out.escape_spaces = bool(told.get(5, 1))
        if not out.pieces:
            raise ValueError("the model has no pieces")
        return out

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    def merges(self) -> list[tuple[str, str]]:
        """The merges of a merge model, best first: every split of a piece into two pieces, by the piece's score."""
        score = {p: s for p, s, k in self.pieces if k in (NORMAL, USER_DEFINED, UNUSED)}
        rank = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        found = []
        for piece, value in score.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in score and right in score:
                    found.append((-value, rank[piece], rank[left], rank[right], left, right))
        found.sort()
        return [(x[4], x[5]) for x in found]

    def user_defined(self) -> list[str]:
        return [p for p, _, k in self.pieces if k == USER_DEFINED]

    def splits_at_spaces(self) -> bool:
        """Whether no piece goes on past a word into the next word's mark, so that words never share a piece.

        The mark must be a piece itself: unknown marks would be one with unknown characters beside them.
        """
        known = [p for p, _, k in self.pieces if k in (NORMAL, USER_DEFINED)]
        return SPACE in known and not any(SPACE in p.lstrip(SPACE) for p in known)


class CharacterMap:
    """The model's replacements of characters, longest match first.

    The map is a double array (a trie over UTF-8 bytes in 32-bit units) whose values are
    places in a block of zero-ended strings; it is walked as it is, not unpacked.
    """

    def __init__(self, data: bytes) -> None:
        size = struct.unpack("<I", data[:4])[0] if data else 0
        self.units = struct.unpack(f"<{size // 4}I", data[4 : 4 + size])
        self.texts = data[4 + size :]
        self.skip = re.compile(r"[ -~]+") if not self.units else re.compile(r"[ -~]+(?=[ -~]|\Z)") if self._leaves_ascii_alone() else None
        self.known: dict[str, tuple[int, str] | None] = {}

    def _step(self, node: int, byte: int) -> int | None:
        unit = self.units[node]
        after = node ^ ((unit >> 10) << ((unit & 0x200) >> 6)) ^ byte
        return after if after < len(self.units) and self.units[after] & 0x800000FF == byte else None

    def _value(self, node: int) -> str | None:
        unit = self.units[node]
        if not unit >> 8 & 1:
            return None
        at = self.units[node ^ ((unit >> 10) << ((unit & 0x200) >> 6))] & 0x7FFFFFFF
        return self.texts[at : self.texts.index(b"\0", at)].decode("utf-8")

    def _leaves_ascii_alone(self) -> bool:
        """No replacement is of printable ASCII alone, so a run of it matters only where something else follows."""
        for a in range(0x20, 0x7F):
            node = self._step(0, a)
            if node is not None and (self._value(node) is not None or any(self._step(node, b) is not None for b in range(0x20, 0x7F))):
                return False
        return True

    def longest(self, text: str, at: int) -> tuple[int, str] | None:
        """(characters, replacement) of the longest entry that begins at ``at``."""
        node, found = 0, None
        for k in range(at, len(text)):
            for byte in text[k].encode("utf-8", "surrogatepass"):
                node = self._step(node, byte)
                if node is None:
                    return found
            if (value := self._value(node)) is not None:
                found = k + 1 - at, value
        return found


class Normalizer:
    """A text as the model's own library hands it to its pieces."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.map = model, CharacterMap(model.charsmap)
        own = sorted(model.user_defined(), key=len, reverse=True)
        self.own = re.compile("|".join(map(re.escape, own))) if own else None

    def _mapped(self, text: str) -> str:
        if not self.map.units:
            return text
        out, at = [], 0
        while at < len(text):
            if self.map.skip and (run := self.map.skip.match(text, at)):
                out.append(run[0])
                at = run.end()
                continue
            width, value = self.map.longest(text, at) or (1, text[at])
            out.append(value)
            at += width
        return "".join(out)

    def __call__(self, text: str) -> str:
        if not text:
            return ""
        m = self.model
        # User-defined pieces stand as they are, the longest first; what lies between is mapped.
        if self.own:
            parts, at = [], 0
            for hit in self.own.finditer(text):
                parts += [self._mapped(text[at : hit.start()]), hit[0]]
                at = hit.end()
            text = "".join([*parts, self._mapped(text[at:])])
        else:
            text = self._mapped(text)
        if m.remove_extra_spaces:
            text = re.sub(" +", " ", text.lstrip(" "))
            if not text:
                return ""
        if m.add_dummy_prefix:
            text = " " + text
        if m.escape_spaces:
            text = text.replace(" ", SPACE)
        return text.rstrip(SPACE if m.escape_spaces else " ") if m.remove_extra_spaces else text


def build_tokenizer(model: PieceModel):
    """The tokenizers-library tokenizer that encodes what ``Normalizer`` gives as the model does (spaces count as marks).

    A unigram model's control, unknown and byte pieces have names there that no text has,
    since the library would take them for pieces of text; bytes are then put in by ``PieceCodec``.
    """
    from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers, pre_tokenizers

    if any(k == UNUSED for _, _, k in model.pieces):
        raise ValueError("models with unused pieces are not supported")
    own = model.user_defined()
    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab=vocab, merges=model.merges(), unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        plain = [s for _, s, k in model.pieces if k == NORMAL]
        low, high = min(plain, default=0.0), max([*plain, struct.unpack("<f", struct.pack("<I", 0x00800000))[0]])
        scored = []
        for i, (p, s, k) in enumerate(model.pieces):
            if k == USER_DEFINED:  # always worth more than its parts
                scored.append((p, len(p.encode()) * high - 0.1))
            else:
                scored.append((p, s) if k == NORMAL else (f"\U0010ffff{i}\U0010ffff", low))
        core = models.Unigram(scored, unk_id=model.unk_id, byte_fallback=False)
    else:
        raise ValueError(f"models of type {model.kind} are not supported")
    tokenizer = Tokenizer(core)
    if model.escape_spaces:
        tokenizer.normalizer = normalizers.Replace(" ", SPACE)
    if model.escape_spaces and model.splits_at_spaces():
        # A word with the marks before it is a unit of its own, which the library remembers.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    if own and model.kind == BPE:
        tokenizer.add_tokens([AddedToken(p, normalized=True, special=False) for p in own])
    return tokenizer


def _literal_marks(data: np.ndarray) -> np.ndarray:
    """Places of the mark's own character in a text, where it counts as white space."""
    return np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)


class PieceCodec:
    """Encodes and decodes batches of texts as the model's own library would.

    Where the model lets words never share a piece and takes texts as they are, distinct
    words are encoded once (``SegmentEncoder``); otherwise whole texts are normalised
    and go to the library.
    """

    def __init__(self, path: str | None = None, model: PieceModel | None = None) -> None:
        self.model = m = model or PieceModel.load(path)
        if m.space_as_suffix:
            raise ValueError("models with the white-space mark behind words are not supported")
        self.tokenizer, self.normalize = build_tokenizer(m), Normalizer(m)
        plain = not m.charsmap and not m.remove_extra_spaces and m.escape_spaces and not m.user_defined()
        by_word = plain and m.splits_at_spaces() and m.kind == BPE and m.byte_fallback
        self.segments = SegmentEncoder(self._ids, spaces=b" ", odd=_literal_marks, narrow=len(m.pieces) <= 1 << 16) if by_word else None
        self.kinds = np.array([k for _, _, k in m.pieces])
        said = {UNKNOWN: lambda p: m.unk_surface.encode(), CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:5], 16)])}
        raw = [said.get(k, lambda p: p.replace(SPACE, " ").encode())(p) for p, _, k in m.pieces]
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(m.pieces) if k == BYTE}
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.width = np.array([len(r) for r in raw])
        self.place = np.cumsum(self.width) - self.width
        self.scored: dict[str, tuple[int, float]] | None = None
        #: Whether a piece begins with white space that a text's start may lose.
        self.led = np.array([k in (NORMAL, USER_DEFINED) and p.startswith(SPACE) for p, _, k in m.pieces])

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that are normalised but for the mark."""
        if not (self.model.kind == UNIGRAM and self.model.byte_fallback):
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out = []
        for text, found in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids: list[int] = []
            for i, (a, b) in zip(found.ids, found.offsets, strict=True):
                ids += [self.byte_ids[x] for x in text[a:b].encode("utf-8", "surrogatepass")] if i == self.model.unk_id else [i]
            out.append(ids)
        return out

    def in_single_precision(self, text: str) -> list[int]:
        """A unigram model's best path through a whole text, scores rounded as the model's own library does.

        Much slower than the library; only for texts on which the two differ.
        """
        if self.scored is None:
            plain = [s for _, s, k in self.model.pieces if k == NORMAL]
            low, high = min(plain, default=0.0), max([*plain, struct.unpack("<f", struct.pack("<I", 0x00800000))[0]])
            self.scored = {p: (i, len(p.encode()) * high - 0.1 if k == USER_DEFINED else s) for i, (p, s, k) in enumerate(self.model.pieces) if k in (NORMAL, USER_DEFINED)}
            self.begun = {p[:k] for p in self.scored for k in range(1, len(p) + 1)}
            self.unknown = float(np.float32(low - 10.0))
        said = self.normalize(text)
        best, came, ids = [0.0] * (len(said) + 1), [-1] * (len(said) + 1), [0] * (len(said) + 1)
        single = struct.Struct("<f")
        for a in range(len(said)):
            b, covered = a + 1, False
            while b <= len(said) and (piece := said[a:b]) in self.begun:
                if (found := self.scored.get(piece)) is not None:
                    score = single.unpack(single.pack(found[1] + best[a]))[0]
                    if came[b] < 0 or score > best[b]:
                        best[b], came[b], ids[b] = score, a, found[0]
                    covered = covered or b == a + 1
                b += 1
            if not covered:
                score = single.unpack(single.pack(self.unknown + best[a]))[0]
                if came[a + 1] < 0 or score > best[a + 1]:
                    best[a + 1], came[a + 1], ids[a + 1] = score, a, self.model.unk_id
        path, b = [], len(said)
        while b > 0:
            path.append((ids[b], came[b], b))
            b = came[b]
        out: list[int] = []
        for k, (i, a, b) in enumerate(reversed(path)):
            if i != self.model.unk_id:
                out.append(i)
            elif self.model.byte_fallback:
                out += [self.byte_ids[x] for x in said[a:b].encode("utf-8", "surrogatepass")]
            elif not k or out[-1] != i:  # a run of unknown characters is one
                out.append(i)
        return out

    def batches(self, text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, ids in a row, starts by row)."""
        texts = text.cast(pa.large_string())
        texts = texts.fill_null("") if texts.null_count else texts
        if self.segments:
            if self.model.add_dummy_prefix:
                full = pa.compute.greater(pa.compute.binary_length(texts), 0)
                texts = pa.compute.if_else(full, pa.compute.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())), texts)
            yield from self.segments.batches(texts)
            return
        for i in range(0, len(texts), 512):
            part = self._ids([self.normalize(x) for x in texts.slice(i, 512).to_pylist()])
            starts = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64)
            yield i, i + len(part), np.fromiter((x for one in part for x in one), np.uint32, starts[-1]), starts

    def _lead(self, ids: np.ndarray) -> int:
        """Bytes of white space that a text loses at its start: the dummy prefix, or all of it where the model strips."""
        if not (self.model.add_dummy_prefix or self.model.remove_extra_spaces):
            return 0
        gone = 0
        for i in ids:
            if self.kinds[i] == CONTROL:
                continue
            gone += int(self.led[i])
            if not self.led[i] or not self.model.remove_extra_spaces or self.width[i] > 1:
                break
        return gone

    def decode_bytes(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of documents whose ids stand in a row, the dummy prefix gone; bytes that are no text stay as they are."""
        width = self.width[ids]
        ends = np.concatenate([[0], np.cumsum(width)])
        data = self.flat[np.repeat(self.place[ids] - ends[:-1], width) + np.arange(ends[-1])].tobytes()
        cuts = ends[starts].tolist()
        spans = zip(starts[:-1].tolist(), starts[1:].tolist(), cuts[:-1], cuts[1:], strict=True)
        return [data[a + self._lead(ids[i:j]) : b] for i, j, a, b in spans]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of ids; control pieces give nothing, the dummy prefix goes."""
        flat = np.array([x for one in ids for x in one], np.int64)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        return [raw.decode("utf-8", "replace") for raw in self.decode_bytes(flat, starts)]


_CODECS: dict[str, PieceCodec] = {}
HELD.append(_CODECS)


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def _verified(own: PieceCodec, other, texts: list[str], ids: np.ndarray, starts: np.ndarray) -> tuple[list[bool], np.ndarray, np.ndarray]:
    """Whether each text's ids are the model's own library's, and the ids; differing unigram paths are searched again first."""
    wanted, every = other.encode(texts, num_threads=1), ids.tolist()
    parts = [every[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    odd = [k for k, (x, y) in enumerate(zip(parts, wanted, strict=True)) if x != y] if own.model.kind == UNIGRAM else []
    for k in odd:
        parts[k] = own.in_single_precision(texts[k])
    if odd:
        starts = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        ids = np.fromiter((x for one in parts for x in one), np.uint32, starts[-1])
    return [x == y for x, y in zip(parts, wanted, strict=True)], ids, starts


def _run(path: str, verify: bool, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, other = codec(path), None
        if verify:
            import sentencepiece

            other = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            docs = batch.column("doc_id").cast(pa.int64())
            for i, j, ids, starts in own.batches(batch.column("text")):
                texts = batch.column("text").slice(i, j - i).fill_null("").to_pylist()
                same = [None] * (j - i)
                if other:
                    same, ids, starts = _verified(own, other, texts, ids, starts)
                cuts = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
                decoded = own.decode_bytes(ids, starts)
                single = np.concatenate([[0], np.cumsum(own.kinds[ids] == BYTE)])
                columns = [
                    docs.slice(i, j - i),
                    pa.array(np.diff(starts)),
                    pa.array(single[starts[1:]] - single[starts[:-1]]),
                    pa.array([crc32(ids[a:b]) for a, b in cuts], pa.int64()),
                    pa.array([d == t.encode() for d, t in zip(decoded, texts, strict=True)]),
                    pa.array(same, pa.bool_()),
                ]
                if with_ids:
                    columns += [pa.array([ids[a:b].astype("<u4").tobytes() for a, b in cuts], pa.binary()), pa.array([d.decode("utf-8", "replace") for d in decoded], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, _NAMES[: len(columns)])

    return run


_NAMES = ["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "round_trip", "parity", "ids", "decoded"]


def encode_documents(docs: DataFrame, model_path: str, verify: bool = True, with_ids: bool = False) -> DataFrame:
    """Each document's ids under a SentencePiece model, run by the tokenizers library, and its text from those ids.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at.  A null text
    is empty and has no ids.  One row per row of ``docs``: ``n_tokens``,
    ``n_byte_tokens`` (ids of single bytes), ``ids_crc32`` (as little-endian unsigned
    32-bit integers), ``round_trip`` (decoding gives the text back), ``parity`` (the
    model's own library gives the same ids; null unless ``verify``) and, ``with_ids``,
    ``ids`` (those bytes) and ``decoded``.  Rows are independent of each other, so null
    and repeated ``doc_id`` are kept; texts of any length are encoded whole; an empty
    table gives no rows.
    """
    schema = "doc_id long, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean, parity boolean" + ", ids binary, decoded string" * with_ids
    return map_arrow(docs.select("doc_id", "text"), _run(model_path, verify, with_ids), schema, holds=True)
