"""SentencePiece models written by hand, held to the model's own library."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewalk.llm.sentencepiece_backend import BPE, BYTE, CONTROL, NORMAL, UNIGRAM, UNKNOWN, USER_DEFINED, PieceCodec, PieceModel, encode_documents

# Characters that the hand-written map replaces; "e" with an accent is an entry of two characters.
MAP = {"é": "e", "é": "E", "\t": " ", "\n": " ", "　": " ", " ": " ", "ﬁ": "fi", "¨": " x", "​": "", "日": "ab"}


def varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def double_array(entries: dict[bytes, int]) -> list[int]:
    """A double array over the entries' bytes; each node's block of 256 cells is its own, which wastes space and can't collide."""
    tree: dict = {}
    for key, value in entries.items():
        node = tree
        for byte in key:
            node = node.setdefault(byte, {})
        node[-1] = value
    units = [0] * 256
    free = 256

    def lay(node: dict, at: int) -> None:
        nonlocal free
        base = free
        free += 256
        units.extend([0] * 256)
        offset = base ^ at
        assert offset < 1 << 21
        units[at] |= (1 << 8 if -1 in node else 0) | offset << 10
        if -1 in node:
            units[at ^ offset] = node[-1] | 1 << 31
        for byte, child in node.items():
            if byte >= 0:
                place = at ^ offset ^ byte
                units[place] |= byte
                lay(child, place)

    lay(tree, 0)
    return units


def charsmap(replaced: dict[str, str]) -> bytes:
    texts, entries = b"", {}
    for key, value in replaced.items():
        entries[key.encode()] = len(texts)
        texts += value.encode() + b"\0"
    units = double_array(entries)
    raw = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(raw)) + raw + texts


def model_bytes(kind: int, pieces: list, byte_fallback: bool, mapped: bool, dummy: bool, strip: bool, escape: bool = True) -> bytes:
    rows = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    rows += [(f"<0x{k:02X}>", 0.0, BYTE) for k in range(256)] if byte_fallback else []
    out = b""
    for text, score, sort in rows + pieces:
        out += field(1, field(1, text.encode()) + field(2, float(score)) + field(3, sort))
    out += field(2, field(3, kind) + field(35, int(byte_fallback)) + field(40, 0) + field(41, 1) + field(42, 2) + field(43, (1 << 64) - 1))
    rules = field(1, b"own") + field(3, int(dummy)) + field(4, int(strip)) + field(5, int(escape))
    return out + field(3, rules + (field(2, charsmap(MAP)) if mapped else b""))


def unigram_pieces(own: bool, ties: bool = False) -> list:
    rng = np.random.default_rng(5)
    words = ["▁", "a", "b", "c", "e", "E", "f", "i", "x", "<", "s", ">", "▁a", "ab", "abc", "▁ab", "bc", "▁abc", "ca", "fi", "▁fi", "xx", "a▁b", "é"] + (["▁▁", "aa"] if ties else [])
    return [(w, -float(s), NORMAL) for w, s in zip(words, rng.uniform(2, 9, len(words)), strict=True)] + ([("<own>", 0.0, USER_DEFINED), ("bé", 0.0, USER_DEFINED)] if own else [])


def merge_pieces(own: bool) -> list:
    words = ["ab", "▁a", "▁ab", "abc", "ca", "fi", "▁fi", "xc", "bc", "▁abc", "caab", "es", "<s"]
    singles = ["▁", "a", "b", "c", "e", "E", "f", "i", "x", "s", "<", ">"]
    return [(w, -float(k), NORMAL) for k, w in enumerate(words + singles)] + ([("<own>", 0.0, USER_DEFINED), ("bé", 0.0, USER_DEFINED)] if own else [])


TEXTS = st.lists(st.text(st.one_of(st.sampled_from("aabbcef  \n\té́ﬁ¨日​　▁<s>x"), st.sampled_from(["q", "😀", "Ω"])), max_size=24), max_size=4)
FRAGMENTS = st.lists(st.lists(st.sampled_from(["a", "b", "c", "ab", " ", "  ", "<own>", "bé", "é", "<s>", "<0x41>", "<unk>", "▁", "q", "日", "\n"]), max_size=9).map("".join), max_size=4)


def agrees(codec: PieceCodec, other: sentencepiece.SentencePieceProcessor, texts: list[str]) -> None:
    found = [ids[a:b].tolist() for _, _, ids, s in codec.batches(pa.array(texts, pa.string())) for a, b in zip(s[:-1], s[1:], strict=True)]
    assert found == [other.encode(t) for t in texts]
    assert codec.decode(found) == [other.decode(f) for f in found]


@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("mapped", [False, True])
@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("kind", [UNIGRAM, BPE])
def test_hand_written_models_equal_their_own_library(kind, fallback, mapped, own):
    for dummy, strip in [(True, True), (True, False), (False, True), (False, False)]:
        data = model_bytes(kind, unigram_pieces(own) if kind == UNIGRAM else merge_pieces(own), fallback, mapped, dummy, strip)
        other, codec = sentencepiece.SentencePieceProcessor(model_proto=data), PieceCodec(model=PieceModel.parse(data))

        @given(st.one_of(TEXTS, FRAGMENTS))
        @settings(max_examples=60, deadline=None)
        def check(texts):
            agrees(codec, other, texts)  # noqa: B023

        check()
        agrees(codec, other, ["", " ", "   ", "\n", "▁", " ▁ ", "a" * 3000, "ab c " * 700, "q" * 300])


@pytest.mark.parametrize("fallback", [False, True])
def test_paths_of_equal_score(fallback):
    data = model_bytes(UNIGRAM, unigram_pieces(True, ties=True), fallback, True, True, False)
    other, codec = sentencepiece.SentencePieceProcessor(model_proto=data), PieceCodec(model=PieceModel.parse(data))

    @given(st.one_of(TEXTS, FRAGMENTS))
    @settings(max_examples=100, deadline=None)
    def check(texts):
        assert [codec.in_single_precision(t) for t in texts] == [other.encode(t) for t in texts]

    check()
    for text in ["aa   ", "a" * 999, "aab   " * 800, "aa a" * 5000]:
        assert codec.in_single_precision(text) == other.encode(text)


def test_the_default_rules_of_a_unigram_model():
    data = model_bytes(UNIGRAM, [("▁", -3.0, NORMAL), ("a", -2.0, NORMAL), ("▁ab", -1.0, NORMAL), ("b", -2.5, NORMAL)], False, False, True, True)
    codec = PieceCodec(model=PieceModel.parse(data))
    ids = next(iter(codec.batches(pa.array(["  ab   a "]))))[2].tolist()
    assert [codec.model.pieces[i][0] for i in ids] == ["▁ab", "▁", "a"]


def test_what_is_not_supported_is_refused():
    with pytest.raises(ValueError, match="unused"):
        PieceCodec(model=PieceModel([("<unk>", 0.0, UNKNOWN), ("a", -1.0, 5)], kind=BPE))
    with pytest.raises(ValueError, match="behind"):
        PieceCodec(model=PieceModel([("<unk>", 0.0, UNKNOWN), ("a", -1.0, NORMAL)], space_as_suffix=True))
    with pytest.raises(ValueError, match="type 3"):
        PieceCodec(model=PieceModel([("<unk>", 0.0, UNKNOWN), ("a", -1.0, NORMAL)], kind=3))


def test_documents_at_the_edges(spark, tmp_path):
    path = tmp_path / "own.model"
    path.write_bytes(model_bytes(UNIGRAM, unigram_pieces(True, ties=True), True, True, True, False))
    schema = "doc_id long, text string, ids int"
    docs = spark.createDataFrame([(1, None, 0), (None, "ab", 1), (1, "ab", 2), (1, "ab", 2), (2, "", 0), (3, "a b c " * 50_000, 0), (4, "aa   b c " * 900, 0)], schema)
    got = encode_documents(docs, str(path), with_ids=True).collect()
    assert len(got) == 7 and all(r["parity"] for r in got)
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got)[:3] == [(0, 1), (1, 0), (1, 1)]
    assert encode_documents(docs.limit(0), str(path)).count() == 0
