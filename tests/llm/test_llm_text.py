"""Shingles, near copies, tokens, packing, files, fingerprints: against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewalk.llm import fingerprints as FP
from tidewalk.llm.components import connected_components
from tidewalk.llm.common import Workspace
from tidewalk.llm.elias_fano import EliasFano
from tidewalk.llm.jaccard_join import JaccardParams, near_duplicate_representatives, ngram_jaccard_join
from tidewalk.llm.packing import OpenWindows, PackingParams, pack_documents
from tidewalk.llm.segments import library_encoder
from tidewalk.llm.sentencepiece_backend import PieceCodec, encode_documents
from tidewalk.llm.shingles import shingle_sets
from tidewalk.llm.token_files import TokenFile, TokenFileParams, read_token_files, token_file_folder, write_token_files

BYTE, WORD, PIECE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
WORDS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string"
ODD = ["", None, "a", "a b", "A b", "  a\t b \n", "ÄÖ ü", "x" * 5000, "one two three", "one  two\nthree", "<|endoftext|> hi   there", "tab\t\tx \x01 y", " em space", "don't we'll", "日本語 😀 ok"]


def lower(x: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def shingles(text: str | None, n: int) -> frozenset:
    w = WORDS.findall(lower(text or ""))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(docs: list[tuple], n: int, percent: int) -> dict:
    sets = [shingles(t, n) for _, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            k = len(sets[i] & sets[j])
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


@given(st.lists(st.text(st.sampled_from("aAbB \t\n é"), max_size=40), max_size=8), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_shingle_sizes(texts, n):
    got = [int(s) for _, _, _, starts in shingle_sets(pa.array(texts, pa.string()), n) for s in np.diff(starts)]
    assert got == [len(shingles(t, n)) for t in texts]


def near_copies() -> list[tuple]:
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(400)]
    docs: list[tuple] = []
    for base in range(12):
        words = list(rng.choice(vocabulary, 120))
        docs.append((len(docs) * 3, " ".join(words)))
        for _ in range(int(rng.integers(0, 9))):
            edited = list(words)
            for _ in range(int(rng.integers(0, 7))):
                edited[int(rng.integers(0, 120))] = str(rng.choice(vocabulary))
            docs.append((len(docs) * 3, " ".join(edited)))
            if rng.random() < 0.3:
                words = edited  # chains of copies drift away from their first
    docs += [(1000 + k, "one shared line of words stands here " + " ".join(rng.choice(vocabulary, 30))) for k in range(30)]
    docs += [(2000 + k, t) for k, t in enumerate(ODD)] + [(None, docs[0][1]), (2001, "a"), (2000, docs[5][1])]
    return docs


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 60), (2, 100)])
def test_near_copies_equal_brute_force(spark, n, percent):
    docs = near_copies()
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("n", F.lit("clash")).withColumn("component", F.lit(1)).repartition(3)
    got = ngram_jaccard_join(frame, JaccardParams(words=n, percent=percent)).collect()
    assert len(got) == len(docs)
    want = brute(docs, n, percent)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert sorted(r["n_shingles"] for r in got) == sorted(len(shingles(t, n)) for _, t in docs)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    kept = near_duplicate_representatives(frame, JaccardParams(words=n, percent=percent))
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {None} | set(want.values())


def test_one_row_of_each_kept_id_stays(spark):
    rows = [(1, "a b c d e f", {"k": 2}, 2), (1, "a b c d e f", {"k": 1}, 1), (2, "a b c d e f", None, 0), (3, "x y z", None, 5), (3, None, None, 6), (3, "x y z", None, 4), (4, "alone", None, 0), (5, "", None, 0), (5, "", None, 0), (None, "n", None, 1), (None, "n", None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, rank int").repartition(3)
    kept = near_duplicate_representatives(frame)
    assert kept.columns == frame.columns
    got = sorted(((r["doc_id"], r["text"], r["rank"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, "a b c d e f", 1), (3, None, 6), (4, "alone", 0), (5, "", 0), (None, "n", 1), (None, "n", 1)], key=str)


def test_no_documents_no_components(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_jaccard_join(empty).collect() == []
    assert ngram_jaccard_join(spark.createDataFrame([(1, None)], SCHEMA)).collect()[0][:] == (1, 0, 1)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(201, 202), (202, 203), (203, 201), (300, 300)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long"), Workspace(spark, "t")).collect()
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {k: 201 for k in (201, 202, 203)}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_segments_give_the_librarys_ids(path):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True

    @given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t 'a1Aé́\x01"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=6))
    @settings(max_examples=80, deadline=None)
    def check(texts):
        found = [ids[a:b].tolist() for _, _, ids, s in library_encoder(path).batches(pa.array(texts, pa.string())) for a, b in zip(s[:-1], s[1:], strict=True)]
        assert found == [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]

    check()


def test_windows_keep_their_limit_and_fit_best():
    w = OpenWindows(size=10, limit=2)
    assert w.add("a", 7) == [] and w.add("b", 8) == []
    assert w.add("c", 3) == [["a", "c"]]  # fills a exactly
    assert w.add("d", 9) == [] and w.add("e", 4) == [["d"]]  # none fits, both open: the fullest goes
    assert len(w.room) == 2 and sorted(map(tuple, w.rest())) == [("b",), ("e",)]


def test_packing_lays_every_id_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (None, "x y"), (-3, "word " * 9000)], SCHEMA))
    params = PackingParams(BYTE, with_ids=True, open_windows=8)
    got = pack_documents(docs.repartition(5).withColumn("window", F.lit(1)), params).toPandas()
    tok = Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = True
    want = {r["doc_id"]: np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4") for r in docs.collect()}
    for doc, own in got.sort_values("start").groupby("doc_id", dropna=False):
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in own["ids"]])
        assert ids.tolist() == want[None if doc != doc else int(doc)].tolist()
        assert own["start"].tolist() == (np.cumsum(own["length"]) - own["length"]).tolist() and set(own["doc_tokens"]) == {len(ids)}
        assert own["ids_crc32"].tolist() == [zlib.crc32(b) for b in own["ids"]]
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq["offset"].tolist() == (np.cumsum(seq["length"]) - seq["length"]).tolist() and seq["length"].sum() <= 2048
    assert got["length"].sum() > 0.9 * 2048 * (got["sequence_id"].nunique() - 1)
    assert pack_documents(docs.limit(0), params).count() == 0


@given(st.lists(st.integers(0, 1 << 40), max_size=400), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values, shrink):
    values = sorted(v >> (shrink * 12) for v in values)
    coded = EliasFano.encode(np.array(values, np.int64))
    back = EliasFano.of_parts(coded.n, coded.low_bits, coded.parts())
    assert back.decode().tolist() == values and [back.select(k) for k in range(len(values))] == values
    assert 8 * (len(coded.low) + len(coded.high)) <= len(values) * (4 + max(1, (values[-1] // len(values)).bit_length() if values else 1)) + 16


def test_token_files(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-7, None), (None, "nobody"), (5, "a second five"), (None, "")], SCHEMA))
    params = TokenFileParams(WORD, files=3)
    shards = write_token_files(docs.repartition(4).withColumn("shard", F.lit(0)), params, token_file_folder(spark))
    got = read_token_files(shards).orderBy("start").collect()
    tok = Tokenizer.from_file(WORD)
    tok.encode_special_tokens = True
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    first = shards.orderBy("shard").first()
    file = TokenFile(first["path"])
    assert [len(file.doc(k)) for k in range(first["n_docs"])] == [w[2] for w in want[: first["n_docs"]]]
    assert write_token_files(docs.limit(0), params, token_file_folder(spark)).count() == 0


def test_pieces_equal_their_own_library(spark):
    import sentencepiece

    own, codec = sentencepiece.SentencePieceProcessor(model_file=PIECE), PieceCodec(PIECE)

    @given(st.lists(st.text(st.one_of(st.sampled_from(" \n▁aé\x01"), st.characters(exclude_categories=["Cs"])), max_size=30), min_size=1, max_size=6))
    @settings(max_examples=80, deadline=None)
    def check(texts):
        found = [(ids[a:b].tolist(), raw) for _, _, ids, s in codec.batches(pa.array(texts, pa.string())) for a, b, raw in zip(s[:-1], s[1:], codec.decode_bytes(ids, s), strict=True)]
        assert [f for f, _ in found] == own.encode(texts)
        assert [raw.decode() for _, raw in found] == own.decode([f for f, _ in found]) == codec.decode([f for f, _ in found])

    check()
    docs = spark.createDataFrame(list(enumerate(ODD)), SCHEMA).withColumn("n_tokens", F.lit(None).cast("int"))
    got = encode_documents(docs, PIECE, with_ids=True).collect()
    assert all(r["parity"] and r["round_trip"] for r in got) and len(got) == len(ODD)


def test_other_kinds_of_models():
    from tidewalk.llm.sentencepiece_backend import UNIGRAM, PieceModel

    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("▁ab", -1.0, 1), ("b", -2.5, 1)]
    model = PieceModel(pieces, kind=UNIGRAM, unk_id=0)
    ids = next(iter(PieceCodec(model=model).batches(pa.array([" ab a"]))))[2]
    assert [pieces[i][0] for i in ids] == ["▁ab", "▁", "a"]  # what the model's own library gives
    assert PieceModel(pieces + [("a▁b", 0.0, 1)]).splits_at_spaces() is False
    with pytest.raises(ValueError):
        PieceModel.parse(b"")


def test_fingerprints_are_sums_of_paragraphs():
    a, b = "one two three four\nfive six", "seven eight nine\n\nten"
    joined = FP.to_string(*FP.vectors([a + "\n" + b]))[0]
    parts = [FP.to_string(*FP.vectors([t]))[0] for t in (a, b)]
    assert FP.combine(*parts) == joined == FP.to_string(*FP.vectors([b + "\n" + a]))[0]
    assert FP.combine(joined, parts[1], take_away=True) == parts[0]
    assert FP.to_string(*FP.vectors(["x\ny"]))[0] != FP.to_string(*FP.vectors(["X\ny"]))[0]


def test_one_line_repeated_very_often_is_still_like_itself():
    line, other = "one two three\n", "four five six\n"
    texts = [line * 40_000, line * 30_000, line * 70_000, other * 40_000]
    a, b, c, d = (tuple(x[k : k + 1] for x in FP.vectors(texts)) for k in range(4))
    assert FP.likeness(a, b) == pytest.approx(1) and FP.likeness(a, c) == pytest.approx(1) and FP.likeness(a, d) < 0.3
    assert FP.combine(FP.to_string(*a)[0], FP.to_string(*b)[0]) != FP.to_string(*c)[0]  # the empty line at each end counts once more
    assert FP.of_string(FP.combine(FP.to_string(*a)[0], FP.to_string(*b)[0]))[1].tolist() == c[1][0].tolist()


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_edited_texts_and_likeness(spark, sf_dir, parts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-5, None), (-4, ""), (99_999, "ünï cödé"), (None, "abc defg hij")], SCHEMA))
    got = FP.fingerprint_documents(docs.repartition(4).withColumn("part", F.lit(9)), parts).collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    found = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for k, (doc, text) in enumerate(rows):
        following, q = rows[(k + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        r = found[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (sorted(text.split("\n")) == sorted(edited.split("\n")))
        assert 0 <= r["near_next"] <= 1
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1
    long = [r for r in got if r["n_chars"] > 1000]
    assert np.mean([r["near_edited"] for r in long]) > 0.6 > 0.2 > np.mean([r["near_next"] for r in long])
    one = FP.fingerprint_documents(spark.createDataFrame([(1, "abcdefgh")], SCHEMA)).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1
    assert FP.fingerprint_documents(docs.limit(0)).collect() == []
