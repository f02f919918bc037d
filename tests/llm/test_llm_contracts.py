"""Contracts at their edges: special tokens, other tokenizers, bounds, labels by brute force, the pipeline's stages."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tests.llm.test_llm_text import brute, shingles
from tidewalk.llm import common
from tidewalk.llm import fingerprints as FP
from tidewalk.llm.elias_fano import EliasFano
from tidewalk.llm.jaccard_join import JaccardParams, near_duplicate_representatives, ngram_jaccard_join
from tidewalk.llm.license_scan import KEY_PHRASES, TEMPLATES, scan_licenses, vocabulary
from tidewalk.llm.packing import PackingParams, pack_documents
from tidewalk.llm.quality_classifier import ClassifierParams, OrdinalModel, fit_classifier
from tidewalk.llm.segments import SegmentEncoder, WholeEncoder, cuts_at_space, library_encoder
from tidewalk.llm.token_files import TokenFileParams, read_token_files, token_file_folder, write_token_files

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SCHEMA = "doc_id long, text string"
SPECIAL = ["hi <|endoftext|> you", "<|endoftext|>", "a<|endoftext|>b", " <|startoftext|> <|endoftext|>\n", "<|endoftext|><|endoftext|> x", "<|endoftext", "|>"]


def ids_of(encoder, texts: list[str]) -> list[list[int]]:
    return [ids[a:b].tolist() for _, _, ids, s in encoder.batches(pa.array(texts, pa.string())) for a, b in zip(s[:-1], s[1:], strict=True)]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_tokens_are_what_the_library_makes_of_them(path, as_text):
    whole, encoder = Tokenizer.from_file(path), library_encoder(path, as_text)
    whole.encode_special_tokens = as_text
    assert isinstance(encoder, SegmentEncoder) and cuts_at_space(whole)

    @given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "\n", "a", "Word's", "\x01", "é", " "]), max_size=8).map("".join), max_size=5))
    @settings(max_examples=60, deadline=None)
    def check(texts):
        assert ids_of(encoder, texts) == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]

    check()
    assert ids_of(encoder, SPECIAL) == [e.ids for e in whole.encode_batch(SPECIAL, add_special_tokens=False)]


def test_tokenizers_that_join_words_get_whole_texts(tmp_path):
    vocab = {c: k for k, c in enumerate(["[unk]", "a", "b", " ", "a b", "a "])}
    loose = Tokenizer(models.BPE(vocab=vocab, merges=[("a", " "), ("a ", "b")], unk_token="[unk]"))
    edge = Tokenizer(models.BPE(vocab=vocab, merges=[("a", " "), ("a ", "b")], unk_token="[unk]"))
    edge.pre_tokenizer = pre_tokenizers.Metaspace()
    for k, made in enumerate((loose, edge)):
        path = str(tmp_path / f"{k}.json")
        made.save(path)
        assert not cuts_at_space(made) and isinstance(library_encoder(path), WholeEncoder)
        texts = ["a b a b", "", " a  b", "b a", None]
        assert ids_of(library_encoder(path), texts) == [e.ids for e in made.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_packing_and_files_by_the_plain_call(spark):
    rows = [(k, t) for k, t in enumerate(SPECIAL)] + [(0, "again"), (0, "again"), (None, "nobody"), (7, None), (8, "word <|endoftext|> " * 20_000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit("clash")).repartition(3)
    for path, frame, length in ((BYTE, pack_documents(docs, PackingParams(BYTE)), "length"), (WORD, read_token_files(write_token_files(docs, TokenFileParams(WORD, files=2), token_file_folder(spark))), "n_tokens")):
        tok = Tokenizer.from_file(path)
        got: dict = {}
        for r in frame.collect():
            got.setdefault(r["doc_id"], 0)
            got[r["doc_id"]] += r[length]
            if r["start"] == 0 and r["doc_id"] in range(1, 7) and path == BYTE:
                assert r["ids_crc32"] == zlib.crc32(np.array([*tok.encode(SPECIAL[r["doc_id"]], add_special_tokens=False).ids, 1], "<u4").tobytes())
        want: dict = {}
        for doc, text in rows:
            want[doc] = want.get(doc, 0) + len(tok.encode(text or "", add_special_tokens=False).ids) + 1
        assert got == want


@given(st.lists(st.integers(0, 1 << 30), min_size=1, max_size=3000), st.integers(0, 3000), st.integers(0, 3000))
@settings(max_examples=60, deadline=None)
def test_ranges_of_values_are_selected(values, i, j):
    values = sorted(values)
    coded = EliasFano.encode(np.array(values, np.int64))
    assert coded.select_range(i, j).tolist() == values[i:j]


def test_many_values_are_packed_in_parts():
    values = np.cumsum(np.random.default_rng(3).integers(0, 1 << 20, 50_001))
    coded = EliasFano.encode(values)
    assert (coded.decode() == values).all() and (coded.select_range(8190, 49_999) == values[8190:49_999]).all()


def test_a_fingerprints_lanes_are_independent():
    lines = [f"line {k} of words" for k in range(300)]
    digest, _ = FP.vectors(lines)
    assert len({tuple(d) for d in digest}) == 300 and all(len(set(digest[:, k])) == 300 for k in range(FP.DIGEST))
    bits = np.unpackbits(digest.astype("<u8").view(np.uint8), axis=1).astype(float)
    assert np.abs(np.corrcoef(bits.T) - np.eye(64 * FP.DIGEST)).max() < 0.35


def test_the_sample_bounds_rows_too(spark):
    repeated = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one labelled text").alias("text"))
    others = spark.range(2, 40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    grades = spark.range(1, 40).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("grade"))
    seen = []
    fit = OrdinalModel.fit.__func__
    try:
        OrdinalModel.fit = classmethod(lambda cls, cells, starts, given, params: seen.append(len(given)) or fit(cls, cells, starts, given, params))
        fit_classifier(repeated.unionByName(others), grades, ClassifierParams(sample_rows=20))
    finally:
        OrdinalModel.fit = classmethod(fit)
    assert seen and seen[0] <= 20


def test_the_fit_is_the_penalised_optimum():
    """Against plain gradient descent with exact line search on the same screened features."""
    rng = np.random.default_rng(7)
    n, d = 600, 12
    hot = rng.random((n, d)) < 0.3
    truth = rng.normal(0, 1.5, d)
    score = hot @ truth + rng.logistic(0, 1, n)
    grades = np.searchsorted([-0.5, 1.0], score)
    cells = np.concatenate([np.flatnonzero(h) for h in hot]).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(hot.sum(axis=1))])
    params = ClassifierParams(min_docs=1, screen=0.0, effect=0.0, steps=4000)
    model = OrdinalModel.fit(cells, starts, grades, params)

    def loss(w, cuts):
        z = 1 / (1 + np.exp(-(cuts[None, :] - (hot @ w)[:, None])))
        edge = np.concatenate([np.zeros((n, 1)), z, np.ones((n, 1))], axis=1)
        return -np.log(np.maximum(edge[np.arange(n), grades + 1] - edge[np.arange(n), grades], 1e-300)).sum() + 0.5 * params.l2 * (w * w).sum()

    x = np.concatenate([np.zeros(d), [-0.5, 0.5]])
    f = lambda v: loss(v[:d], v[d:])
    for _ in range(300):
        gradient = np.array([(f(x + 1e-5 * e) - f(x - 1e-5 * e)) / 2e-5 for e in np.eye(d + 2)])
        step = 0.1
        while f(x - step * gradient) > f(x) - 0.3 * step * gradient @ gradient and step > 1e-9:
            step /= 2
        x = x - step * gradient
    assert loss(model.weights[:d].astype(float), model.thresholds) == pytest.approx(f(x), rel=1e-4)
    assert model.weights[:d] == pytest.approx(x[:d], abs=0.03) and model.thresholds == pytest.approx(x[d:], abs=0.03)


def labels_by_brute_force(texts: list[str], coverage: float = 0.7) -> list[set[str]]:
    """The method's own labels: for every template and every offset, the weight of the words that stand there."""
    indexed = set(vocabulary())
    words = [re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.lower()) for t in texts]
    often = {w: sum(w in set(own) for own in words) for w in indexed}
    weight = {w: math.log(1 + (len(texts) + 1) / (often[w] + 0.5)) for w in indexed}
    out = []
    for own in words:
        said, found = f" {' '.join(own)} ", set()
        for label, templates in TEMPLATES.items():
            if not any(all(f" {p} " in said for p in way) for way in KEY_PHRASES[label]):
                continue
            for t in templates:
                parts = [(k, w) for k, w in enumerate(t.split()) if w in weight]
                whole = sum(weight[w] for _, w in parts)
                for offset in range(-len(t.split()), len(own)):
                    here = sum(weight[w] for k, w in parts if 0 <= offset + k < len(own) and own[offset + k] == w)
                    if here >= coverage * whole * (1 - 1e-12):
                        found.add(label)
        out.append(found)
    return out


def test_labels_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    every = [t for texts in TEMPLATES.values() for t in texts]
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            words = every[int(rng.integers(len(every)))].split()
            kind = rng.random()
            if kind < 0.4:  # words go, come or change
                words = [w if rng.random() > 0.15 else str(rng.choice(["x", "the", "license", "version"])) for w in words]
            elif kind < 0.6:
                words = words[: int(rng.integers(1, len(words) + 1))]
            elif kind < 0.7:
                rng.shuffle(words)
            parts.append(" ".join(words))
        texts.append(str(rng.choice(["\n", " and ", ". "])).join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) - set(filter(None, r["base_labels"].split(","))) for r in scan_licenses(docs).collect()}
    base = {r["doc_id"]: set(filter(None, r["base_labels"].split(","))) for r in scan_licenses(docs).collect()}
    for k, want in enumerate(labels_by_brute_force(texts)):
        assert got[k] == want - base[k], texts[k]


def test_links_at_sizes_where_few_are_possible(spark):
    """Sets of 4 to 30 shingles that differ in one or two, where the bounds that spare small sets are tight."""
    rng = np.random.default_rng(2)
    docs = []
    for size in range(1, 31):
        words = [f"s{size}w{k}" for k in range(size)]
        for change in ([], [0], [size - 1], [0, size // 2]):
            docs.append((len(docs), " ".join(w if k not in change else f"n{len(docs)}" for k, w in enumerate(words))))
        docs.append((len(docs), " ".join(words + ["more"])))
        docs.append((len(docs), " ".join(words[1:]) or "x"))
    rng.shuffle(docs)
    docs = [(int(d), str(t)) for d, t in docs]
    frame = spark.createDataFrame(docs, SCHEMA)
    for n, percent in ((1, 80), (2, 50)):
        got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard_join(frame, JaccardParams(words=n, percent=percent)).collect()}
        assert got == brute(docs, n, percent), (n, percent)


def test_hot_keys_are_split(spark, monkeypatch):
    """With a lower bound of hotness, so that the paths for hot shingles, groups and classes are gone through."""
    from tidewalk.llm import jaccard_join

    monkeypatch.setattr(common, "HOT", 20)
    monkeypatch.setattr(jaccard_join, "HOT", 20)
    rng = np.random.default_rng(9)
    docs = [(k, "same text here again and again") for k in range(40)] + [(100 + k, f"shared passage of seven words stands here {rng.integers(4)} {rng.integers(4)} x{rng.integers(3)}") for k in range(120)]
    docs += [(400 + k, " ".join(f"w{x}" for x in rng.choice(30, 12, replace=False))) for k in range(60)]
    frame = spark.createDataFrame(docs, SCHEMA)
    for n, percent in ((3, 60),):
        got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard_join(frame, JaccardParams(words=n, percent=percent)).collect()}
        assert got == brute(docs, n, percent)


def test_a_cluster_must_name_its_shared_folder():
    def session(master: str, named: str | None):
        conf = type("Conf", (), {"get": lambda self, key, default: named})()
        return type("Session", (), {"conf": conf, "sparkContext": type("Context", (), {"master": master, "applicationId": "app-1"})})()

    assert common.shared_folder(session("local[4]", None)).startswith("file://")
    assert common.shared_folder(session("spark://host:7077", "hdfs://shared/")) == "hdfs://shared"
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            common.shared_folder(session(master, None))


def test_operators_leave_the_session_as_it_is(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    ngram_jaccard_join(spark.createDataFrame([(1, "a b c")], SCHEMA)).collect()
    assert spark.conf.get(key) == before


def test_every_stage_takes_odd_rows(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(None, None), (-1, None), (-2, ""), (-2, ""), (None, "a b"), (-3, "word " * 60_000), (-4, " \n\t")]
    odd = spark.createDataFrame(extra, SCHEMA)
    columns = [F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns]
    docs = base.limit(60).unionByName(odd.select(*columns)).withColumn("votes", F.lit("clash")).withColumn("cells", F.lit(1)).withColumn("n", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns, name
        assert after.exceptAll(docs).count() == 0, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.where("doc_id is null").agg(F.sum("length")).first()[0] == 1 + 3
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_the_pipelines_near_copies_are_all_caught(spark):
    """Recall at the stage's own threshold, five words and 0.8: every pair that reaches it is in one class."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs, 5, 80)
    kept = near_duplicate_representatives(spark.createDataFrame(docs, SCHEMA), JaccardParams(words=5, percent=80))
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())
    assert any(a != b for a, b in want.items()) and shingles("a b", 5)
