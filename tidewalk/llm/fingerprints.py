"""Document fingerprints by a homomorphic multiset hash.

A fingerprint is the sum of its paragraphs' vectors, so paragraphs can be added or taken
away in any order.  A paragraph's vector has two parts:

* ``DIGEST`` lanes modulo 2**64: the 256 bits of the paragraph's blake2b digest; they
  tell equal multisets of paragraphs from others.
* ``LANES`` wide lanes modulo 2**32: a feature hash of the paragraph, in which each of
  its word triples adds +1 or -1 to one lane.  Sums of these keep inner products, so the
  cosine of two fingerprints estimates how much of their word triples two documents
  share, to about 1 / sqrt(LANES).  (A hash of the paragraph as a whole would call an
  edited paragraph wholly unlike; texts of one paragraph would have no likeness at all.)

Paragraphs are the lines of a text; a line without words (white space alone) still
counts in the digest, and a triple that would cross the end of a line is none.  Lanes
wrap without a fault as long as no lane's true sum passes 2**31, which takes a text of
over two thousand million triples of one kind.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import map_arrow
from tidewalk.llm.shingles import mix, word_hashes

DIGEST, LANES = 4, 256
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _line_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """256 bits of each line's bytes, case and all, by blake2b, as ``DIGEST`` numbers, and the line's document."""
    raw = data.tobytes()
    out, owner, at = [], [], 0
    for k, end in enumerate(ends.tolist()):
        lines = raw[at:end].split(b"\n") if end > at else []
        out += [hashlib.blake2b(x, digest_size=8 * DIGEST).digest() for x in lines]
        owner += [k] * len(lines)
        at = end
    return np.frombuffer(b"".join(out), dtype="<u8").astype(np.uint64).reshape(-1, DIGEST), np.array(owner, dtype=np.int64)


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(digest lanes, wide lanes) of each text: the sums over its lines."""
    coded = [x.encode("utf-8", "surrogatepass") for x in texts]
    data = np.frombuffer(b"".join(coded), dtype=np.uint8)
    ends = np.cumsum([len(x) for x in coded], dtype=np.int64)
    n = len(texts)
    lines, owner = _line_hashes(data, ends)
    digest = np.zeros((n, DIGEST), np.uint64)
    cuts = np.searchsorted(owner, np.arange(n + 1))
    for k in range(DIGEST):
        sums = np.zeros(len(lines) + 1, np.uint64)
        np.cumsum(lines[:, k], out=sums[1:])
        digest[:, k] = sums[cuts[1:]] - sums[cuts[:-1]]
    wide = np.zeros((n, LANES), np.int64)
    if len(data):
        # Words by line: line ends count as ends of documents for the kernel.
        stops = np.flatnonzero(data == 10) + 1
        bounds = np.union1d(stops, ends[ends > 0])
        word, line = word_hashes(data, bounds)
        doc_of = np.searchsorted(ends, bounds, side="left")
        if len(word):
            per = np.bincount(line, minlength=len(bounds))
            begin = np.concatenate([[0], np.cumsum(per)])
            left = begin[line + 1] - np.arange(len(word))
            first = np.arange(len(word)) == begin[line]
            acc = np.zeros(len(word), np.uint64)
            for k in range(3):
                shifted = np.zeros(len(word), np.uint64)
                shifted[: max(0, len(word) - k)] = word[k:]
                acc = np.where(left > k, acc * _STEP + shifted, acc)
            keep = (left >= 3) | first
            h = mix(acc[keep])
            sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64)
            cell = doc_of[line[keep]] * LANES + (h & np.uint64(LANES - 1)).astype(np.int64)
            wide = np.bincount(cell, weights=sign, minlength=n * LANES).astype(np.int64).reshape(n, LANES)
    return digest, wide.astype(np.uint32)


def to_string(digest: np.ndarray, wide: np.ndarray) -> list[str]:
    packed = np.concatenate([digest.astype("<u8").view(np.uint8), wide.astype("<u4").view(np.uint8)], axis=1)
    return [base64.b64encode(x.tobytes()).decode() for x in packed]


def of_string(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(text)
    return np.frombuffer(raw[: 8 * DIGEST], "<u8").copy(), np.frombuffer(raw[8 * DIGEST :], "<u4").copy()


def combine(a: str, b: str, take_away: bool = False) -> str:
    """The fingerprint of both multisets of paragraphs together, or of the first without the second."""
    (da, wa), (db, wb) = of_string(a), of_string(b)
    digest, wide = (da - db, wa - wb) if take_away else (da + db, wa + wb)
    return to_string(digest[None], wide[None])[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1, row by row: 1 for equal fingerprints, else the wide lanes' cosine, at least 0."""
    x, y = (w.astype(np.int32).astype(np.float64) for _, w in (a, b))
    norm = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), norm, out=np.zeros(len(x)), where=norm > 0)
    equal = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(equal, 1.0, np.clip(cosine, 0.0, 1.0))


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
#: Code points of documents compared at once, but for a longer document.
_HELD = 1 << 20


def _rows(held: list[tuple[int | None, str]], following: str) -> pa.RecordBatch:
    """Rows of documents in order; ``following`` is the text after the last."""
    ids, texts = [d for d, _ in held], [t for _, t in held]
    after = [*texts[1:], following]
    quarter = [len(t) // 4 for t in texts]
    edited = [t[: len(t) - q] + f[:q] for t, q, f in zip(texts, quarter, after, strict=True)]
    own, changed = vectors([*texts, following]), vectors(edited)
    mine, behind = tuple(x[:-1] for x in own), tuple(x[1:] for x in own)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            pa.array(to_string(*mine)),
            pa.array(to_string(*changed)),
            pa.array(likeness(mine, changed)),
            pa.array(likeness(mine, behind)),
        ],
        _NAMES,
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents come in order, after them the one that follows the part, marked as not ``own``."""
    held: list[tuple[int | None, str]] = []
    size = 0
    for batch in batches:
        texts = batch.column("text")
        for doc, own, k in zip(batch.column("doc_id").to_pylist(), batch.column("own").to_pylist(), range(batch.num_rows), strict=True):
            text = texts[k].as_py() or ""
            if held and (size >= _HELD or len(held) >= 2000 or not own):
                yield _rows(held, text)
                held, size = [], 0
            if own:
                held.append((doc, text))
                size += len(text)
    if held:
        raise ValueError("the document after a part's last is missing")


def range_of(bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at or below ``doc_id`` (0 for null), found in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    runs = [bounds[k : k + step] for k in range(0, len(bounds), step)]

    def reached(edges: Column) -> Column:
        return F.size(F.filter(edges, lambda b: b <= F.col("doc_id")))

    longs = [F.array(*[F.lit(b).cast("long") for b in run]) for run in runs]
    run = reached(F.array(*[F.lit(r[0]).cast("long") for r in runs]))
    fine = (run - 1) * step + reached(F.element_at(F.array(*longs), F.greatest(run, F.lit(1))))
    return F.when(F.col("doc_id").isNull() | (run == 0), 0).otherwise(fine)


def fingerprint_documents(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of all documents and of edited ones, with likenesses to these and to the next document.

    ``docs`` has ``doc_id`` and ``text`` (null: empty); other columns are not looked at.
    Order is ascending ``doc_id``, nulls first, equal ids by text; after the last
    document comes the first.  The edited text is the text with its last quarter of code
    points (rounded down) replaced by the first as many, or all, of the next document.
    ``near_edited`` and ``near_next`` compare fingerprints (0 to 1).  An empty table
    gives no rows; a single document is its own next.

    The ids alone are split into ranges first; a range's first document is also sent to
    the range before it, so texts are shuffled once and each task sees what follows.
    """
    spark = docs.sparkSession
    parts = parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    bounds = ids.where("doc_id is not null").agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    bounds = sorted(set(bounds or []))
    part = range_of(bounds)
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"))
    firsts = ids.select(part.alias("part"), key.alias("key")).groupBy("part").agg(F.min("key").alias("key")).orderBy("part").collect()
    if not firsts:
        return spark.createDataFrame([], _SCHEMA)
    # At most one row per range: the id at its front, and the range before, which gets a copy (the last range for the first id).
    copies = spark.createDataFrame([(f["key"]["id"], firsts[k - 1]["part"]) for k, f in enumerate(firsts)], "id long, into int").groupBy("id").agg(F.collect_list("into").alias("into"))
    text = docs.select("doc_id", "text").join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("id")), "left")
    own = F.array(F.struct(part.cast("int").alias("part"), F.lit(True).alias("own")))
    lent = F.transform(F.coalesce("into", F.array().cast("array<int>")), lambda p: F.struct(p.alias("part"), F.lit(False).alias("own")))
    dealt = text.select("doc_id", "text", F.inline(F.concat(own, lent))).repartition("part")
    in_order = dealt.sortWithinPartitions("part", F.col("own").desc(), F.col("doc_id").asc_nulls_first(), "text")
    return map_arrow(in_order.select("doc_id", "own", "text"), _compare, _SCHEMA)
