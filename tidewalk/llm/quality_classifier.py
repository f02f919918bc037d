"""Quality by ordinal regression: one score from hashed text, ordered thresholds between grades.

The cumulative-link model says P(grade <= k) = sigmoid(threshold_k - score), where the
score is the sum of the weights of a document's distinct hashed features.  All grades
share the weights; thresholds ascend because their steps are exponentials.  It is fitted
on at most ``sample_rows`` labelled documents (those of the smallest hashed ids), on the
features that tell grades apart by more than chance.  Scoring reads whole texts of all
documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import map_arrow
from tidewalk.llm.shingles import chunks, find_words, mix, span_hashes
from tidewalk.llm.text_stats import text_stats

#: log2 of the number of weights.
BITS = 18


@dataclass(frozen=True)
class ClassifierParams:
    """``sample_rows`` bounds the labelled documents that are fitted on; ``min_docs`` of these must have a feature.

    A feature must stand out by ``screen`` standard deviations and by ``effect`` times
    the root of the number of documents fitted on, so that more rows don't let in
    weaker features.

    A document is kept if the probability of at least ``keep_grade`` reaches ``keep_at``.
    """

    sample_rows: int = 8_000
    min_docs: int = 5
    screen: float = 4.0
    effect: float = 0.075
    l2: float = 0.3
    steps: int = 400
    keep_grade: int = 2
    keep_at: float = 0.8


def _edges(*values: float) -> np.ndarray:
    return np.array(values)


# How the form of a text is binned; each bin is one hashed feature.
_BINS = {
    "n_symbols": _edges(0.01, 0.05, 0.1, 0.3),
    "n_plain_words": _edges(0.5, 0.6, 0.7, 0.8, 0.9),
    "n_dup_lines": _edges(0.05, 0.2, 0.4),
    "n_repeat_words": _edges(0.02, 0.1, 0.2, 0.5),
    "n_common": _edges(0.02, 0.08, 0.2),
    "n_loud": _edges(0.02, 0.1, 0.3),
    "n_upper": _edges(0.1, 0.3, 1.0, 3.0),
    "word_chars": _edges(2, 3, 4, 5, 6, 8, 12),
}
#: Longer words also count by their first so many bytes, so that a stem's forms share a weight.
PREFIXES = (4, 6)
_SIZES = _edges(0, 3, 10, 20, 50, 100, 300, 1000)


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells in a row, starts by document): each document's distinct features, ascending.

    Features are its words without case and marks, their beginnings, and bins of its form.
    """
    n = len(ends)
    stats = text_stats(data, ends)
    words = np.maximum(stats["n_words"], 1)
    cells, docs = [], []
    for k, (name, edges) in enumerate(_BINS.items()):
        below = np.maximum(stats["n_lower"], 1) if name == "n_upper" else np.maximum(stats["n_lines"], 1) if name == "n_dup_lines" else words
        cells.append(np.searchsorted(edges, stats[name] / below, side="right") + 16 * (k + 1))
        docs.append(np.arange(n))
    cells.append(np.searchsorted(_SIZES, stats["n_words"], side="left") + 16 * (len(_BINS) + 1))
    docs.append(np.arange(n))
    form = mix(np.concatenate(cells).astype(np.uint64))
    folded = strip_marks(data)
    found = find_words(folded, ends)
    hashes, owners = [form, found.hash], [*docs, found.doc]
    for k in PREFIXES:
        longer = found.stops - found.starts > k
        start = found.starts[longer]
        hashes.append(span_hashes(found.sums, start, start + k) ^ np.uint64(k))
        owners.append(found.doc[longer])
    hashes = np.concatenate(hashes)
    key = np.unique(np.concatenate(owners).astype(np.int64) << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return (key & ((1 << BITS) - 1)).astype(np.uint32), np.searchsorted(key >> BITS, np.arange(n + 1))


_MARKS = np.arange(256, dtype=np.uint8)
_MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


def strip_marks(data: np.ndarray) -> np.ndarray:
    """ASCII marks count as white space."""
    return _MARKS[data]


@dataclass
class OrdinalModel:
    """Weights by cell, and ascending thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k, by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))

    @classmethod
    def fit(cls, cells: np.ndarray, starts: np.ndarray, grades: np.ndarray, params: ClassifierParams) -> OrdinalModel:
        """Screen the features, then maximise the penalised likelihood by accelerated gradient steps.

        A feature passes if, for some threshold, the sum of the null model's residuals
        over its documents is far enough from 0 (see ``ClassifierParams``).
        """
        top, n = max(int(grades.max(initial=0)), params.keep_grade), len(grades)
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
        often = np.bincount(cells, minlength=1 << BITS)
        strength = np.zeros(1 << BITS)
        above = np.array([((grades > k).sum() + 0.5) / (n + 1) for k in range(top)])
        for k in range(top if n else 0):
            residual = (grades > k) - above[k]
            z = np.bincount(cells, weights=residual[row], minlength=1 << BITS) / np.sqrt(np.maximum(often * above[k] * (1 - above[k]), 1e-9))
            strength = np.maximum(strength, np.abs(z))
        used = np.flatnonzero((often >= params.min_docs) & (often < n) & (strength >= max(params.screen, params.effect * np.sqrt(n))))
        column = np.full(1 << BITS, -1, np.int32)
        column[used] = np.arange(len(used))
        kept = column[cells] >= 0
        row, col = row[kept], column[cells[kept]]

        # Thresholds start where the null model has them; the first is free, the others are log steps.
        base = np.log((1 - above) / above)
        cuts0 = np.maximum.accumulate(base + 1e-2 * np.arange(top))
        x = np.concatenate([np.zeros(len(used)), cuts0[:1], np.log(np.maximum(np.diff(cuts0), 1e-2))])
        # A diagonal bound of the curvature: each coordinate has a step of its own, long for rare features.
        per_row = np.bincount(row, minlength=n) + 1.0
        step = 1 / (0.5 * np.concatenate([np.bincount(col, weights=per_row[row], minlength=len(used)), np.full(top, per_row.sum())]) + params.l2)
        y, momentum, last = x.copy(), 1.0, np.inf
        for _ in range(params.steps if n else 0):
            loss, gradient = cls._loss(y, len(used), top, row, col, grades, params.l2)
            if loss > last:  # restart the momentum
                y, momentum, last = x.copy(), 1.0, np.inf
                continue
            last = loss
            after = y - step * gradient
            grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            y = after + (momentum - 1) / grown * (after - x)
            x, momentum = after, grown
        weights = np.zeros(1 << BITS, np.float32)
        weights[used] = x[: len(used)]
        return cls(weights, _cuts(x[len(used) :]))

    @staticmethod
    def _loss(x: np.ndarray, d: int, top: int, row: np.ndarray, col: np.ndarray, grades: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
        """Penalised negative log-likelihood and its gradient."""
        n, w, steps = len(grades), x[:d], x[d:]
        score = np.bincount(row, weights=w[col], minlength=n)
        z = 1 / (1 + np.exp(np.clip(score[:, None] - _cuts(steps)[None, :], -60, 60)))  # P(grade <= k)
        edge = np.concatenate([np.zeros((n, 1)), z, np.ones((n, 1))], axis=1)
        slope = np.concatenate([np.zeros((n, 1)), z * (1 - z), np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(edge[at, grades + 1] - edge[at, grades], 1e-12)
        upper, lower = slope[at, grades + 1] / p, slope[at, grades] / p
        by_cut = np.bincount(np.minimum(grades, top - 1), weights=np.where(grades < top, -upper, 0), minlength=top)
        by_cut = by_cut + np.bincount(np.maximum(grades - 1, 0), weights=np.where(grades > 0, lower, 0), minlength=top)[:top]
        tail = np.cumsum(by_cut[::-1])[::-1]
        by_step = tail * np.concatenate([[1.0], np.exp(steps[1:])])
        gradient = np.bincount(col, weights=(upper - lower)[row], minlength=d) + l2 * w
        return float(-np.log(p).sum() + 0.5 * l2 * (w * w).sum()), np.concatenate([gradient, by_step])


def _cuts(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, ends in chunks(batch.column("text")):
            cells, starts = features(data, ends)
            packed = [cells[a:b].astype("<u4").tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("grade").slice(i, j - i), pa.array(packed, pa.binary())], ["grade", "cells"])


def fit_classifier(docs: DataFrame, grades: DataFrame, params: ClassifierParams) -> OrdinalModel:
    """Fit on labelled documents: ``grades`` has ``doc_id`` and ``grade`` (0 and up; rows with nulls or negative grades are left out).

    At most ``sample_rows`` documents come to the driver, as hashed features.  Of several
    grades of an id the least counts, of several texts the smallest (null: empty).
    """
    usable = grades.select("doc_id", F.col("grade").cast("int").alias("grade")).where("doc_id is not null and grade >= 0")
    sample = usable.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample_rows)
    # At most sample_rows rows of two numbers.
    some = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    # Of rows that share an id the smallest text counts, so that the ids' bound is the rows' as well.
    some = some.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").alias("grade")).select("grade", "text")
    rows = map_arrow(some, _extract, "grade int, cells binary").collect()
    cells = [np.frombuffer(r["cells"], "<u4") for r in rows]
    starts = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int64)
    flat = np.concatenate(cells) if cells else np.zeros(0, np.uint32)
    return OrdinalModel.fit(flat, starts, np.array([r["grade"] for r in rows], dtype=np.int64), params)


def _score(model, keep_grade: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal: OrdinalModel = model.value
        for batch in batches:
            docs = batch.column("doc_id").cast(pa.int64())
            for i, j, data, ends in chunks(batch.column("text")):
                cells, starts = features(data, ends)
                sums = np.concatenate([[0.0], np.cumsum(ordinal.weights[cells], dtype=np.float64)])
                score = sums[starts[1:]] - sums[starts[:-1]]
                above = ordinal.at_least(score)
                yield pa.RecordBatch.from_arrays([docs.slice(i, j - i), pa.array(score), pa.array(above.sum(axis=1)), pa.array(above[:, keep_grade - 1])], ["doc_id", "score", "expected_grade", "tail"])

    return run


def grade_documents(docs: DataFrame, grades: DataFrame, params: ClassifierParams | None = None, model: OrdinalModel | None = None) -> DataFrame:
    """Score all documents: ``doc_id``, ``score``, ``expected_grade``, ``tail`` (probability of ``keep_grade`` or better), ``kept``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at.  One row per
    row; a null text is empty and is graded by that.  Without any usable label all
    weights are zero and every document gets the same grade.  An empty table gives no
    rows.
    """
    params = params or ClassifierParams()
    model = model or fit_classifier(docs, grades, params)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = map_arrow(docs.select("doc_id", "text"), _score(sent, params.keep_grade), "doc_id long, score double, expected_grade double, tail double")
    return scored.withColumn("kept", F.col("tail") >= params.keep_at)


def _filter(model, params: ClassifierParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal: OrdinalModel = model.value
        for batch in batches:
            keep = []
            for _, _, data, ends in chunks(batch.column("text")):
                cells, starts = features(data, ends)
                sums = np.concatenate([[0.0], np.cumsum(ordinal.weights[cells], dtype=np.float64)])
                keep.append(ordinal.at_least(sums[starts[1:]] - sums[starts[:-1]])[:, params.keep_grade - 1] >= params.keep_at)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return run


def keep_good_documents(docs: DataFrame, grades: DataFrame, params: ClassifierParams | None = None) -> DataFrame:
    """The rows of ``docs`` that ``grade_documents`` keeps, all columns as they were; nothing but the sample is shuffled.

    Rows are judged by their own text (null: empty), so null and repeated ids are kept or
    not like any other; without any usable label all rows have the same verdict; an
    empty table gives no rows.
    """
    params = params or ClassifierParams()
    sent = docs.sparkSession.sparkContext.broadcast(fit_classifier(docs, grades, params))
    return map_arrow(docs, _filter(sent, params), docs.schema)


def label_grade(quality: Column, toxic: Column) -> Column:
    """The graded rating of a pair of labels: 0 poor, 1 well written but toxic, 2 clean."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).when((quality == 1) & (toxic == 0), 2).cast("int")
