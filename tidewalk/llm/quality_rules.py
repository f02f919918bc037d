"""Quality by weak supervision: rules that vote or abstain, weighed by how they agree.

Each rule looks at a text's form and votes good (+1), bad (-1) or nothing (0).  No rule
is taken at its word: expectation-maximisation over all documents estimates how often
each votes either way on good and on bad documents, and a document's posterior
probability of being good replaces an all-must-pass filter.  The documents enter the
estimate as counts of vote patterns, of which there are at most 3 ** rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewalk.llm.common import Workspace, map_arrow
from tidewalk.llm.shingles import chunks
from tidewalk.llm.text_stats import STATS, text_stats


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """The rules, on the columns of ``document_stats``; one without enough to go by abstains."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    enough = F.col("n_words") >= 20
    mean = F.col("word_chars") / words
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    return {
        "length": _vote(F.col("n_words") >= 50, F.col("n_words") < 10),
        "word_length": _vote(mean.between(3, 9), (mean < 2) | (mean > 20)),
        "symbols": _vote(enough & (F.col("n_symbols") / words < 0.02), F.col("n_symbols") / words > 0.1),
        "plain_words": _vote(enough & (F.col("n_plain_words") / words > 0.8), enough & (F.col("n_plain_words") / words < 0.6)),
        "repeated_lines": _vote((F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0), F.col("n_dup_lines") / lines > 0.3),
        "repeated_words": _vote(enough & (F.col("n_repeat_words") / words < 0.05), F.col("n_repeat_words") / words > 0.2),
        "function_words": _vote(enough & (F.col("n_common") / words > 0.08), enough & (F.col("n_common") / words < 0.02)),
        "shouting": _vote(enough & (F.col("n_upper") / letters < 0.15), enough & (F.col("n_upper") / letters > 0.5)),
        "loudness": _vote(enough & (F.col("n_loud") / words < 0.02), F.col("n_loud") / words > 0.2),
    }


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column("doc_id").cast(pa.int64())
        for i, j, data, ends in chunks(batch.column("text")):
            found = text_stats(data, ends)
            yield pa.RecordBatch.from_arrays([docs.slice(i, j - i), *(pa.array(found[s], pa.int64()) for s in STATS)], ["doc_id", *STATS])


def document_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of ``text_stats``; a null text has no words."""
    return map_arrow(docs.select("doc_id", "text"), _stats, "doc_id long, " + ", ".join(f"{s} long" for s in STATS))


@dataclass
class VoteModel:
    """Share of good documents, and for each class and rule how often it votes -1, 0, +1."""

    prior: float
    rates: np.ndarray  # (2 classes: bad, good; rules; 3 votes)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for each row of votes."""
        picked = np.log(self.rates)[:, np.arange(votes.shape[1])[None, :], votes + 1]
        # An abstention tells nothing: only votes that were cast count.
        logs = (picked * (votes != 0)[None]).sum(axis=2) + np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    @classmethod
    def fit(cls, votes: np.ndarray, counts: np.ndarray, steps: int = 100, tolerance: float = 1e-7) -> VoteModel:
        """EM from the weighted majority; ``counts`` weigh the rows of ``votes``."""
        total = votes.sum(axis=1)
        good = 1 / (1 + np.exp(-np.clip(total - 0.5 * votes.shape[1] * 0.5, -30, 30)))
        cast = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
        model = cls(0.5, np.zeros((2, votes.shape[1], 3)))
        for _ in range(steps):
            rates = []
            for share in (1 - good, good):
                seen = np.einsum("p,prv->rv", share * counts, cast) + 1.0
                voted = seen[:, [0, 2]].sum(axis=1, keepdims=True)
                rates.append(np.where(np.array([True, False, True])[None], seen / voted, 1.0))
            prior = float(np.clip((good * counts).sum() / max(counts.sum(), 1), 0.01, 0.99))
            model = cls(prior, np.stack(rates))
            now = model.posterior(votes)
            moved, good = np.abs(now - good).max(initial=0.0), now
            if moved < tolerance:
                break
        return model


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def fit_votes(voted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns of a table with ``votes``, and the posterior of each."""
    patterns = voted.groupBy("votes").agg(F.count("*").alias("docs")).collect()
    votes = np.array([p["votes"] for p in patterns], dtype=np.int64).reshape(len(patterns), len(rules()))
    model = VoteModel.fit(votes, np.array([p["docs"] for p in patterns], dtype=np.float64))
    return votes, model.posterior(votes)


def judge_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Each document's counts, votes' verdict and whether it stays.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at.  One row per
    row: the counts ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``; ``base_failed`` (fewer than 10 words, or over a fifth of the
    words in repeated windows); ``votes_good`` and ``votes_bad``; ``posterior``; and
    ``kept`` (the posterior reaches ``threshold`` and the base rules didn't fail).  A
    null text has no words and fails.  An empty table gives no rows.
    """
    stats = Workspace(docs.sparkSession, "rules").table(document_stats(docs), "stats")
    voted = stats.withColumn("votes", F.array(*rules().values()))
    votes, posterior = fit_votes(voted)
    known = docs.sparkSession.createDataFrame([(v.tolist(), float(p)) for v, p in zip(votes, posterior, strict=True)], "votes array<int>, posterior double")
    # At most 3 ** rules rows, whatever the input.
    judged = voted.join(F.broadcast(known), "votes", "left")
    count = {side: F.size(F.filter("votes", lambda v, s=sign: v == s)) for side, sign in (("votes_good", 1), ("votes_bad", -1))}
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = ~F.expr(BASE_FAILED) & (F.col("posterior") >= threshold)
    return judged.select(*columns, F.expr(BASE_FAILED).alias("base_failed"), *(c.alias(n) for n, c in count.items()), "posterior", kept.alias("kept"))


def _with_stats(carried: str):
    """Rows as they are, with the counts of their text in a struct column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [text_stats(data, ends) for _, _, data, ends in chunks(batch.column("text"))]
            if parts:
                counts = pa.StructArray.from_arrays([pa.array(np.concatenate([p[s] for p in parts]), pa.int64()) for s in STATS], list(STATS))
                yield batch.append_column(carried, counts)

    return run


def keep_well_formed_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, all columns as they were.

    Votes are counted in a first pass; the second recomputes each row's votes beside the
    row, so texts are neither shuffled nor joined.
    """
    voted = document_stats(docs).select(F.array(*rules().values()).alias("votes"))
    votes, posterior = fit_votes(voted)
    good = [tuple(v.tolist()) for v, p in zip(votes, posterior, strict=True) if p >= threshold]
    taken = {f.name.lower() for f in docs.schema.fields}
    carried = next(n for n in (f"form{k}" for k in range(len(taken) + 1)) if n not in taken)
    shape = T.StructType([*docs.schema.fields, T.StructField(carried, T.StructType([T.StructField(s, T.LongType()) for s in STATS]))])
    wide = map_arrow(docs, _with_stats(carried), shape)
    # The rules name the counts alone, so rows are wrapped while they are applied.
    rows = wide.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"), F.col(f"{carried}.*"))
    known = docs.sparkSession.createDataFrame([(list(g),) for g in good], "votes array<int>")
    kept = rows.where(f"not ({BASE_FAILED})").withColumn("votes", F.array(*rules().values())).join(F.broadcast(known), "votes", "left_semi")
    return kept.select("whole_row.*")
