"""A corpus pipeline of four stages over ``documents``, each written as Parquet and read back.

The classifier rejects poor and toxic documents, the rules reject ill-formed ones, the
n-gram join leaves one document of each group of near copies (five-word shingles,
Jaccard 0.8), and packing lays what is left into windows of 2048 ids.

Every stage takes null and repeated ids, null, empty and very long texts, columns of any
name, and empty tables.  The classifier and the rules judge each row by its own text, a
null one counting as empty (the rules reject it).  The join leaves one row of each kept
id, the first by text and columns, and all rows with a null id.  Packing takes each row
as a document of its own.  No rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewalk.llm.common import Workspace, bound_batches, table
from tidewalk.llm.jaccard_join import JaccardParams, near_duplicate_representatives
from tidewalk.llm.packing import PackingParams, pack_documents
from tidewalk.llm.quality_classifier import keep_good_documents
from tidewalk.llm.quality_rules import keep_well_formed_documents
from tidewalk.llm.queries import label_grades, tokenizer_path
from tidewalk.session import ship_package


def _ready(spark: SparkSession) -> None:
    """The package's source on executors, Arrow batches bounded in bytes."""
    ship_package(spark)
    bound_batches(spark)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the labels, keeps."""
    _ready(spark)
    return keep_good_documents(docs, label_grades(spark, sf_dir))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep."""
    _ready(spark)
    return keep_well_formed_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-equal shingle sets link."""
    _ready(spark)
    return near_duplicate_representatives(docs, JaccardParams(words=5, percent=80))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 ids."""
    _ready(spark)
    return pack_documents(docs, PackingParams(tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack),
]

#: No SQL for the whole: fitted models and byte-pair encoding are beyond it; tests/llm hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written in the shared folder and read back."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            written = f"{k}-{name.replace(' ', '-')}"
            docs = work.table(docs, written)
            work.keep(written)
    return docs
