"""Working tables and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver share: ``spark.checkpoint.dir``.

    Where that is unset, a folder of this machine serves in local mode, where there is
    but one; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tidewalk-")
    return _OWN[app]


class Workspace:
    """Tables written once and read back, in a folder of their own below the shared one.

    A written table cuts the lineage and outlives the executors that wrote it, so a lost
    executor never recomputes what lies before it.  What a returned plan still reads
    stays until the application ends; the rest can be dropped before.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.names = spark, set()
        self.path = f"{shared_folder(spark)}/tidewalk-{label}-{uuid.uuid4().hex}"
        fs, where = self._place()
        fs.mkdirs(where)
        fs.deleteOnExit(where)

    def _place(self, name: str = ""):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def table(self, frame: DataFrame, name: str) -> DataFrame:
        where = f"{self.path}/{name}"
        frame.write.mode("overwrite").parquet(where)
        self.names.add(name)
        return self.spark.read.schema(as_nullable(frame.schema)).parquet(where)

    def drop(self, *names: str) -> None:
        """Remove tables that no returned plan reads."""
        for name in names:
            fs, where = self._place(name)
            fs.delete(where, True)
            self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Remove all tables but these."""
        self.drop(*sorted(self.names - {*names}))


#: A key that has more than one of so many rows is hot; there can't be more hot keys than this.
HOT = 4096


def join_by_key(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """Inner join with a written table of one row per key that says in ``rows`` how many rows ``left`` has of it, of ``total``.

    Keys that hold more than one in ``HOT`` of all rows are fewer than ``HOT``, so they are
    broadcast and their rows stay where they are; the others are shuffled, and none of
    them fills a task.
    """
    hot = right.where(F.col(rows) * HOT > total)
    if hot.isEmpty():
        return left.join(right, keys)
    cold = left.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(right.where(F.col(rows) * HOT <= total), keys)
    return left.join(F.broadcast(hot), keys).unionByName(cold)


#: Bytes of rows that go to Python at once; texts may be long, and both sides hold a batch whole.
ARROW_BYTES = 2 << 20


#: What a Python worker holds from one task to the next of the same operator.
HELD: list[dict] = []


def map_arrow(frame: DataFrame, function: Callable, schema: str, holds: bool = False) -> DataFrame:
    """``mapInArrow`` with batches of the session's size (see ``bound_batches``).

    A worker outlives its tasks; one that is given a function which doesn't ``hold``
    anything first drops what others have left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in [] if holds else HELD:
            held.clear()
        yield from function(batches)
        release_memory()

    return frame.mapInArrow(run, schema)


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker outlives its task, and its allocators keep what they had."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in bytes where the session has Spark's own default.

    It changes the session, so the queries and the pipeline call it, never an operator.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, str(ARROW_BYTES))


def as_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also change other letters)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
