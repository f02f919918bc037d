"""Parquet tables at a path, published whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def _aside(spark: SparkSession, path: str) -> list:
    """Tables that a publication has put aside and not removed."""
    fs, where = _fs(spark, path)
    return [f.getPath() for f in fs.globStatus(_fs(spark, f"{path}.old-*")[1]) or []] if fs.exists(where.getParent()) else []


def recover(spark: SparkSession, path: str) -> None:
    """Undo a publication that was cut off between its two moves: the table before comes back."""
    fs, where = _fs(spark, path)
    for old in _aside(spark, path):
        if fs.exists(where):
            fs.delete(old, True)
        else:
            fs.rename(old, where)


def read(spark: SparkSession, path: str, missing: str) -> DataFrame:
    """The table; its absence is an error that says what to do."""
    if not exists(spark, path):
        recover(spark, path)
    if not exists(spark, path):
        raise FileNotFoundError(missing)
    return spark.read.parquet(str(path))


def publish(frame: DataFrame, path: str, schema: StructType | None = None) -> None:
    """Write beside ``path``, put the old table aside, move the new one there, remove the old one.

    A failure at any point leaves the table before or the table after; where it falls
    between the moves, ``read`` and the next ``publish`` bring the table before back.
    ``schema`` puts columns in contract order and types; an empty table still has one
    file that says the schema.
    """
    spark = frame.sparkSession
    if schema is not None:
        frame = frame.select(*[frame[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    mark = uuid.uuid4().hex
    draft, aside = f"{path}.tmp-{mark}", f"{path}.old-{mark}"
    try:
        frame.write.option("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS").parquet(draft)
        recover(spark, path)
        fs, place = _fs(spark, path)
        old = _fs(spark, aside)[1]
        if fs.exists(place) and not fs.rename(place, old):
            raise OSError(f"can't move {path} aside")
        if not fs.rename(_fs(spark, draft)[1], place):
            raise OSError(f"can't move {draft} to {path}")
        fs.delete(old, True)
    except BaseException:
        recover(spark, path)
        remove(spark, draft)
        raise


def is_empty(frame: DataFrame) -> bool:
    return frame.isEmpty()
