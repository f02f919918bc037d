"""Session helpers."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's source, once per application.

    Python functions that run on executors are pickled by reference, so the package must
    be importable there; on a cluster where it isn't installed this sends it along.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    folder = tempfile.mkdtemp(prefix="tidewalk-ship-")
    path = os.path.join(folder, "tidewalk_source.zip")
    Path(path).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
