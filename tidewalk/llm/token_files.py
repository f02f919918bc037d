"""Binary files of token ids with Elias-Fano boundaries, written and read by executors.

A file is ``MAGIC | ids | sections | footer (JSON) | footer's length (uint32) | MAGIC``.
The ids of its documents stand in a row as unsigned 16- or 32-bit integers; two
Elias-Fano structures hold where each document ends and the documents' ids.  Ids are
written as they come, so a task holds no more than a batch and its boundaries.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.llm.common import Workspace, map_arrow
from tidewalk.llm.elias_fano import EliasFano
from tidewalk.llm.segments import crc32, library_encoder

MAGIC = b"TWTOKEF1"
#: Ids read from a file at once, but for a longer document.
READ_IDS = 1 << 20


@dataclass(frozen=True)
class TokenFileParams:
    """``files``: how many; by default as many as shuffle partitions.

    ``special_as_text``: strings of special tokens in a text are ordinary text, not these tokens.
    """

    tokenizer: str
    end_id: int = 1
    id_bytes: int = 2
    files: int | None = None
    special_as_text: bool = False


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path there; Hadoop's names of S3 are the store's own."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


class TokenFileWriter:
    """Writes one file under a name of its own and moves it to its place when it is whole."""

    def __init__(self, folder: str, name: str, id_bytes: int) -> None:
        self.fs, root = open_store(folder)
        self.fs.create_dir(root, recursive=True)
        self.place, self.draft = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.draft)
        self.out.write(MAGIC)
        self.kind = f"<u{id_bytes}"
        self.ends: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.nulls = self.n_ids = 0

    def add(self, docs: pa.Array, ids: np.ndarray, starts: np.ndarray) -> None:
        """``docs`` ascend, nulls before all others."""
        if len(ids) and int(ids.max()) >= 1 << (8 * np.dtype(self.kind).itemsize):
            raise ValueError(f"an id doesn't fit {self.kind}")
        self.out.write(ids.astype(self.kind).tobytes())
        self.ends.append(starts[1:] + self.n_ids)
        self.nulls += docs.null_count
        self.docs.append(docs.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        self.n_ids += len(ids)

    def close(self) -> tuple[int, int]:
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0, np.int64)
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int64)
        base = int(docs[0]) if len(docs) else 0
        footer: dict = {"n_docs": len(ends), "n_ids": self.n_ids, "id_kind": self.kind, "nulls": self.nulls, "base": base}
        at = len(MAGIC) + self.n_ids * np.dtype(self.kind).itemsize
        for name, coded in (("ends", EliasFano.encode(ends)), ("docs", EliasFano.encode(docs - base))):
            footer[name] = {"n": coded.n, "low_bits": coded.low_bits}
            for part, data in coded.parts().items():
                self.out.write(data)
                footer[name][part] = [at, len(data)]
                at += len(data)
        tail = json.dumps(footer).encode()
        self.out.write(tail + struct.pack("<I", len(tail)) + MAGIC)
        self.out.close()
        self.fs.move(self.draft, self.place)
        return len(ends), self.n_ids


class TokenFile:
    """A file read back; ``doc(i)`` gives one document's ids by two selects and one ranged read."""

    def __init__(self, path: str) -> None:
        store, place = open_store(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        length = struct.unpack("<I", tail[:4])[0]
        self.footer = json.loads(self.file.read_at(length, size - 12 - length))
        self.ends, self.docs = self._coded("ends"), self._coded("docs")
        self.kind = np.dtype(self.footer["id_kind"])

    def _coded(self, name: str) -> EliasFano:
        about = self.footer[name]
        return EliasFano.of_parts(about["n"], about["low_bits"], {p: self.file.read_at(about[p][1], about[p][0]) for p in ("low", "high", "samples")})

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * width, len(MAGIC) + start * width), self.kind)

    def doc(self, i: int) -> np.ndarray:
        return self.ids(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def bounds(self, i: int, j: int) -> np.ndarray:
        """Where documents i to j - 1 begin, and where the last of them ends."""
        before = [self.ends.select(i - 1)] if i else [0]
        return np.concatenate([before, self.ends.select_range(i, j)]).astype(np.int64)

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        """``doc_id`` of documents i to j - 1."""
        nulls = self.footer["nulls"]
        known = self.docs.select_range(max(i - nulls, 0), max(j - nulls, 0)) + self.footer["base"]
        return [None] * max(0, min(nulls, j) - i) + known.tolist()


def _write(params: TokenFileParams, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, out = library_encoder(params.tokenizer, params.special_as_text), TaskContext.get().partitionId(), None
        name = f"ids-{shard:06d}.bin"
        for batch in batches:
            docs = batch.column("doc_id").cast(pa.int64())
            for i, j, ids, starts in encoder.batches(batch.column("text")):
                out = out or TokenFileWriter(folder, name, params.id_bytes)
                # Each document's end id goes in after its own ids.
                with_end = np.insert(ids, starts[1:], np.uint32(params.end_id))
                out.add(docs.slice(i, j - i), with_end, starts + np.arange(len(starts)))
        if out:
            n_docs, n_ids = out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/{name}"], "n_docs": [n_docs], "n_ids": [n_ids]})

    return run


_SHARD = "shard long, path string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, params: TokenFileParams, folder: str) -> DataFrame:
    """Write the ids of all documents to ``folder``; returns one row per file: shard, path, n_docs, n_ids, first_id.

    Files follow each other in ascending ``doc_id`` (nulls first; equal ids by text),
    and so do documents in them; ``first_id`` is how many ids all files before have.  A
    null text is empty, the end id alone.  ``folder`` is a URI that executors share.  An
    empty table gives no files.
    """
    spark = docs.sparkSession
    files = params.files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", "text").repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    # One row per file; their number is set above, not by the data.
    shards = map_arrow(dealt, _write(params, folder), _SHARD, holds=True).collect()
    rows, before = [], 0
    for s in sorted(shards, key=lambda s: s["shard"]):
        rows.append((*s, before))
        before += s["n_ids"]
    return spark.createDataFrame(rows, f"{_SHARD}, first_id long")


#: Documents whose boundaries are selected at once.
READ_DOCS = 4096


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist(), strict=True):
            file = TokenFile(path)
            i = 0
            while i < file.footer["n_docs"]:
                at = file.bounds(i, min(i + READ_DOCS, file.footer["n_docs"]))
                # As many documents as READ_IDS allow, one at least.
                n = max(1, int(np.searchsorted(at, at[0] + READ_IDS, side="right")) - 1)
                at = at[: n + 1]
                ids = file.ids(int(at[0]), int(at[-1]))
                sums = [crc32(ids[a:b]) for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids(i, i + n), pa.int64()), pa.array(at[:-1] + first), pa.array(np.diff(at)), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                i += n


def read_token_files(shards: DataFrame) -> DataFrame:
    """What the files hold, by document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    Boundaries and ids of documents come from the files' select structures, some
    thousands at a time, so no file's table of offsets is ever unpacked as a whole.
    """
    return map_arrow(shards.select("path", "first_id"), _read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_folder(spark: SparkSession) -> str:
    return Workspace(spark, "ids").path
