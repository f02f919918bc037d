"""Packing of documents into fixed training windows with a bounded number of open ones.

Each task encodes its documents and keeps at most ``open_windows`` windows.  A
document's whole windows are cut off its front; what remains goes into the open window
that it fills best, and where it fits in none and all are open, the fullest is emitted.
Windows still open at a task's end are merged: those of ``merge_tasks`` neighbouring
tasks are packed again by piece, largest first.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import Workspace, map_arrow
from tidewalk.llm.segments import crc32, library_encoder


@dataclass(frozen=True)
class PackingParams:
    """``tokenizer`` is a file's path; every document ends with ``end_id``; ``with_ids`` also returns the pieces' ids.

    ``special_as_text``: strings of special tokens in a text are ordinary text, not these tokens.
    """

    tokenizer: str
    window: int = 2048
    end_id: int = 1
    open_windows: int = 256
    merge_tasks: int = 4
    with_ids: bool = False
    special_as_text: bool = False


@dataclass
class _Piece:
    doc_id: int | None
    start: int
    length: int
    crc: int
    doc_tokens: int
    ids: bytes | None


class OpenWindows:
    """At most ``limit`` open windows of ``size``; ``add`` gives the windows that it closes.

    >>> w = OpenWindows(size=10, limit=1)
    >>> [w.add("a", 6), w.add("b", 4), w.add("c", 3), w.add("d", 9), w.rest()]
    [[], [['a', 'b']], [], [['c']], [['d']]]
    """

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.room: list[tuple[int, int]] = []  # (room left, key), ascending
        self.held: dict[int, list] = {}
        self.next = 0

    def add(self, piece, length: int) -> list[list]:
        closed = []
        k = bisect_left(self.room, (length, -1))
        if k < len(self.room):
            room, key = self.room.pop(k)
        else:
            if len(self.room) >= self.limit:
                closed.append(self.held.pop(self.room.pop(0)[1]))
            room, key = self.size, self.next
            self.next += 1
            self.held[key] = []
        self.held[key].append(piece)
        if room == length:
            closed.append(self.held.pop(key))
        else:
            insort(self.room, (room - length, key))
        return closed

    def rest(self) -> list[list]:
        left = [self.held[key] for _, key in self.room]
        self.room, self.held = [], {}
        return left


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, task long, window long, offset long, open boolean"
_TYPES = [pa.int64()] * 5 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_()]
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


class _Rows:
    """Rows of windows, column by column."""

    def __init__(self, task: int, first: int = 0) -> None:
        self.task, self.window = task, first
        self.columns: list[list] = [[] for _ in _NAMES]

    def put(self, window: list[_Piece], is_open: bool) -> None:
        offset = 0
        for p in window:
            for column, x in zip(self.columns, (p.doc_id, p.start, p.length, p.crc, p.doc_tokens, p.ids, self.task, self.window, offset, is_open), strict=True):
                column.append(x)
            offset += p.length
        self.window += 1

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.columns, _TYPES, strict=True)], _NAMES)
        self.columns = [[] for _ in _NAMES]
        return batch


def _pack(params: PackingParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(params.tokenizer, params.special_as_text)
        windows, rows = OpenWindows(params.window, params.open_windows), _Rows(TaskContext.get().partitionId())
        end = np.array([params.end_id], np.uint32)
        for batch in batches:
            docs = batch.column("doc_id").cast(pa.int64())
            for i, j, ids, starts in encoder.batches(batch.column("text")):
                for doc, a, b in zip(docs.slice(i, j - i).to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    own = np.concatenate([ids[a:b], end])
                    for at in range(0, len(own), params.window):
                        part = own[at : at + params.window]
                        piece = _Piece(doc, at, len(part), crc32(part), len(own), part.astype("<u4").tobytes() if params.with_ids else None)
                        for closed in [[piece]] if len(part) == params.window else windows.add(piece, len(part)):
                            rows.put(closed, False)
                if len(rows.columns[0]) >= 4096 or params.with_ids:
                    yield rows.take()
        for left in windows.rest():
            rows.put(left, True)
        yield rows.take()

    return run


def _merge(params: PackingParams):
    """Best fit, largest first: no limit on open windows, since the input is a bounded number of windows."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table) -> pa.Table:
        group = key[0].as_py()
        order = left.sort_by([("length", "descending"), ("task", "ascending"), ("window", "ascending"), ("offset", "ascending")])
        rows, windows = _Rows(group), OpenWindows(params.window, left.num_rows)
        for doc, start, length, crc, total, ids in zip(*(order.column(n).to_pylist() for n in _NAMES[:6]), strict=True):
            for closed in windows.add(_Piece(doc, start, length, crc, total, ids), length):
                rows.put(closed, True)
        for last in windows.rest():
            rows.put(last, True)
        return pa.Table.from_batches([rows.take()])

    return run


def pack_documents(docs: DataFrame, params: PackingParams) -> DataFrame:
    """Pieces of documents placed in windows of ``params.window`` ids.

    ``docs`` has ``doc_id`` and ``text``; other columns are not looked at.  A null text
    is empty: its document is the end id alone.  Null and repeated ``doc_id`` are kept,
    each row being a document of its own.  One row per piece: ``doc_id``, ``start`` (ids
    of its document before it), ``length``, ``ids_crc32`` (of its ids as little-endian
    unsigned 32-bit integers), ``doc_tokens``, ``sequence_id``, ``offset`` (gapless from
    0) and, if asked for, ``ids`` (those bytes).  An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "packing")
    placed = work.table(map_arrow(docs.select("doc_id", "text"), _pack(params), _SCHEMA, holds=True), "placed")
    done = placed.where("not open").withColumn("sequence_id", F.shiftleft("task", 32) + F.col("window"))
    left = placed.where("open").groupBy(F.expr(f"task div {params.merge_tasks}").alias("near")).applyInArrow(_merge(params), _SCHEMA)
    left = left.withColumn("sequence_id", F.shiftleft(F.col("task") + (1 << 30), 32) + F.col("window"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * params.with_ids
    return done.select(columns).unionByName(left.select(columns))
