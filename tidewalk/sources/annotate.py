"""Frames with their tracks' boxes drawn in, and a sink that mirrors the segments."""

from __future__ import annotations

import importlib
import os
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.sources.frames import load_decoder
from tidewalk.sources.segments import mirrored_path

COLOUR = 255
# Digits as rows of a 3 x 5 grid, each row's bits from the left.
_DIGITS = {"0": (7, 5, 5, 5, 7), "1": (2, 6, 2, 2, 7), "2": (7, 1, 7, 4, 7), "3": (7, 1, 7, 1, 7), "4": (5, 5, 7, 1, 1), "5": (7, 4, 7, 1, 7), "6": (7, 4, 7, 5, 7), "7": (7, 1, 1, 1, 1), "8": (7, 5, 7, 5, 7), "9": (7, 5, 7, 1, 7)}


def draw_boxes(frame: np.ndarray, boxes: list[tuple[float, float, float, float, int]], thick: int = 2) -> None:
    """Draw each box's outline and its track number above it, in place, as far as the frame reaches."""
    height, width = frame.shape[:2]
    for x1, y1, x2, y2, number in boxes:
        left, right = (int(np.clip(round(v), 0, width - 1)) for v in (x1, x2))
        top, bottom = (int(np.clip(round(v), 0, height - 1)) for v in (y1, y2))
        frame[top : top + thick, left : right + 1] = COLOUR
        frame[max(bottom - thick + 1, 0) : bottom + 1, left : right + 1] = COLOUR
        frame[top : bottom + 1, left : left + thick] = COLOUR
        frame[top : bottom + 1, max(right - thick + 1, 0) : right + 1] = COLOUR
        for k, digit in enumerate(str(number)):
            for row, bits in enumerate(_DIGITS.get(digit, ())):
                for column in range(3):
                    y, x = top - 7 + row, left + 4 * k + column
                    if bits >> (2 - column) & 1 and 0 <= y < height and x < width:
                        frame[y, x] = COLOUR


def annotated(frames: DataFrame, tracked: DataFrame) -> DataFrame:
    """The frames with ``pixels`` drawn over; frames without a track come back as they were."""
    boxes = tracked.groupBy("camera_id", "timestamp").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2", "track_id")).alias("boxes"))
    joined = frames.join(boxes, ["camera_id", "timestamp"], "left").select(*frames.columns, "boxes")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            drawn = []
            for r in part.itertuples():
                image = np.frombuffer(r.pixels, np.uint8).reshape(r.frame_height, r.frame_width, -1).copy()
                draw_boxes(image, [] if r.boxes is None else [(b["x1"], b["y1"], b["x2"], b["y2"], b["track_id"]) for b in r.boxes])
                drawn.append(image.tobytes())
            yield part.assign(pixels=drawn).drop(columns="boxes")

    return joined.mapInPandas(run, frames.schema)


def write_segments(frames: DataFrame, output_root: str, writer: str) -> None:
    """Write each segment's frames, in order, below ``output_root`` at its own relative path.

    ``writer`` (``module:function``) gets the path, the rate and the arrays; it should
    write beside the path and move there, so that a retried task leaves no half file.
    """

    def run(rows: Iterator) -> None:
        module, _, name = writer.partition(":")
        write = getattr(importlib.import_module(module), name)
        for (_, relpath), own in groupby(rows, key=lambda r: (r["camera_id"], r["relpath"])):
            first = next(own)

            def images(first=first, own=own):
                for r in (first, *own):
                    yield np.frombuffer(r["pixels"], np.uint8).reshape(r["frame_height"], r["frame_width"], -1)

            write(str(mirrored_path(output_root, relpath)), first["fps"], images())

    frames.repartition("camera_id", "relpath").sortWithinPartitions("camera_id", "relpath", "frame_id").foreachPartition(run)


def opencv_writer(path: str, fps: float, images: Iterator[np.ndarray]) -> None:
    """Write a video by OpenCV beside ``path`` and move it there; an empty one is an error."""
    import cv2

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    draft, video = f"{path}.{os.getpid()}{Path(path).suffix}", None
    try:
        for image in images:
            if video is None:
                video = cv2.VideoWriter(draft, cv2.VideoWriter_fourcc(*"mp4v"), fps, image.shape[1::-1])
                if not video.isOpened():
                    raise OSError(f"no video can be written to {draft}")
            video.write(image)
    finally:
        if video is not None:
            video.release()
    if video is None:
        raise ValueError(f"no frames for {path}")
    os.replace(draft, path)


def draw_segments(segments: DataFrame, tracked: DataFrame, output_root: str, decoder: str, writer: str) -> None:
    """Decode each segment again, draw its boxes in and write it below ``output_root``; segments without a box as well.

    ``segments`` has camera_id, path, relpath and start, ``tracked`` camera_id, frame_id,
    timestamp (on the same clock as ``start``), the boxes and track_id.  Only boxes are
    shuffled, never pixels: a segment is decoded and written by one task.  A box belongs
    to its camera's last segment that starts no later than the box's frame.  For
    ``writer`` see ``write_segments``.
    """
    box = ("x1", "y1", "x2", "y2", "track_id")
    listed = segments.groupBy("camera_id").agg(F.sort_array(F.collect_list(F.struct("start", "relpath", "path"))).alias("own"))
    own = F.element_at(F.filter("own", lambda one: one["start"] <= F.col("timestamp")), -1)
    boxes = tracked.join(listed, "camera_id").withColumn("segment", own).select("camera_id", "segment.relpath", "segment.path", "frame_id", *box)
    # Every segment comes, and first of all as a row without a frame.
    every = segments.select("camera_id", "relpath", "path", *[F.lit(None).cast(boxes.schema[c].dataType).alias(c) for c in ("frame_id", *box)])

    def run(rows: Iterator) -> None:
        decode, write = load_decoder(decoder), load_decoder(writer)
        for (_, relpath, path), rest in groupby(rows, key=lambda r: (r["camera_id"], r["relpath"], r["path"])):
            by_frame = groupby(rest, key=lambda r: r["frame_id"])
            next(by_frame)
            _, _, fps, frames = decode(path)

            def images(by_frame=by_frame, frames=frames):
                at, some = next(by_frame, (None, ()))
                for k, frame in enumerate(frames):
                    image = np.atleast_3d(frame).copy()
                    if at == k:
                        draw_boxes(image, [tuple(r[c] for c in box) for r in some])
                        at, some = next(by_frame, (None, ()))
                    yield image

            write(str(mirrored_path(output_root, relpath)), fps, images())

    boxes.unionByName(every).repartition("camera_id", "relpath").sortWithinPartitions("camera_id", "relpath", "path", F.col("frame_id").asc_nulls_first(), "track_id").foreachPartition(run)
