"""Video frames as a Python data source: one partition per camera and day, decoded where it runs.

Decoding needs a decoder: a function from a path to (height, width, fps, frames), where
frames yields arrays.  OpenCV is used where it is installed; tests bring their own.
"""

from __future__ import annotations

import datetime
import importlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


DEFAULT_DECODER = f"{__name__}:opencv_decoder"


@dataclass
class CameraDay(InputPartition):
    camera_id: str
    segments: list  # (path, relpath, start)


def opencv_decoder(path: str):
    """(height, width, fps, frames) of a video file by OpenCV."""
    import cv2

    video = cv2.VideoCapture(path)
    ok, first = video.read() if video.isOpened() else (False, None)
    if not ok:
        video.release()
        raise ValueError(f"no frame can be read from {path}")

    def frames() -> Iterator:
        frame, more = first, True
        while more:
            yield frame
            more, frame = video.read()
        video.release()

    return (*first.shape[:2], float(video.get(cv2.CAP_PROP_FPS)), frames())


def load_decoder(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


class FrameReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        import json

        self.decoder = options.get("decoder", DEFAULT_DECODER)
        self.with_pixels = options.get("pixels", "true") == "true"
        self.days = [CameraDay(d["camera_id"], [tuple(s) for s in d["segments"]]) for d in json.loads(options["days"])]

    def partitions(self) -> list[CameraDay]:
        return self.days

    def read(self, partition: CameraDay) -> Iterator[tuple]:
        decode, shape = load_decoder(self.decoder), None
        for path, relpath, start in partition.segments:
            began = datetime.datetime.fromisoformat(start)
            height, width, fps, frames = decode(path)
            if shape not in (None, (height, width)):
                raise ValueError(f"{partition.camera_id} changes resolution in {path}: {shape} to {(height, width)}")
            shape = (height, width)
            for k, frame in enumerate(frames):
                pixels = bytes(memoryview(frame)) if self.with_pixels else None
                yield (partition.camera_id, relpath, k, began + datetime.timedelta(seconds=k / fps), fps, height, width, pixels)


class FrameSource(DataSource):
    """``spark.read.format("camera_frames")`` with ``days`` (JSON: camera_id, segments of path, relpath, start)."""

    @classmethod
    def name(cls) -> str:
        return "camera_frames"

    def schema(self) -> str:
        return "camera_id string, relpath string, frame_id bigint, timestamp timestamp_ntz, fps double, frame_height bigint, frame_width bigint, pixels binary"

    def reader(self, schema) -> FrameReader:
        return FrameReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameSource)


def frame_shape(path: str, decoder=opencv_decoder) -> tuple[int, int]:
    """(height, width) of a segment's first frame."""
    height, width, _, _ = decoder(path)
    return height, width
