"""Detection as a plug-in: a model is loaded where it runs and fed frames in batches."""

from __future__ import annotations

import importlib
from collections.abc import Iterator, Mapping
from pathlib import Path
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidewalk.config import ModelSettings
from tidewalk.log import JsonLog

log = JsonLog("detector")

BOXES = "camera_id string, frame_id long, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, score double, cls int, frame_width long, frame_height long"


def require_classes(names: dict[int, str] | None, wanted: list[int]) -> None:
    """Every wanted class must be one that the model knows; a model without names is taken at its word."""
    if names and (missing := [c for c in wanted if c not in names]):
        raise ValueError(f"model.classes {missing} aren't among the model's classes {names}")


def require_weights(path: str) -> None:
    """A loader must not go looking for other weights if these aren't there."""
    if not Path(path).exists():
        raise FileNotFoundError(f"no model weights at {path}")


def file_name(value: Any) -> Any:
    """A path's last part, so that logs don't tell where a model was trained; anything but a path as it is."""
    return Path(value).name if isinstance(value, str) and value else value


def log_model(model: Any) -> None:
    """Log what the model says of itself in ``names`` and in ``metadata``, a mapping with any of ``train_args``
    (``model`` and ``data``), ``version``, ``date`` and ``train_metrics``; a model that says nothing is no failure.
    """
    try:
        if names := getattr(model, "names", None):
            log.info("classes of the model", classes=names)
        told = getattr(model, "metadata", None)
        if not isinstance(told, Mapping):
            log.warning("the model has no metadata")
            return
        trained = told.get("train_args")
        origin = {"base_model": file_name(trained.get("model")), "dataset": file_name(trained.get("data"))} if isinstance(trained, Mapping) else {}
        log.info("the model's training", version=told.get("version"), date=told.get("date"), metrics=told.get("train_metrics"), **origin)
    except Exception as e:  # a log line isn't worth a failed day
        log.warning("the model's metadata can't be read", error=str(e))


def detect(frames: DataFrame, settings: ModelSettings, loader: str) -> DataFrame:
    """Boxes of all frames. ``loader`` (``module:function``) turns a weights path into a model with ``names`` and ``predict``.

    ``predict`` gets at most ``settings.batch`` arrays and gives, for each, rows of x1,
    y1, x2, y2, score, cls.
    """
    require_weights(settings.model_path)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = loader.partition(":")
        model = getattr(importlib.import_module(module), name)(settings.model_path)
        log_model(model)
        require_classes(getattr(model, "names", None), settings.classes)
        for part in parts:
            for at in range(0, len(part), settings.batch):
                some = part.iloc[at : at + settings.batch]
                images = [np.frombuffer(r.pixels, np.uint8).reshape(r.frame_height, r.frame_width, -1) for r in some.itertuples()]
                for r, boxes in zip(some.itertuples(), model.predict(images), strict=True):
                    boxes = np.asarray(boxes, dtype=float).reshape(-1, 6)
                    boxes = boxes[np.isin(boxes[:, 5], settings.classes)]
                    out = pd.DataFrame(boxes, columns=["x1", "y1", "x2", "y2", "score", "cls"]).astype({"cls": "int32"})
                    yield out.assign(camera_id=r.camera_id, frame_id=r.frame_id, timestamp=r.timestamp, frame_width=r.frame_width, frame_height=r.frame_height)[[c.split()[0] for c in BOXES.split(", ")]]

    return frames.mapInPandas(run, BOXES)
