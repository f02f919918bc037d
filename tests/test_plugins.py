"""Detection, annotation, the segment sink and the command line."""

from __future__ import annotations

import datetime

import numpy as np
import pytest

from tidewalk import cli
from tidewalk.config import ModelSettings
from tidewalk.operators.detector import detect, file_name, log_model, require_classes
from tidewalk.sources.annotate import annotated, draw_boxes, draw_segments, write_segments

FRAMES = "camera_id string, relpath string, frame_id long, timestamp timestamp_ntz, fps double, frame_height long, frame_width long, pixels binary"


class Model:
    names = {0: "head", 2: "person"}

    def predict(self, images):
        return [[[1, 1, 8, 8, 0.9, 2], [0, 0, 2, 2, 0.8, 0]] for _ in images]


def load(path):
    return Model()


def write_npy(path, fps, images):
    from pathlib import Path

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "wb") as f:
        np.save(f, np.stack(list(images)))


@pytest.fixture
def frames(spark):
    rows = [("cam", f"cam/{s}.mkv", k, datetime.datetime(2026, 5, 1, 9, s, k), 1.0, 10, 12, bytes(10 * 12)) for s in range(2) for k in range(3)]
    return spark.createDataFrame(rows, FRAMES)


def test_detection(frames, tmp_path):
    weights = tmp_path / "w.pt"
    settings = ModelSettings(model_path=str(weights), batch=2)
    with pytest.raises(FileNotFoundError):
        detect(frames, settings, f"{__name__}:load")
    weights.touch()
    got = detect(frames, settings, f"{__name__}:load").collect()
    assert len(got) == 6 and {(r["cls"], r["x2"]) for r in got} == {(2, 8.0)}
    with pytest.raises(ValueError, match="5"):
        require_classes(Model.names, [2, 5])
    require_classes(None, [5])


def test_boxes_are_drawn_within_the_frame():
    image = np.zeros((20, 20, 1), np.uint8)
    draw_boxes(image, [(3, 9, 12, 15, 7), (-5, -5, 40, 40, 12)], thick=1)
    assert image[9, 3:13].all() and image[9:16, 12].all() and not image[12, 6]
    assert image[2:7, 3:6].any()


def test_annotated_segments_mirror_their_paths(spark, frames, tmp_path):
    tracked = spark.createDataFrame([("cam", datetime.datetime(2026, 5, 1, 9, 0, 1), 1.0, 1.0, 8.0, 8.0, 3)], "camera_id string, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, track_id long")
    done = annotated(frames, tracked)
    assert done.columns == frames.columns
    write_segments(done, str(tmp_path), f"{__name__}:write_npy")
    first, second = (np.load(tmp_path / f"cam/{s}.mkv") for s in range(2))
    assert first.shape == (3, 10, 12, 1) and first[1].any() and not first[0].any() and not second.any()


def test_command_line(spark, tmp_path):
    with pytest.raises(ValueError, match="not set"):
        cli.run(spark, "zones", None)
    with pytest.raises(ValueError, match="no such stage"):
        cli.run(spark, "video")
    with pytest.raises(FileNotFoundError):
        cli.run(spark, "lines", None, input={"date": "2026-05-01", "bucket_dir": str(tmp_path / "none")})


class Walker:
    """A model that sees one person who walks right, and says where it was trained."""

    names = {2: "person"}
    metadata = {"train_args": {"model": "/home/somebody/base.pt", "data": "/data/floor.yaml"}, "version": "1", "date": "2026-01-01"}

    def predict(self, images):
        return [[[2, 8, 7, 14, 0.9, 2]] if image.any() else [] for image in images]


def load_walker(path):
    return Walker()


def lit_decoder(path):
    """Five frames; nobody is seen in the last two."""
    return 16, 12, 1.0, iter([np.full((16, 12, 1), 9 if k < 3 else 0, np.uint8) for k in range(5)])


def test_analyze_from_the_command_line(spark, tmp_path):
    folder = tmp_path / "bucket/loc_cam/2026/07/08"
    folder.mkdir(parents=True)
    for n in ("030000.000Z.mkv", "040000.000Z.mkv"):
        (folder / n).touch()
    (tmp_path / "w.pt").touch()
    (tmp_path / "bucket/camera_registry.yaml").write_text("bucket_name: bucket\nstorage: {}\ncameras: [{camera_id: cam, location: loc, ip: x}]\n")
    told = {"input": {"date": "2026-07-08", "bucket_dir": str(tmp_path / "bucket")}, "model": {"model_path": str(tmp_path / "w.pt"), "batch": 2}}
    with pytest.raises(ValueError, match="loader"):
        cli.run(spark, "analyze", None, **told)
    plugins = {"loader": f"{__name__}:load_walker", "decoder": f"{__name__}:lit_decoder", "writer": f"{__name__}:write_npy"}
    path = cli.run(spark, "analyze", None, str(tmp_path / "out"), **told, plugins=plugins, output={"save_video": True})
    rows = spark.read.parquet(path).collect()
    assert sorted((r["frame_id"], r["track_id"]) for r in rows) == [(0, 1)] * 2 + [(1, 1)] * 2 + [(2, 1)] * 2
    for n in ("030000.000Z.mkv", "040000.000Z.mkv"):
        drawn = np.load(tmp_path / "out/bucket/loc_cam/2026/07/08" / n) == 255
        assert drawn.any(axis=(1, 2, 3)).tolist() == [True] * 3 + [False] * 2


def test_segments_are_drawn_where_they_are_decoded(spark, tmp_path):
    at = datetime.datetime(2026, 5, 1, 9)
    later = at + datetime.timedelta(seconds=60)
    segments = spark.createDataFrame([("cam", "p0", "cam/0.mkv", at), ("cam", "p1", "cam/1.mkv", later), ("other", "p0", "other/0.mkv", at)], "camera_id string, path string, relpath string, start timestamp_ntz")
    boxes = [("cam", 1, at + datetime.timedelta(seconds=1), 1.0, 8.0, 6.0, 14.0, 3), ("cam", 1, at + datetime.timedelta(seconds=1), 2.0, 9.0, 7.0, 12.0, 4), ("cam", 0, later, 1.0, 8.0, 6.0, 14.0, 3)]
    tracked = spark.createDataFrame(boxes, "camera_id string, frame_id long, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, track_id long")
    draw_segments(segments, tracked, str(tmp_path), f"{__name__}:lit_decoder", f"{__name__}:write_npy")
    drawn = {k: (np.load(tmp_path / f"{k}.mkv") == 255).any(axis=(1, 2, 3)).tolist() for k in ("cam/0", "cam/1", "other/0")}
    assert drawn == {"cam/0": [False, True, False, False, False], "cam/1": [True, False, False, False, False], "other/0": [False] * 5}
    draw_segments(segments.limit(0), tracked.limit(0), str(tmp_path), f"{__name__}:lit_decoder", f"{__name__}:write_npy")


def test_a_model_tells_of_itself(capsys):
    log_model(Walker())
    said = capsys.readouterr().out
    assert "base.pt" in said and "floor.yaml" in said and "/home" not in said
    log_model(object())
    assert "no metadata" in capsys.readouterr().out
    assert (file_name("/a/b.pt"), file_name(""), file_name(None)) == ("b.pt", "", None)
