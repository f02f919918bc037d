"""The tracker, the frame source and the streaming events."""

from __future__ import annotations

import datetime
import itertools

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from tidewalk.config import TrackerSettings
from tidewalk.operators.tracker import CameraTracker, assign, overlap, track_detections
from tidewalk.plans import daily
from tidewalk.registry import Line, Zone
from tidewalk.streaming import events


def test_overlap():
    got = overlap(np.array([[0, 0, 2, 2.0]]), np.array([[1, 1, 3, 3.0], [5, 5, 6, 6]]))
    assert got[0].tolist() == pytest.approx([1 / 7, 0])


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (2, 4), (5, 3)])
def test_assignment_is_the_cheapest(shape):
    rng = np.random.default_rng(2)
    for _ in range(20):
        cost = rng.uniform(0, 1, shape)
        got = assign(cost, 10.0)
        best = min(sum(cost[r, c] for r, c in zip(range(shape[0]), p, strict=True)) if shape[0] <= shape[1] else sum(cost[r, c] for c, r in enumerate(p)) for p in itertools.permutations(range(max(shape)), min(shape)))
        assert sum(cost[r, c] for r, c in got) == pytest.approx(best)
        assert len(got) == min(shape)


def test_no_pair_over_the_limit():
    assert assign(np.array([[0.9]]), 0.5) == []


def test_walkers_keep_their_numbers():
    tracker = CameraTracker(TrackerSettings())
    seen = [tracker.update(np.array([[k * 4.0, 0, k * 4.0 + 50, 100], [400 - k * 4.0, 300, 450 - k * 4.0, 400]]), np.array([0.9, 0.8])).tolist() for k in range(20)]
    assert all(s == [1, 2] for s in seen)


def test_faint_boxes_keep_a_track_alive_but_begin_none():
    tracker = CameraTracker(TrackerSettings())
    box = np.array([[0, 0, 50, 100.0]])
    assert tracker.update(box, np.array([0.3])).tolist() == [0]
    tracker = CameraTracker(TrackerSettings())
    assert [tracker.update(box, np.array([s])).tolist() for s in (0.9, 0.3, 0.9)] == [[1], [1], [1]]


def test_cameras_are_tracked_apart(spark):
    rows = [(cam, k, datetime.datetime(2026, 5, 1, 9, 0, k), 0.0 + k, 0.0, 50.0 + k, 100.0, 0.9, 1920, 1080, 2) for cam in ("a", "b") for k in range(10)]
    rows.append(("a", 10, datetime.datetime(2026, 5, 1, 9, 0, 10), 0.0, 0.0, 5.0, 5.0, 0.9, 1920, 1080, 7))
    boxes = spark.createDataFrame(rows, "camera_id string, frame_id long, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, score double, frame_width long, frame_height long, cls int")
    got = track_detections(boxes, TrackerSettings(), [2]).groupBy("camera_id", "track_id").count().collect()
    assert {tuple(r) for r in got} == {("a", 1, 10), ("b", 1, 10)}


def test_frames_without_a_box_age_tracks():
    rng, box, none = np.random.default_rng(5), np.array([[0, 0, 50, 100.0]]), np.zeros((0, 4))
    for gap, same in ((30, True), (31, False), (500, False)):
        tracker = CameraTracker(TrackerSettings())
        tracker.update(box, np.array([0.9]))
        tracker.skip(gap)
        assert bool(tracker.update(box, np.array([0.9]))[0] == 1) is same
    one, other = CameraTracker(TrackerSettings()), CameraTracker(TrackerSettings())
    for _ in range(60):
        gap, boxes = int(rng.integers(0, 40)), np.sort(rng.uniform(0, 100, (3, 2, 2)), axis=1).reshape(3, 4)
        for _ in range(gap):
            one.update(none, np.zeros(0))
        other.skip(gap)
        scores = rng.uniform(0, 1, 3)
        assert one.update(boxes, scores).tolist() == other.update(boxes, scores).tolist()


def test_empty_frames_come_with_the_detections(spark):
    start = datetime.datetime(2026, 5, 1, 9)
    # Somebody leaves at frame 9 and another one comes to the same place 100 frames later; camera b has no gap.
    seen = {"a": [*range(10), *range(110, 120)], "b": [*range(20)]}
    rows = [(cam, k, start + datetime.timedelta(seconds=k), 0.0, 0.0, 50.0, 100.0, 0.3 if k % 5 == 4 else 0.9, 1920, 1080, 2) for cam, own in seen.items() for k in own]
    rows.append(("a", 50, start + datetime.timedelta(seconds=50), 0.0, 0.0, 50.0, 100.0, 0.9, 1920, 1080, 7))  # another class
    boxes = spark.createDataFrame(rows, "camera_id string, frame_id long, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, score double, frame_width long, frame_height long, cls int")
    every = spark.createDataFrame([(cam, k, start + datetime.timedelta(seconds=k)) for cam, n in (("a", 120), ("b", 20)) for k in range(n)], "camera_id string, frame_id long, timestamp timestamp_ntz")
    got = track_detections(boxes, TrackerSettings(), [2], every)
    assert got.columns == track_detections(boxes, TrackerSettings(), [2]).columns and got.where("frame_width is null or score is null").count() == 0
    assert {tuple(r) for r in got.groupBy("camera_id", "track_id").count().collect()} == {("a", 1, 10), ("a", 2, 10), ("b", 1, 20)}


def test_the_query_has_empty_frames_and_faint_boxes(spark, sf_dir):
    from tidewalk.plans import registry

    # A walk ends at each pause and, at x 0, at each turn: nobody is met again after 40 empty frames.
    got = registry.QUERIES["byte_track"](spark, sf_dir).toPandas()
    assert got["frames"].max() <= 50 and (got["frames"] > 40).any()


class PlainTracker:
    """The method in whole matrices of eight states, with pairs found by trying all."""

    def __init__(self, s):
        self.s, self.frame, self.tracks, self.next = s, 0, [], 1
        self.step = np.eye(8) + np.eye(8, k=4)

    @staticmethod
    def noise(h, place, ratio, speed=None, ratio_speed=None):
        d = [place * h, place * h, ratio, place * h] + ([] if speed is None else [speed * h, speed * h, ratio_speed, speed * h])
        return np.diag(np.square(d))

    @staticmethod
    def state(box):
        x1, y1, x2, y2 = box
        return np.array([(x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) / (y2 - y1), y2 - y1])

    @staticmethod
    def box(t):
        x, y, a, h = t["m"][:4]
        return [x - a * h / 2, y - h / 2, x + a * h / 2, y + h / 2]

    def match(self, tracks, rows, limit, fuse):
        cost = {(i, j): 1 - overlap(np.array([self.box(t)]), np.array([self.boxes[r]]))[0, 0] * (self.scores[r] if fuse else 1) for i, t in enumerate(tracks) for j, r in enumerate(rows)}
        best, chosen = 0.0, []
        for some in itertools.product([None, *range(len(rows))], repeat=len(tracks)):
            pairs = [(i, j) for i, j in enumerate(some) if j is not None]
            if len({j for _, j in pairs}) == len(pairs) and all(cost[p] <= limit for p in pairs):
                gain = sum(limit - cost[p] for p in pairs)
                if gain > best:
                    best, chosen = gain, pairs
        for i, j in chosen:
            t, h = tracks[i], tracks[i]["m"][3]
            see = np.eye(4, 8)
            whole = see @ t["P"] @ see.T + self.noise(h, 1 / 20, 0.1)
            gain = t["P"] @ see.T @ np.linalg.inv(whole)
            t["m"] = t["m"] + gain @ (self.state(self.boxes[rows[j]]) - t["m"][:4])
            t["P"] = t["P"] - gain @ whole @ gain.T
            t["seen"], t["sure"] = self.frame, True
            self.owner[rows[j]] = t
        return [t for i, t in enumerate(tracks) if i not in {i for i, _ in chosen}], [r for j, r in enumerate(rows) if j not in {j for _, j in chosen}]

    def update(self, boxes, scores):
        s, self.boxes, self.scores, self.owner = self.s, boxes, scores, {}
        self.frame += 1
        firm, fresh = [t for t in self.tracks if t["sure"]], [t for t in self.tracks if not t["sure"]]
        for t in firm:
            if t["seen"] != self.frame - 1:
                t["m"][7] = 0
            h = t["m"][3]
            t["m"], t["P"] = self.step @ t["m"], self.step @ t["P"] @ self.step.T + self.noise(h, 1 / 20, 1e-2, 1 / 160, 1e-5)
        high = [r for r in range(len(boxes)) if scores[r] >= s.track_high_thresh]
        low = [r for r in range(len(boxes)) if s.track_low_thresh < scores[r] < s.track_high_thresh]
        left, high = self.match(firm, high, s.match_thresh, s.fuse_score)
        self.match([t for t in left if t["seen"] == self.frame - 1], low, 0.5, False)
        unmet, high = self.match(fresh, high, 0.7, s.fuse_score)
        self.tracks = [t for t in self.tracks if all(t is not u for u in unmet) and self.frame - t["seen"] <= s.track_buffer]
        for r in high:
            if scores[r] >= s.new_track_thresh:
                m = np.concatenate([self.state(boxes[r]), np.zeros(4)])
                t = {"m": m, "P": self.noise(m[3], 2 / 20, 1e-2, 10 / 160, 1e-5), "seen": self.frame, "began": self.frame, "sure": self.frame == 1, "n": self.next}
                self.next += 1
                self.tracks.append(t)
                self.owner[r] = t
        gone = []
        for a in self.tracks:
            for b in self.tracks:
                if a["seen"] == self.frame > b["seen"] and overlap(np.array([self.box(a)]), np.array([self.box(b)]))[0, 0] > 0.85:
                    gone.append(b if a["seen"] - a["began"] > b["seen"] - b["began"] else a)
        self.tracks = [t for t in self.tracks if all(t is not g for g in gone)]
        numbers = [self.owner[r]["n"] if r in self.owner and all(self.owner[r] is not g for g in gone) else 0 for r in range(len(boxes))]
        return numbers, [self.box(self.owner[r]) if r in self.owner else list(boxes[r]) for r in range(len(boxes))]


@pytest.mark.parametrize("seed", range(6))
def test_the_tracker_equals_a_plain_one(seed):
    rng = np.random.default_rng(seed)
    settings = TrackerSettings(track_buffer=6, fuse_score=seed % 2 == 0)
    plain, fast = PlainTracker(settings), CameraTracker(settings)
    at, pace = rng.uniform(0, 150, (4, 2)), rng.normal(0, 8, (4, 2))
    lost = 0
    for _ in range(150):
        at += pace + rng.normal(0, 1, at.shape)
        pace = np.where((at < 0) | (at > 200), -pace, pace)
        size = np.array([30.0, 60.0]) * rng.uniform(0.9, 1.1, (4, 1))
        there = rng.random(4) < (0.8 if plain.frame % 40 < 25 else 0.1)
        boxes, scores = np.concatenate([at, at + size], axis=1)[there], rng.uniform(0.05, 1, 4)[there] ** 0.5
        want, where = plain.update(boxes, scores)
        got = fast.update(boxes, scores).tolist() if len(boxes) else (fast.skip(1), [])[1]
        assert got == want
        if len(boxes):
            assert np.allclose(fast.placed, where, atol=1e-6)
        lost += sum(t["seen"] < plain.frame for t in plain.tracks)
        assert sorted(fast.tracks.number.tolist()) == sorted(t["n"] for t in plain.tracks)
    assert lost > 20 and plain.next > 8


def test_flat_and_repeated_boxes_have_a_result():
    tracker = CameraTracker(TrackerSettings())
    for _ in range(5):
        got = tracker.update(np.array([[5, 5, 5, 5.0], [5, 5, 9, 5], [0, 0, 10, 20], [0, 0, 10, 20]]), np.full(4, 0.9))
        assert len(got) == 4 and np.isfinite(tracker.placed).all()
    assert set(got[2:]) >= {3}


def test_runs_of_a_camera_begin_anew(spark):
    start = datetime.datetime(2026, 5, 1, 23, 59, 55)
    rows = [(day, "a", k, start + datetime.timedelta(seconds=k), 0.0, 0.0, 50.0, 100.0, 0.9, 1920, 1080) for day in (1, 2, None) for k in range(10)]
    boxes = spark.createDataFrame(rows, "day int, camera_id string, frame_id long, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, score double, frame_width long, frame_height long")
    every = boxes.select("day", "camera_id", "frame_id", "timestamp")
    got = track_detections(boxes, TrackerSettings(), frames=every, run="day").groupBy("day", "track_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 1, 10), (2, 1, 10), (None, 1, 10)}


def late_walkers(frames):
    """Boxes in the first frame of each segment and in its last."""
    return box_of_each_frame(frames.where("frame_id in (0, 59)"))


def long_decoder(path: str):
    return 4, 6, 2.0, iter(np.zeros((60, 4, 6), np.uint8))


def test_a_day_counts_frames_without_a_box(spark, tmp_path):
    root = tmp_path / "bucket"
    folder = root / "loc_cam/2026/07/08"
    folder.mkdir(parents=True)
    for n in ("030000.000Z.mkv", "040000.000Z.mkv"):
        (folder / n).touch()
    (root / "camera_registry.yaml").write_text(yaml.safe_dump({"bucket_name": "bucket", "storage": {}, "cameras": [{"camera_id": "cam", "location": "loc", "ip": "x"}]}))
    done = daily.analyze_daily(spark, datetime.date(2026, 7, 8), str(root), late_walkers, decoder=f"{__name__}:long_decoder", output_root=tmp_path / "out")
    rows = spark.read.parquet(done.tracking_path).orderBy("timestamp").collect()
    # 58 empty frames end a track; the next segment goes on without a frame between.
    assert [(r["frame_id"], r["track_id"]) for r in rows] == [(0, 1), (59, 2), (0, 2), (59, 3)]


def fake_decoder(path: str):
    return 4, 6, 2.0, iter(np.zeros((3, 4, 6), np.uint8))


def box_of_each_frame(frames):
    box = {"x1": 0.0, "y1": 0.0, "x2": 50.0, "y2": 100.0, "score": 0.9}
    return frames.select("camera_id", "frame_id", "timestamp", *(F.lit(v).alias(k) for k, v in box.items()), F.lit(2).alias("cls"), "frame_width", "frame_height")


def test_frames_to_tracks(spark, tmp_path):
    root = tmp_path / "bucket"
    folder = root / "loc_cam/2026/07/08"
    folder.mkdir(parents=True)
    for n in ("030000.000Z.mkv", "040000.000Z.mkv"):
        (folder / n).touch()
    registry = {"bucket_name": "bucket", "storage": {}, "cameras": [{"camera_id": "cam", "location": "loc", "ip": "x"}]}
    (root / "camera_registry.yaml").write_text(yaml.safe_dump(registry))
    day = datetime.date(2026, 7, 8)
    done = daily.analyze_daily(spark, day, str(root), box_of_each_frame, decoder=f"{__name__}:fake_decoder", output_root=tmp_path / "out")
    rows = spark.read.parquet(done.tracking_path).orderBy("timestamp").collect()
    assert [(r["frame_id"], r["track_id"], r["frame_width"]) for r in rows] == [(k, 1, 6) for k in (0, 1, 2, 0, 1, 2)]
    assert rows[1]["timestamp"].astimezone(datetime.UTC) == datetime.datetime(2026, 7, 8, 3, 0, 0, 500000, tzinfo=datetime.UTC)
    with pytest.raises(ValueError, match="no segments"):
        daily.analyze_daily(spark, datetime.date(2026, 7, 9), str(root), box_of_each_frame, output_root=tmp_path / "out")


def test_streamed_events_equal_the_batch(spark, tmp_path):
    from tidewalk.operators import lines, zones

    zone = Zone(name="z", polygon=[(0, 0), (100, 0), (100, 100), (0, 100)])
    line = Line(name="x", points=[(0, 50), (100, 50)], inside_point=(50, 90), line_group="g")
    rng = np.random.default_rng(3)
    rows = [("cam", t, datetime.datetime(2026, 5, 1, 9, 0) + datetime.timedelta(seconds=60 * k + t), float(rng.uniform(-20, 120)), float(rng.uniform(-20, 120))) for t in range(5) for k in range(30)]
    made = spark.createDataFrame(rows, "camera_id string, track_id long, clock timestamp, foot_x double, foot_y double")
    for k, part in enumerate((made.where("minute(clock) < 15"), made.where("minute(clock) >= 15"))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*").withWatermark("clock", "1 hour")
    found = events.shape_events(stream, {"cam": [zone]}, {"cam": [line]}, {"cam": 5.0}, {"cam": 5.0})
    q = found.writeStream.format("memory").queryName("events_seen").option("checkpointLocation", f"{tmp_path}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    streamed = {r["kind"]: r["count"] for r in spark.table("events_seen").groupBy("kind").count().collect()}
    points = made.selectExpr("camera_id", "track_id", "cast(clock as timestamp_ntz) as clock", "0L as frame_id", "foot_x", "foot_y", "cast(date_trunc('hour', clock) as timestamp_ntz) as time_bucket")
    z = zones.count_zones(points, {"cam": [zone]}, {"cam": 5.0}).agg(F.sum("entries")).first()[0]
    x = lines.count_lines(points, {"cam": [line]}, {"cam": 5.0}).agg(F.sum("in_count"), F.sum("out_count")).first()
    assert (streamed["entry"], streamed.get("in", 0), streamed.get("out", 0)) == (z, x[0], x[1])
