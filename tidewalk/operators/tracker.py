"""Tracks from detected boxes, camera by camera, after the public ByteTrack method.

Each frame's boxes are matched to the tracks' predicted boxes in two rounds, confident
boxes first, then faint ones for tracks still unmatched; confident boxes that are left
begin tracks.  A track that stays unmatched for ``track_buffer`` frames ends.  Frames
without a box count as well: they come as rows without a score.

Where a track will be is told by a Kalman filter over its centre, ratio of sides and
height.  Rows of a camera arrive in order of time, so a task keeps one camera's open
tracks and one frame's boxes at a time, however long the day.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.config import TrackerSettings

COLUMNS = ["camera_id", "frame_id", "timestamp", "track_id", "x1", "y1", "x2", "y2", "frame_width", "frame_height", "score"]
_BOX = ["x1", "y1", "x2", "y2"]
#: A match may not cost this much.
_NEVER = 1e6


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of every box of ``a`` with every box of ``b``."""
    sides = np.maximum(np.minimum(a[:, None, 2:], b[None, :, 2:]) - np.maximum(a[:, None, :2], b[None, :, :2]), 0)
    shared = sides[..., 0] * sides[..., 1]
    size = [spans[:, 0] * spans[:, 1] for spans in (np.maximum(x[:, 2:] - x[:, :2], 0) for x in (a, b))]
    union = size[0][:, None] + size[1][None, :] - shared
    return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


def assign(cost: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Pairs of the cheapest assignment (shortest augmenting paths), without those over ``limit``."""
    rows, cols = cost.shape
    if not rows or not cols:
        return []
    if rows == 1:
        c = int(np.argmin(cost[0]))
        return [(0, c)] if cost[0, c] <= limit else []
    if rows > cols:
        return [(r, c) for c, r in assign(cost.T, limit)]
    # Over the limit, being unmatched is as good as any: each row also has a private dummy.
    wide = np.concatenate([np.where(cost <= limit, cost, _NEVER), np.full((rows, rows), limit + 1e-9)], axis=1)
    n = wide.shape[1]
    potential_row, potential_col = np.zeros(rows), np.zeros(n)
    owner = np.full(n, -1)
    for r in range(rows):
        reach, came, done = np.full(n, np.inf), np.full(n, -1), np.zeros(n, bool)
        row, col = r, -1
        while True:
            slack = wide[row] - potential_row[row] - potential_col + (reach[col] if col >= 0 else 0.0)
            better = ~done & (slack < reach)
            reach[better], came[better] = slack[better], col
            col = int(np.argmin(np.where(done, np.inf, reach)))
            done[col] = True
            if owner[col] < 0:
                break
            row = owner[col]
        total = reach[col]
        potential_row[r] += total
        for c in np.flatnonzero(done):
            if owner[c] >= 0:
                potential_row[owner[c]] += total - reach[c]
            potential_col[c] -= total - reach[c]
        while col >= 0:
            before = came[col]
            owner[col] = owner[before] if before >= 0 else r
            col = before
    return [(int(owner[c]), c) for c in range(cols) if owner[c] >= 0 and cost[owner[c], c] <= limit]


# Fixed values of the published motion model: noise as shares of a box's height, and of
# the ratio of its sides for itself.
PLACE_NOISE, SPEED_NOISE = 1 / 20, 1 / 160
RATIO_START, RATIO_STEP, RATIO_SEEN = (1e-2, 1e-5), (1e-2, 1e-5), 1e-1
#: Two tracks that share this much of their boxes are one.
SAME = 0.85


#: Variances are a share of the height's square, but for the ratio's: of place, of both, of speed.
_BY_HEIGHT = np.array([1.0, 1.0, 0.0, 1.0])
_OF_RATIO = 1 - _BY_HEIGHT


def _variance(place: float, speed: float, ratio: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """What to multiply a height's square by, and what to add (never nothing, so that flat boxes divide)."""
    by_height = np.stack([place**2 * _BY_HEIGHT, np.zeros(4), speed**2 * _BY_HEIGHT])
    return by_height, np.stack([ratio[0] ** 2 * _OF_RATIO + 1e-18, np.zeros(4), ratio[1] ** 2 * _OF_RATIO + 1e-18])


_START = _variance(2 * PLACE_NOISE, 10 * SPEED_NOISE, RATIO_START)
_STEP = _variance(PLACE_NOISE, SPEED_NOISE, RATIO_STEP)
_SEEN = PLACE_NOISE**2 * _BY_HEIGHT, RATIO_SEEN**2 * _OF_RATIO + 1e-18


def shapes_of(boxes: np.ndarray) -> np.ndarray:
    """Centre, ratio of width to height, and height of each box."""
    out = np.empty((len(boxes), 4))
    size = boxes[:, 2:] - boxes[:, :2]
    out[:, :2] = (boxes[:, :2] + boxes[:, 2:]) / 2
    out[:, 2] = np.divide(size[:, 0], size[:, 1], out=np.zeros(len(boxes)), where=size[:, 1] != 0)
    out[:, 3] = size[:, 1]
    return out


def boxes_of(shapes: np.ndarray) -> np.ndarray:
    half, out = shapes[:, 2:] / 2, np.empty((len(shapes), 4))
    half[:, 0] *= shapes[:, 3]
    out[:, :2], out[:, 2:] = shapes[:, :2] - half, shapes[:, :2] + half
    return out


@dataclass
class Tracks:
    """Open tracks, a row each.

    A track's four numbers (see ``shapes_of``) move apart from one another, each by a
    constant speed, so the Kalman filter of eight states is four filters of two, and
    ``spread`` has what is not zero of the covariance: of place, of both, of speed.
    """

    number: np.ndarray
    began: np.ndarray
    seen: np.ndarray
    confirmed: np.ndarray
    place: np.ndarray
    speed: np.ndarray
    spread: np.ndarray

    def __len__(self) -> int:
        return len(self.number)

    @classmethod
    def begin(cls, numbers: np.ndarray, boxes: np.ndarray, frame: int) -> Tracks:
        """Tracks of boxes seen for the first time; those of the first frame needn't be met again to last."""
        n, place = len(numbers), shapes_of(boxes)
        at, squared = np.full(n, frame), np.square(place[:, 3])[:, None, None]
        return cls(numbers, at, at.copy(), np.full(n, frame == 1), place, np.zeros((n, 4)), squared * _START[0] + _START[1])

    def only(self, keep: np.ndarray) -> Tracks:
        return Tracks(*(getattr(self, f.name)[keep] for f in fields(self)))

    def joined(self, more: Tracks) -> Tracks:
        return Tracks(*(np.concatenate([getattr(self, f.name), getattr(more, f.name)]) for f in fields(self)))

    def move(self, frame: int) -> None:
        """Confirmed tracks go on to ``frame``; those not seen in the one before keep their height."""
        if not len(self):
            return
        met_again = self.confirmed[:, None]
        self.speed[self.confirmed & (self.seen < frame - 1), 3] = 0
        grown = np.square(self.place[:, 3])[:, None, None] * _STEP[0] + _STEP[1]
        grown[:, 0] += 2 * self.spread[:, 1] + self.spread[:, 2]
        grown[:, 1] += self.spread[:, 2]
        self.place += self.speed * met_again
        self.spread += grown * met_again[:, None]

    def take(self, some: np.ndarray, boxes: np.ndarray, frame: int) -> None:
        """The tracks ``some`` have been seen in these boxes."""
        if not len(some):
            return
        spread, place = self.spread[some], self.place[some]
        whole = spread[:, 0] + np.square(place[:, 3])[:, None] * _SEEN[0] + _SEEN[1]
        shares = spread[:, :2] / whole[:, None]
        off = shapes_of(boxes) - place
        self.place[some] = place + shares[:, 0] * off
        self.speed[some] += shares[:, 1] * off
        spread[:, 2] -= shares[:, 1] * spread[:, 1]
        spread[:, :2] -= shares[:, :1] * spread[:, :2]
        self.spread[some] = spread
        self.seen[some], self.confirmed[some] = frame, True


def _no_tracks() -> Tracks:
    return Tracks.begin(np.zeros(0, np.int64), np.zeros((0, 4)), 0)


class CameraTracker:
    """Tracks of one camera; numbers go on over its segments.

    ``placed`` has the boxes of the last update as their tracks have them, that is
    smoothed; boxes of no track are as they came.
    """

    def __init__(self, settings: TrackerSettings) -> None:
        self.settings, self.tracks, self.next, self.frame, self.placed = settings, _no_tracks(), 1, 0, np.zeros((0, 4))

    def _end(self, others: np.ndarray | bool = False) -> None:
        """Drop tracks that are ``others``, that weren't met again after they began, or that were lost too long ago."""
        t = self.tracks
        if others is False and (t.seen == self.frame).all():
            return
        gone = others | (~t.confirmed & (t.seen < self.frame)) | (self.frame - t.seen > self.settings.track_buffer)
        if gone.any():
            self.tracks = t.only(~gone)

    def skip(self, frames: int) -> None:
        """The same as so many updates without a box."""
        last = self.frame + frames
        while self.frame < last and len(self.tracks):
            self.frame += 1
            self.tracks.move(self.frame)
            self._end()
        self.frame = last

    def _doubles(self) -> np.ndarray | bool:
        """Of each pair of a seen and a lost track in nearly one box, the one with the shorter history (the seen one if they are even)."""
        t = self.tracks
        lost = np.flatnonzero(t.confirmed & (t.seen < self.frame))
        if not len(lost):
            return False
        now, out = np.flatnonzero(t.seen == self.frame), np.zeros(len(t), bool)
        boxes, age = boxes_of(t.place), t.seen - t.began
        for a, b in np.argwhere(overlap(boxes[now], boxes[lost]) > SAME):
            out[lost[b] if age[now[a]] > age[lost[b]] else now[a]] = True
        return out

    def update(self, boxes: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Track numbers of one frame's boxes, 0 where a box belongs to none."""
        s, owner = self.settings, np.full(len(boxes), -1)
        self.frame += 1
        self.tracks.move(self.frame)
        known, expected = self.tracks, boxes_of(self.tracks.place)
        sure, faint = np.flatnonzero(scores >= s.track_high_thresh), np.flatnonzero((scores < s.track_high_thresh) & (scores > s.track_low_thresh))

        def match(tracks: np.ndarray, rows: np.ndarray, limit: float, fuse: bool) -> tuple[np.ndarray, np.ndarray]:
            """What is left of both."""
            if not len(tracks) or not len(rows):
                return tracks, rows
            near = overlap(expected[tracks], boxes[rows])
            pairs = assign(1 - near * (scores[rows][None, :] if fuse else 1.0), limit)
            for t, r in pairs:
                owner[rows[r]] = tracks[t]
            met, used = {t for t, _ in pairs}, {r for _, r in pairs}
            return tracks[[k not in met for k in range(len(tracks))]], rows[[k not in used for k in range(len(rows))]]

        left, sure = match(np.flatnonzero(known.confirmed), sure, s.match_thresh, s.fuse_score)
        # Only tracks that were seen in the frame before are looked for among faint boxes.
        match(left[known.seen[left] == self.frame - 1], faint, 0.5, False)
        _, sure = match(np.flatnonzero(~known.confirmed), sure, 0.7, s.fuse_score)
        met = np.flatnonzero(owner >= 0)
        known.take(owner[met], boxes[met], self.frame)
        new = sure[scores[sure] >= s.new_track_thresh]
        owner[new] = len(known) + np.arange(len(new))
        self.tracks = known.joined(Tracks.begin(np.arange(self.next, self.next + len(new)), boxes[new], self.frame)) if len(new) else known
        self.next += len(new)
        doubles, own = self._doubles(), np.flatnonzero(owner >= 0)
        out, self.placed = np.zeros(len(boxes), np.int64), boxes.astype(float)
        self.placed[own] = boxes_of(self.tracks.place[owner[own]])
        out[own] = self.tracks.number[owner[own]]
        if doubles is not False:
            out[own[doubles[owner[own]]]] = 0
        self._end(doubles)
        return out


def _plain(values: pd.Series) -> np.ndarray:
    """The values with None for every kind of null, so that nulls are alike."""
    return values.astype(object).where(values.notna(), None).to_numpy()


def _frame_starts(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Whether each row begins a frame: another camera, run or time than the row before."""
    starts = np.zeros(len(rows), dtype=bool)
    starts[:1] = True
    for values in (*(_plain(rows[c]) for c in keys), rows["timestamp"].to_numpy()):
        starts[1:] |= values[1:] != values[:-1]
    return starts


def track_detections(detections: DataFrame, settings: TrackerSettings, classes: list[int] | None = None, frames: DataFrame | None = None, run: str | None = None) -> DataFrame:
    """Tracked boxes: the detections with ``track_id``, without boxes that belong to no track; coordinates are the tracks', smoothed.

    ``detections`` has camera_id, frame_id, timestamp, x1, y1, x2, y2, score,
    frame_width, frame_height and, for ``classes``, cls.  Cameras are independent.
    ``frames`` has camera_id, frame_id and timestamp of all frames, those without a box
    included (repeats do no harm); where it is None, only frames of ``detections`` are
    known, so tracks don't age while nothing is seen.  ``run`` names a column of both,
    such as the day, kept in the result: tracks and their numbers begin anew in each of
    a camera's runs, and each run is a task's work by itself.  Null is a run as well.
    """
    keys = ["camera_id"] if run is None else ["camera_id", run]
    columns = COLUMNS if run is None else [run, *COLUMNS]
    if classes is not None:
        detections = detections.where(detections["cls"].isin(classes))
    shape = {f.name: f.dataType.simpleString() for f in detections.schema.fields}
    shape |= dict.fromkeys(_BOX, "double")
    kinds = shape | {"track_id": "long"}
    detections = detections.select(*[F.col(c).cast(shape[c]).alias(c) for c in columns if c != "track_id"])
    if frames is not None:
        # A camera's frames, those of boxes of other classes included, as rows without a score.
        blank = {c: F.lit(None if c == "score" else 0).cast(shape[c]) for c in shape if c in columns}
        known = {c: F.col(c).cast(shape[c]) for c in (*keys, "frame_id", "timestamp")}
        detections = detections.unionByName(frames.select(*[column.alias(c) for c, column in (blank | known).items()]))

    def follow(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        camera, tracker, held = None, None, None

        def tracked(rows: pd.DataFrame, stop: int) -> pd.DataFrame:
            """The frames of the first ``stop`` rows, tracked; arrays throughout, one table out."""
            nonlocal camera, tracker
            names, boxes, scores = [_plain(rows[c]) for c in keys], rows[_BOX].to_numpy(float), rows["score"].to_numpy(float)
            numbers, real = np.zeros(stop, np.int64), ~np.isnan(scores)
            cuts = [*np.flatnonzero(_frame_starts(rows, keys)).tolist(), len(rows)]
            for first, beyond in zip(cuts[:-1], cuts[1:], strict=True):
                if first >= stop:
                    break
                if tracker is None or [n[first] for n in names] != camera:
                    camera, tracker = [n[first] for n in names], CameraTracker(settings)
                some = first + np.flatnonzero(real[first:beyond])
                if len(some):
                    numbers[some] = tracker.update(boxes[some], scores[some])
                    boxes[some] = tracker.placed
                else:
                    tracker.skip(1)
            sides = dict(zip(_BOX, boxes[:stop].T, strict=True))
            return rows.iloc[:stop].assign(track_id=numbers, **sides).loc[numbers > 0, columns]

        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            if not len(part):
                continue
            # The last frame may go on in the next batch.
            last = int(np.flatnonzero(_frame_starts(part, keys))[-1])
            yield tracked(part, last)
            held = part.iloc[last:].reset_index(drop=True)
        if held is not None and len(held):
            yield tracked(held, len(held))

    ordered = detections.repartition(*keys).sortWithinPartitions(*keys, "timestamp", "frame_id", *_BOX, "score")
    return ordered.mapInPandas(follow, ", ".join(f"`{c}` {kinds[c]}" for c in columns))
