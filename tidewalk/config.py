"""Settings from arguments, the environment (``SECTION__FIELD``) and ``config.toml``, in that order.

Unknown sections and fields are errors, and so are keys that have moved, which name
their new place.
"""

from __future__ import annotations

import datetime
import json
import os
import tomllib
from pathlib import Path
from typing import Any, ClassVar, Literal

from pydantic import BaseModel, ConfigDict, Field, model_validator

from tidewalk.log import JsonLog
from tidewalk.schemas import DEFAULT_BAND

log = JsonLog("config")


class Section(BaseModel):
    """A section; ``moved`` maps keys of old to what to do now."""

    model_config = ConfigDict(extra="forbid")
    moved: ClassVar[dict[str, str]] = {}

    @model_validator(mode="before")
    @classmethod
    def _say_where_it_went(cls, data: Any) -> Any:
        for key in cls.moved.keys() & (data if isinstance(data, dict) else {}).keys():
            raise ValueError(f"{key}: {cls.moved[key]}")
        return data


class InputSettings(Section):
    """Shared by all stages, so that one environment serves them all."""

    bucket_dir: str = "bucket_name"
    date: datetime.date | None = None
    camera_ids: list[str] = Field(default_factory=list)
    bucket_minutes: int = Field(default=60, ge=1)


class ZoneSettings(Section):
    moved = {
        "bucket_minutes": "moved from [zone] to [input]; the variable is now INPUT__BUCKET_MINUTES",
        "entry_debounce_frames": "removed; entries are told by boundary_band_px_1080p, pixels of a 1920 wide frame, not by frames in a row",
    }
    boundary_band_px_1080p: float = Field(default=DEFAULT_BAND, ge=0)


class LineSettings(Section):
    moved = {
        "bucket_minutes": "moved from [line] to [input]; the variable is now INPUT__BUCKET_MINUTES",
        "crossing_band_px": "renamed crossing_band_px_1080p, now pixels of a 1920 wide frame that scale with the camera's width",
    }
    crossing_band_px_1080p: float = Field(default=DEFAULT_BAND, ge=0)


class ReportSettings(Section):
    period_minutes: int = Field(default=60, ge=1)
    metric: Literal["entries", "unique_visitors"] = "entries"
    on_duplicate_date: Literal["overwrite", "append", "error"] = "append"


class TrackerSettings(Section):
    track_high_thresh: float = Field(default=0.5, ge=0, le=1)
    track_low_thresh: float = Field(default=0.1, ge=0, le=1)
    new_track_thresh: float = Field(default=0.6, ge=0, le=1)
    track_buffer: int = Field(default=30, ge=1)
    match_thresh: float = Field(default=0.8, ge=0, le=1)
    fuse_score: bool = True
    gmc_method: str = "none"


class ModelSettings(Section):
    model_path: str = ""
    batch: int = Field(default=1, ge=1)
    classes: list[int] = Field(default_factory=lambda: [2], min_length=1)


class OutputSettings(Section):
    save_video: bool = False


class PluginSettings(Section):
    """Functions from outside, as ``module:function``: what loads a model, decodes a video and writes one."""

    loader: str = ""
    decoder: str = "tidewalk.sources.frames:opencv_decoder"
    writer: str = "tidewalk.sources.annotate:opencv_writer"


class Settings(Section):
    """What a stage may be told; each stage has a subset of these sections."""

    input: InputSettings = Field(default_factory=InputSettings)

    def day(self) -> datetime.date:
        if self.input.date is None:
            raise ValueError("[input].date is not set; name the day to process")
        return self.input.date


class ZoneStage(Settings):
    zone: ZoneSettings = Field(default_factory=ZoneSettings)


class LineStage(Settings):
    line: LineSettings = Field(default_factory=LineSettings)


class ReportStage(Settings):
    moved = {"zone": "removed here; bucket_minutes belongs in [input] (INPUT__BUCKET_MINUTES)"}
    report: ReportSettings = Field(default_factory=ReportSettings)


class AnalyzeStage(Settings):
    tracker: TrackerSettings = Field(default_factory=TrackerSettings)
    model: ModelSettings = Field(default_factory=ModelSettings)
    output: OutputSettings = Field(default_factory=OutputSettings)
    plugins: PluginSettings = Field(default_factory=PluginSettings)


CONFIG_FILE, PROJECT_MARK = "config.toml", "pyproject.toml"


def find_project_root(start: Path) -> Path | None:
    """The nearest folder above ``start`` that is a project's."""
    marked = (mark.parent for mark in (folder / PROJECT_MARK for folder in start.parents) if mark.exists())
    return next(marked, None)


def find_toml(caller_file: str | Path) -> Path | None:
    """Where settings are read from: the caller's project names the file, there or not; without one, the working folder's if there is one."""
    project = find_project_root(Path(caller_file).resolve())
    places = [project / CONFIG_FILE] if project else [p for p in [Path.cwd() / CONFIG_FILE] if p.exists()]
    return places[0] if places else None


def _merged(low: dict[str, Any], high: dict[str, Any]) -> dict[str, Any]:
    out = dict(low)
    for k, v in high.items():
        out[k] = _merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def _environment(kind: type[Settings], env: dict[str, str]) -> dict[str, Any]:
    """``SECTION__FIELD`` variables of the stage's sections; lists are JSON."""
    out: dict[str, dict[str, Any]] = {}
    for name, value in env.items():
        section, _, field = name.lower().partition("__")
        if field and section in kind.model_fields:
            as_json = value.lstrip()[:1] in "[{" and value.strip() != ""
            out.setdefault(section, {})[field] = json.loads(value) if as_json else value
    return out


def load_settings[S: Settings](kind: type[S], toml: str | Path | None = None, env: dict[str, str] | None = None, **told: Any) -> S:
    """Settings of a stage: ``told`` before the environment before the file; no file gives a warning and defaults."""
    written: dict[str, Any] = {}
    if toml is not None and Path(toml).exists():
        with open(toml, "rb") as f:
            written = tomllib.load(f)
    else:
        log.warning("no config.toml; defaults are used", path=str(toml))
    return kind.model_validate(_merged(_merged(written, _environment(kind, dict(os.environ) if env is None else env)), told))
