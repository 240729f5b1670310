"""Strict configuration of an annotation run."""

from __future__ import annotations

import dataclasses
import math
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlsplit

from .functions.jsontext import stable_hash

MODES = ("complete", "dagger_patch")


class ConfigError(ValueError):
    """A configuration that can't be used."""


@dataclass(frozen=True)
class Subtask:
    skill: str
    text: str


@dataclass(frozen=True)
class Model:
    name: str = "local-vision-model"
    endpoint: str = "http://127.0.0.1:8000/v1"
    api_key: str = "local"
    revision: str | None = None


@dataclass(frozen=True)
class Sampling:
    coarse_fps: float = 1.0
    coarse_max_frames: int = 64
    refine_window_seconds: float = 2.5
    refine_fps: float = 8.0
    dense_radius_seconds: float = 0.5
    agreement_tolerance_frames: int = 12
    min_segment_frames: int = 8


@dataclass(frozen=True)
class Augmentation:
    enabled: bool = False
    language: str = "English"


@dataclass(frozen=True)
class Config:
    source: str
    work_dir: str
    mode: str
    high_level_instruction: str
    primary_camera: str
    refine_cameras: list[str]
    subtasks: list[Subtask]
    model: Model = field(default_factory=Model)
    sampling: Sampling = field(default_factory=Sampling)
    augmentation: Augmentation = field(default_factory=Augmentation)

    def stable_hash(self) -> str:
        """Of all but the key, and of augmentation only where it is in use."""
        data = dataclasses.asdict(self)
        del data["model"]["api_key"]
        if self.augmentation == Augmentation():
            del data["augmentation"]
        return stable_hash(data)


def _build(kind, data, where: str):
    if not isinstance(data, dict):
        raise ConfigError(f"{where}: a mapping is needed")
    fields = {f.name: f for f in dataclasses.fields(kind)}
    if extra := sorted(set(data) - set(fields)):
        raise ConfigError(f"{where}: unknown {', '.join(map(str, extra))}")
    needed = {n for n, f in fields.items() if f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING}
    if missing := sorted(needed - set(data)):
        raise ConfigError(f"{where}: {', '.join(missing)} missing")
    nested = {"model": Model, "sampling": Sampling, "augmentation": Augmentation}
    values = {}
    for n, v in data.items():
        if n in nested:
            v = _build(nested[n], v, n)
        elif n == "subtasks":
            v = [_build(Subtask, x, f"subtasks[{i}]") for i, x in enumerate(v if isinstance(v, list) else [])]
        values[n] = v
    return kind(**values)


def parse(data) -> Config:
    c = _build(Config, data, "config")
    texts = [c.high_level_instruction, c.primary_camera, c.source, c.work_dir, *c.refine_cameras, *(x for s in c.subtasks for x in (s.skill, s.text))]
    if not all(isinstance(t, str) and t for t in texts) or not c.refine_cameras or not c.subtasks:
        raise ConfigError("texts, refine_cameras and subtasks must not be empty")
    if c.mode not in MODES:
        raise ConfigError(f"mode is one of {MODES}")
    s = c.sampling
    for name, least in (("coarse_max_frames", 8), ("agreement_tolerance_frames", 0), ("min_segment_frames", 1)):
        if type(getattr(s, name)) is not int or getattr(s, name) < least:
            raise ConfigError(f"sampling.{name}: a whole number of {least} at least")
    for name in ("coarse_fps", "refine_window_seconds", "refine_fps", "dense_radius_seconds"):
        v = getattr(s, name)
        if isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(v) or v <= 0:
            raise ConfigError(f"sampling.{name}: a positive number")
    u = urlsplit(c.model.endpoint)
    if u.scheme not in ("http", "https") or not u.hostname or u.username or u.password or u.query or u.fragment:
        raise ConfigError("model.endpoint: scheme, host, port and path only")
    if not c.augmentation.language or c.augmentation.language != c.augmentation.language.strip():
        raise ConfigError("augmentation.language: a trimmed text")
    return c


def load(path: str | Path) -> Config:
    import yaml

    return parse(yaml.safe_load(Path(path).read_text(encoding="utf-8")))
