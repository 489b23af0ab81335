"""Run settings, loadable from YAML."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class EncoderSpec:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Thresholds:
    hot_day: float = 30.0
    cold_day: float = 5.0
    cdd_base: float = 18.0
    hdd_base: float = 18.0


@dataclass(frozen=True)
class BoostingParams:
    trees: int = 100
    learning_rate: float = 0.5
    seed: int = 10
    depth: int = 5


@dataclass(frozen=True)
class Config:
    # The published defaults of the pipeline.
    split_date: dt.date | None = dt.date(2024, 10, 1)
    test_ratio: float = 0.2
    start_date: dt.date = dt.date(2022, 1, 1)
    end_date: dt.date = dt.date(2024, 12, 31)
    encoders: tuple[EncoderSpec, ...] = (EncoderSpec("One-Hot", ("weather_category",)),)
    thresholds: Thresholds = field(default_factory=Thresholds)
    boosting: BoostingParams = field(default_factory=BoostingParams)
    mse_threshold: float = 10000.0


def _as_date(value: Any) -> dt.date | None:
    if value is None or isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def config_from_mapping(raw: Mapping[str, Any]) -> Config:
    """Build a Config from parsed YAML; absent keys keep their defaults."""
    kept: dict[str, Any] = {}
    if "split_date" in raw:
        kept["split_date"] = _as_date(raw["split_date"])
    for key in ("start_date", "end_date"):
        if key in raw:
            kept[key] = _as_date(raw[key])
    for key in ("test_ratio", "mse_threshold"):
        if key in raw:
            kept[key] = float(raw[key])
    if "encoders" in raw:
        kept["encoders"] = tuple(
            EncoderSpec(e["name"], tuple(e["columns"])) for e in raw["encoders"] or ()
        )
    if "feature_thresholds" in raw:
        kept["thresholds"] = Thresholds(**{k: float(v) for k, v in raw["feature_thresholds"].items()})
    if "boosting" in raw:
        kept["boosting"] = BoostingParams(**raw["boosting"])
    return Config(**kept)


def config_to_mapping(cfg: Config) -> dict[str, Any]:
    """The plain values that `config_from_mapping` turns back into an equal configuration."""
    return {
        "split_date": cfg.split_date and cfg.split_date.isoformat(),
        "test_ratio": cfg.test_ratio,
        "start_date": cfg.start_date.isoformat(),
        "end_date": cfg.end_date.isoformat(),
        "encoders": [{"name": e.name, "columns": list(e.columns)} for e in cfg.encoders],
        "feature_thresholds": asdict(cfg.thresholds),
        "boosting": asdict(cfg.boosting),
        "mse_threshold": cfg.mse_threshold,
    }


def load_config(path: str | Path) -> Config:
    import yaml

    return config_from_mapping(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
