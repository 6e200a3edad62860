"""Settings as frozen dataclasses; every leaf can be overridden from a nested mapping.

Fixed values: the defaults of all settings here.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


@dataclass(frozen=True)
class BBox:
    west: float = 105.25
    east: float = 106.10
    south: float = 20.55
    north: float = 21.40


@dataclass(frozen=True)
class Center:
    lat: float = 21.0285
    lon: float = 105.8542


@dataclass(frozen=True)
class Quality:
    min_value: float = 0.0
    max_value: float = 1000.0
    min_coverage_pct: float = 50.0


@dataclass(frozen=True)
class Series:
    horizons_hours: tuple[int, ...] = (6, 12, 24)
    lag_hours: tuple[int, ...] = (1, 3, 6, 12, 24)
    rolling_hours: tuple[int, ...] = (3, 6, 24)


@dataclass(frozen=True)
class Runs:
    backward_hours: int = 72
    forward_hours: int = 24
    backward_altitudes_m: tuple[float, ...] = (100, 500, 1000)
    forward_altitudes_m: tuple[float, ...] = (50, 200, 500)
    offsets_deg: tuple[float, ...] = (-0.2, 0.0, 0.2)
    run_hours_utc: tuple[int, ...] = (0, 6, 12, 18)
    meteo_interval_hours: int = 6
    trigger_threshold: float = 75.0


@dataclass(frozen=True)
class Trajectory:
    anchor_hours: tuple[int, ...] = (0, -6, -12, -24, -36, -48, -60, -72)
    cluster_k_min: int = 3
    cluster_k_max: int = 10
    cluster_k_default: int = 6
    path_start_h: int = -72
    path_end_h: int = -24
    max_distance_deg: float = 0.5


@dataclass(frozen=True)
class Raster:
    aod_scale: float = 0.001
    products: tuple[str, ...] = ("NO2", "CO", "SO2", "O3", "AER_AI")


@dataclass(frozen=True)
class Settings:
    bbox: BBox = field(default_factory=BBox)
    center: Center = field(default_factory=Center)
    quality: Quality = field(default_factory=Quality)
    series: Series = field(default_factory=Series)
    runs: Runs = field(default_factory=Runs)
    trajectory: Trajectory = field(default_factory=Trajectory)
    raster: Raster = field(default_factory=Raster)
    #: Fixed value: what the name of a place of the city matches, in lower case.
    place_pattern: str = "hanoi|ha noi|ha_noi"

    @classmethod
    def from_dict(cls, overrides: Mapping[str, Any]) -> Settings:
        return merged(cls(), overrides)


def merged(settings: Any, overrides: Mapping[str, Any]) -> Any:
    """`settings` with the leaves that `overrides` names replaced; unknown names are errors."""
    known = {f.name for f in fields(settings)}
    if unknown := set(overrides) - known:
        raise KeyError(f"unknown settings: {', '.join(sorted(unknown))}")
    new = {}
    for name, value in overrides.items():
        old = getattr(settings, name)
        new[name] = merged(old, value) if is_dataclass(old) else tuple(value) if isinstance(old, tuple) else value
    return replace(settings, **new)


def truthy(raw: str | None) -> bool:
    """Whether a flag's text means yes."""
    return str(raw or "").strip().lower() in ("1", "true", "yes", "y", "on")
