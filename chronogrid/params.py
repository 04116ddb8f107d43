"""Run parameters with all rules checked at once."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

#: Smoothing methods, and the valid ranges that each program starts from.
METHODS = ("savgol", "loess", "linear", "harmonic", "whittaker", "none")
SERIES_RANGES = {"NDVI": (-1.0, 1.0), "EVI2": (-1.0, 2.0), "NIRv": (-0.5, 1.0)}
RASTER_RANGES = {"NDVI": (-0.1, 1.0), "EVI2": (-1.0, 2.0), "NIRv": (-0.5, 1.0)}


def parse_valid_range(text: str, strict: bool = False) -> tuple[float, float]:
    """'lo,hi' as numbers; more parts are ignored unless ``strict``."""
    parts = [p.strip() for p in text.split(",")]
    if len(parts) < 2 or strict and len(parts) != 2:
        raise ValueError(f"a valid range is 'min,max', not {text!r}")
    return float(parts[0]), float(parts[1])


def _day(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


@dataclass(frozen=True)
class Params:
    """What the regional program needs besides its tables; raises once with every broken rule."""

    vis: tuple[str, ...] = ("NDVI",)
    valid_ranges: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(SERIES_RANGES))
    smooth_method: str = "savgol"
    smooth_window: int = 15
    smooth_polyorder: int = 3
    smooth_lambda: float = 100.0
    harmonics: int = 3
    compute_metrics: bool = False
    sos_threshold: float = 0.20
    year_start_doy: int = 1
    peak_prominence: float = 0.05
    peak_min_distance_days: int = 45
    min_valid_obs: int = 20
    min_valid_obs_per_year: int = 5
    sample_pixels: int | None = None
    random_seed: int | None = None
    min_value_mean: float | None = None
    min_quality_frac: float = 0.0
    start_date: str | None = None
    end_date: str | None = None
    use_median: bool = False
    tiles: str | None = None
    datacubes: tuple[str, ...] | None = None
    region_files: tuple[str, ...] = ()
    region_fields: tuple[str, ...] | None = None
    output_dir: str = "out"

    def __post_init__(self) -> None:
        broken = [text for bad, text in self._rules() if bad]
        days = {}
        for name in ("start_date", "end_date"):
            try:
                days[name] = _day(getattr(self, name))
            except ValueError:
                broken.append(f"{name} has to be YYYY-MM-DD: {getattr(self, name)!r}")
        if days.get("start_date") and days.get("end_date") and days["start_date"] > days["end_date"]:
            broken.append("start_date is after end_date")
        if broken:
            raise ValueError("invalid parameters:\n" + "\n".join(f"  - {b}" for b in broken))

    def _rules(self) -> list[tuple[bool, str]]:
        whole = lambda name: (getattr(self, name) < 1, f"{name} has to be 1 or more")
        fields = self.region_fields
        return [
            (not self.vis, "at least one index is needed"),
            (not 0 < self.sos_threshold < 1, "sos_threshold has to be between 0 and 1"),
            (not 1 <= self.year_start_doy <= 365, "year_start_doy has to be 1 to 365"),
            whole("smooth_window"),
            (self.smooth_polyorder < 0, "smooth_polyorder can't be negative"),
            (self.smooth_method not in METHODS, f"smooth_method is one of {', '.join(METHODS)}"),
            (self.smooth_method == "savgol" and self.smooth_polyorder >= self.smooth_window, "smooth_polyorder has to be under smooth_window"),
            (self.smooth_lambda <= 0, "smooth_lambda has to be positive"),
            (self.compute_metrics and self.smooth_method == "none", "metrics need a smoothing method"),
            (not 0 < self.peak_prominence < 1, "peak_prominence has to be between 0 and 1"),
            whole("peak_min_distance_days"),
            whole("min_valid_obs"),
            whole("min_valid_obs_per_year"),
            (self.sample_pixels is not None and self.sample_pixels < 1, "sample_pixels has to be 1 or more"),
            (not 0 <= self.min_quality_frac <= 1, "min_quality_frac has to be 0 to 1"),
            (self.tiles is not None and self.datacubes is not None, "tiles and datacubes exclude each other"),
            (self.tiles is None and not self.datacubes, "tiles or datacubes are needed"),
            (fields is not None and not self.region_files, "region_fields need region_files"),
            (fields is not None and bool(self.region_files) and len(fields) != len(self.region_files), "as many region_fields as region_files are needed ('none' dissolves)"),
        ]

    def valid_range(self, vi: str) -> tuple[float, float]:
        return self.valid_ranges[vi]
