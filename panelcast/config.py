"""Plain, immutable configuration for a panel back-test.

Everything the DataFrame operators need is carried here so a run is fully
described by one value that can be fingerprinted (see ``sources.tables``).
Column *names* of the panel (series / time / target) are configurable, as
are the top-N cut, the date window, the split lengths and the covariate roles.
"""

from __future__ import annotations

import dataclasses
import datetime
import hashlib
import json
from dataclasses import dataclass, field

# Fixed values that results depend on --------------------------------------
# Standard quantile levels emitted by every forecaster.
QUANTILES: tuple[float, ...] = (0.1, 0.3, 0.5, 0.7, 0.9)
# Split labels.
TRAIN, VALIDATE, TEST = "TRAIN", "VALIDATE", "TEST"
# Default weather sentinels meaning "missing".
TEMP_MISSING = 9999.9
PRCP_MISSING = 99.99
# Default year window of the sharded weather covariate.
DEFAULT_START_YEAR = "2013"
DEFAULT_END_YEAR = "2019"


def quantile_column(level: float) -> str:
    """``0.1`` -> ``"q10"``."""
    return f"q{round(level * 100)}"


QUANTILE_COLUMNS: tuple[str, ...] = tuple(quantile_column(q) for q in QUANTILES)


@dataclass(frozen=True)
class Roles:
    """Covariate roles: static attributes, known-future and unknown-future."""

    attribute: tuple[str, ...] = ("capacity", "region_id", "latitude", "longitude")
    available: tuple[str, ...] = ("temp", "prcp", "day_of_week", "month", "is_weekend")
    unavailable: tuple[str, ...] = ("avg_tripduration", "pct_subscriber", "ratio_gender")


@dataclass(frozen=True)
class WeatherSpec:
    """Which covariate station to read, over which year shards, and its sentinels."""

    stn: str = "725030"
    wban: str = "14732"
    temp_missing: float = TEMP_MISSING
    prcp_missing: float = PRCP_MISSING
    # Year shards read when the config carries no explicit date window.
    default_start_year: str = DEFAULT_START_YEAR
    default_end_year: str = DEFAULT_END_YEAR


@dataclass(frozen=True)
class PanelConfig:
    """Data layer + forecast settings of one back-test variant."""

    series_column: str = "series"
    time_column: str = "date"
    target_column: str = "target"
    top_n: int | None = 25  # None: every valid series (no cut)
    date_start: str | None = None
    date_end: str | None = None
    gap_fill: bool = True
    test_length: int = 14
    validate_length: int = 14
    horizon: int = 14
    context_len: int = 512
    holiday_region: str | None = "US"
    weather: WeatherSpec = field(default_factory=WeatherSpec)
    roles: Roles = field(default_factory=Roles)

    def __post_init__(self) -> None:
        if self.top_n is not None and self.top_n <= 0:
            raise ValueError("top_n must be > 0")
        if self.horizon <= 0:
            raise ValueError("horizon must be > 0")
        if self.test_length < 0 or self.validate_length < 0:
            raise ValueError("split lengths must be >= 0")
        if self.context_len <= 0:
            raise ValueError("context_len must be > 0")
        self.window()

    def weather_years(self) -> tuple[str, str]:
        """First and last year shard to read: those of the date window where it is bounded."""
        first, last = self.window()
        return (
            f"{first.year:04d}" if first else self.weather.default_start_year,
            f"{last.year:04d}" if last else self.weather.default_end_year,
        )

    def window(self) -> tuple[datetime.date | None, datetime.date | None]:
        """The date window as dates; a bound that is no ISO date raises ValueError."""
        first, last = (datetime.date.fromisoformat(d) if d else None for d in (self.date_start, self.date_end))
        if first and last and first > last:
            raise ValueError(f"date window is empty: {first} to {last}")
        return first, last

    def replace(self, **changes) -> PanelConfig:
        return dataclasses.replace(self, **changes)

    # -- fingerprints per layer (a layer hashes only the fields it reads) --
    def source_fields(self) -> dict:
        return {
            "series": self.series_column,
            "time": self.time_column,
            "target": self.target_column,
            "top_n": self.top_n,
            "date_start": self.date_start,
            "date_end": self.date_end,
            "gap_fill": self.gap_fill,
            "weather": dataclasses.asdict(self.weather),
        }

    def prepped_fields(self) -> dict:
        return {
            **self.source_fields(),
            "test_length": self.test_length,
            "validate_length": self.validate_length,
        }


def fingerprint(payload: dict, length: int = 12) -> str:
    """SHA-256 of the canonical JSON of ``payload``, first ``length`` hex chars."""
    text = json.dumps(payload, sort_keys=True, separators=(",", ":"), default=str)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:length]
