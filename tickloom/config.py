"""Parameters of the feature job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from tickloom.functions import fixed
from tickloom.functions.timekeys import WEEK_MODES


@dataclass(frozen=True)
class FixedCutoffs:
    """Split dates given by hand instead of found in the data."""

    test_start: datetime
    holdout_start: datetime
    holdout_end: datetime


@dataclass(frozen=True)
class FeatureConfig:
    """What the feature job builds. Positions in `instruments` and `columns` are category ids."""

    instruments: tuple[str, ...] = fixed.INSTRUMENTS
    columns: tuple[str, ...] = fixed.COLUMNS[:4]
    test_weeks: int = 12
    holdout_weeks: int = 12
    n_tests: int = 300
    length: int = 60
    seed: int = 42
    week_mode: str = "iso"
    # None keeps raw values; otherwise the multiplier of changes from the first value.
    scale: float | None = fixed.DEFAULT_SCALE
    # Multipliers by instrument, or by (column, instrument), which wins.
    scale_overrides: Mapping[str | tuple[str, str], float] = field(
        default_factory=lambda: dict(fixed.INSTRUMENT_SCALE)
    )
    # "drop" leaves missing values out of a column's list, "keep" keeps them as NULL.
    nulls: str = "drop"
    # "point" takes a window's start from its first point, "fixed_step" counts steps.
    window_start: str = "point"
    step_seconds: int = 60
    include_last_window: bool = False
    include_last_week: bool = False
    # Instrument the newest week is taken from; None takes the newest of all.
    cutoff_from: str | None = None
    cutoffs: FixedCutoffs | None = None
    # Number of series kept per split and column, oldest first; None keeps all.
    series_limit: int | None = None

    def __post_init__(self) -> None:
        if self.week_mode not in WEEK_MODES:
            raise ValueError(f"unknown week_mode {self.week_mode!r}")
        if self.nulls not in ("drop", "keep"):
            raise ValueError(f"unknown nulls mode {self.nulls!r}")
        if self.window_start not in ("point", "fixed_step"):
            raise ValueError(f"unknown window_start {self.window_start!r}")
        if self.length < 1 or self.n_tests < 0:
            raise ValueError("length must be positive and n_tests not negative")
