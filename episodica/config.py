"""Study parameters shared by every job."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class TimeSplit:
    """One train/test split; every bound is inclusive."""

    split_id: int
    train_start: date
    train_end: date
    test_start: date
    test_end: date


# The three one-year splits with a gap year in between.
YEARLY_SPLITS = tuple(
    TimeSplit(i, date(y, 1, 1), date(y, 12, 31), date(y + 2, 1, 1), date(y + 2, 12, 31))
    for i, y in enumerate((2007, 2011, 2015))
)

# Shares of the population (percent) at which scores are cut.
CUTOFFS = (1.0, 2.0, 5.0, 10.0, 20.0, 30.0, 50.0)


@dataclass(frozen=True)
class Study:
    """Window, horizon and coding rules of one cohort study."""

    begin: date = date(2007, 1, 1)
    end: date = date(2018, 1, 1)
    horizon_days: int = 365
    no_return: date = date(2080, 1, 1)
    days_per_year: float = 365.0
    felony: str = "FELON"
    misdemeanor: str = "MISD"
    allow_negative_gap: bool = True
    history_order: str = "release_date"
    splits: tuple[TimeSplit, ...] = YEARLY_SPLITS
    cutoffs: tuple[float, ...] = field(default=CUTOFFS)


# Dates outside the nanosecond range count as missing. Fixed values.
DATE_MIN = date(1677, 9, 22)
DATE_MAX = date(2262, 4, 11)
