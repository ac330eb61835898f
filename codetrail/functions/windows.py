"""Historical floors and incremental look-back windows.

The models never call ``current_date``/``now()``: the run instant ``as_of`` is an
argument, so runs are reproducible. Bounds are turned into literals on the driver so
Parquet filter pushdown and partition pruning see plain ``col >= literal`` predicates.
A date bound is always emitted next to a time bound: Spark does not derive one from the
other, and only the date bound prunes ``block_date`` partitions.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from codetrail.functions.literals import typed_lit

# The historical floors of the reference models.
DEFAULT_FLOOR_DATE = dt.date(2026, 5, 1)
DEFAULT_FLOOR_TIME = dt.datetime(2026, 5, 1, 23, 22, 42)
DEFAULT_PRICE_FLOOR = dt.datetime(2026, 5, 1, 0, 0, 0)

# Look-back lengths of the incremental runs.
TX_LOOKBACK_DAYS = 1
TX_LOOKBACK_HOURS = 12
METRIC_LOOKBACK_DAYS = 2


@dataclass(frozen=True)
class Floors:
    """Historical start of the models (first-run / full-refresh lower bound)."""

    date: dt.date = DEFAULT_FLOOR_DATE
    time: dt.datetime = DEFAULT_FLOOR_TIME
    price_time: dt.datetime = DEFAULT_PRICE_FLOOR

    def date_pred(self, date_col: str = "block_date") -> Column:
        return F.col(date_col) >= typed_lit(self.date)

    def time_pred(self, time_col: str = "block_time") -> Column:
        return F.col(time_col) >= typed_lit(self.time)

    def tx_pred(self, date_col: str = "block_date", time_col: str = "block_time") -> Column:
        return self.date_pred(date_col) & self.time_pred(time_col)

    def price_pred(self, ts_col: str = "timestamp") -> Column:
        return F.col(ts_col) >= typed_lit(self.price_time)


def utc_naive(instant: dt.datetime) -> dt.datetime:
    """The instant as UTC wall-clock time; one without an offset is UTC already."""
    return instant if instant.tzinfo is None else instant.astimezone(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Lookback:
    """Incremental window: rows with date >= as_of_date - days and time >= as_of - hours.

    ``hours=None`` means date-only (the metric model).
    """

    as_of: dt.datetime
    days: int
    hours: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "as_of", utc_naive(self.as_of))

    @property
    def date_bound(self) -> dt.date:
        return self.as_of.date() - dt.timedelta(days=self.days)

    @property
    def time_bound(self) -> dt.datetime | None:
        return None if self.hours is None else self.as_of - dt.timedelta(hours=self.hours)

    @property
    def day_start(self) -> dt.datetime:
        """The date bound as a midnight timestamp (date compared with a timestamp)."""
        return dt.datetime.combine(self.date_bound, dt.time())

    def date_pred(self, date_col: str = "block_date") -> Column:
        return F.col(date_col) >= typed_lit(self.date_bound)

    def pred(self, date_col: str = "block_date", time_col: str = "block_time") -> Column:
        p = self.date_pred(date_col)
        if self.time_bound is not None:
            p = p & (F.col(time_col) >= typed_lit(self.time_bound))
        return p

    def ts_pred(self, ts_col: str) -> Column:
        """Timestamp column against the date bound (prices: ``timestamp >= current_date - 2 days``)."""
        return F.col(ts_col) >= typed_lit(self.day_start)


def tx_window(as_of: dt.datetime | None) -> Lookback | None:
    """Window of the first two models; ``None`` (full refresh / first run) disables it."""
    return None if as_of is None else Lookback(as_of, TX_LOOKBACK_DAYS, TX_LOOKBACK_HOURS)


def metric_window(as_of: dt.datetime | None) -> Lookback | None:
    return None if as_of is None else Lookback(as_of, METRIC_LOOKBACK_DAYS)


def target_bound(as_of: dt.datetime | None, target_days: int | None, date_col: str = "block_date") -> Column | None:
    """Rows of a target table that an incremental run may replace: the last ``target_days`` days (None: all)."""
    return None if as_of is None or target_days is None else Lookback(as_of, target_days).date_pred(date_col)


def apply_window(df, window: Lookback | None, date_col: str = "block_date", time_col: str = "block_time"):
    """Conditional filter: only on incremental runs."""
    return df if window is None else df.where(window.pred(date_col, time_col))
