"""Where history ends and the target starts, in one object."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.columns import as_ntz, col, shift_days


@dataclass(frozen=True)
class FeatureSpec:
    """Cutoff, target horizon and look-back windows.

    ``bounds='left'``: history < cutoff, target in [cutoff, cutoff + horizon),
    look-back >= cutoff - n. ``bounds='right'``: history <= cutoff, target in
    (cutoff, cutoff + horizon], look-back > cutoff - n.
    """

    cutoff: str
    horizon_days: int = 30
    lookbacks: tuple[int, ...] = (30, 60, 90, 180, 365)
    bounds: str = "left"

    def __post_init__(self):
        if self.bounds not in ("left", "right"):
            raise ValueError("bounds must be 'left' or 'right'")

    @property
    def at(self) -> Column:
        return as_ntz(self.cutoff)

    def history(self, ts: Column | str) -> Column:
        ts = col(ts)
        return ts < self.at if self.bounds == "left" else ts <= self.at

    def future(self, ts: Column | str) -> Column:
        ts, end = col(ts), shift_days(self.at, self.horizon_days)
        if self.bounds == "left":
            return (ts >= self.at) & (ts < end)
        return (ts > self.at) & (ts <= end)

    def relevant(self, ts: Column | str) -> Column:
        """History or target window: one range that reaches the file scan."""
        ts, end = col(ts), shift_days(self.at, self.horizon_days)
        return ts < end if self.bounds == "left" else ts <= end

    def lookback(self, ts: Column | str, days: int) -> Column:
        ts, start = col(ts), shift_days(self.at, -days)
        recent = ts >= start if self.bounds == "left" else ts > start
        return self.history(ts) & recent


def history_rows(header: DataFrame, spec: FeatureSpec, ts: str = "transaction_date") -> DataFrame:
    return header.filter(spec.history(ts))


def future_rows(header: DataFrame, spec: FeatureSpec, ts: str = "transaction_date") -> DataFrame:
    return header.filter(spec.future(ts))


def known_customers(header: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Distinct customers with history: the base of every feature table."""
    rows = history_rows(header, spec).filter(F.col("customer_id").isNotNull())
    return rows.select("customer_id").distinct()
