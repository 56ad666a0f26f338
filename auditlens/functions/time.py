"""Detection windows.

Both ends are inclusive. A bound may be a string ('2025-02-25' means
midnight, ISO 'T' strings work), a datetime, a Column, or None; None means
``now - lookback`` for the lower and ``now`` for the upper end. Times are
UTC wall-clock (see :func:`auditlens.session.ensure_utc`).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "24 hours"
TWO_MONTHS = "2 months"
THIRTY_DAYS = "30 days"


def bound(value, lookback: str | None = None) -> Column:
    if isinstance(value, Column):
        return value
    if value is None:
        if lookback is None:
            return F.current_timestamp()
        return F.current_timestamp() - F.expr(f"INTERVAL {lookback}")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp")


def window_bounds(earliest, latest, lookback: str | None = DAY) -> tuple[Column, Column]:
    if earliest is None and lookback is None:
        raise ValueError("this rule needs an explicit earliest bound")
    return bound(earliest, lookback), bound(latest)


def in_window(time_col: str | Column, lo: Column, hi: Column) -> Column:
    c = F.col(time_col) if isinstance(time_col, str) else time_col
    return (c >= lo) & (c <= hi)


def window_filter(df: DataFrame, time_col: str, lo: Column, hi: Column,
                  date_partition: str = "event_date") -> DataFrame:
    """Inclusive time filter; when the table carries a date partition column
    the matching date range is added so the scan prunes partitions."""
    pred = in_window(time_col, lo, hi)
    if date_partition in df.columns:
        pred = pred & F.col(date_partition).between(F.to_date(lo), F.to_date(hi))
    return df.filter(pred)


def epoch_seconds(c: str | Column) -> Column:
    """Floor epoch seconds of a timestamp (LTZ or NTZ)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_seconds(c.cast("timestamp"))
