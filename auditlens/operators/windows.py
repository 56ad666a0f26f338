"""Time-bucketed window operators that split hot keys.

A plain ``Window.partitionBy(user)`` puts every row of a user into one task;
one service account may hold a third of all logins. The rules only look a
bounded ``horizon`` back (600 s by default), so rows are partitioned by
(key, time bucket) instead, with bucket >= horizon. A row whose time lies
within ``horizon`` of its bucket's end is also copied into the next bucket as
context; results are kept for the home rows only. This is exact:
every row sees all rows of its key in ``[t - horizon, t]``, and a hot key is
spread over as many tasks as it has buckets. Only tail rows are duplicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_S = 3600


def _bucket_size(horizon_s: int, bucket_s: int | None) -> int:
    """Explicit size (at least the horizon), else max(1 h, 4 x horizon): at
    most a quarter of the rows are copied as context."""
    if bucket_s:
        return max(int(bucket_s), int(horizon_s), 1)
    return max(DEFAULT_BUCKET_S, 4 * int(horizon_s), 1)


def with_context(df: DataFrame, ts_s: str, horizon_s: int, bucket_s: int | None = None) -> DataFrame:
    """Adds ``_bucket`` and ``_home``; tail rows appear twice (home + context)."""
    size = _bucket_size(horizon_s, bucket_s)
    t = F.col(ts_s)
    tail = F.pmod(t, F.lit(size)) >= F.lit(size - horizon_s)
    shift = F.explode(F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (df.withColumn("_shift", shift)
            .withColumn("_bucket", F.floor(t / F.lit(size)) + F.col("_shift"))
            .withColumn("_home", F.col("_shift") == 0)
            .drop("_shift"))


def range_count(df: DataFrame, keys: list[str], ts_s: str, horizon_s: int,
                out: str = "window_count", bucket_s: int | None = None) -> DataFrame:
    """For every row: rows of the same key with ``ts_s`` in [t - horizon, t]
    (inclusive; equal times are peers). Rows with a NULL time get NULL."""
    ctx = with_context(df, ts_s, horizon_s, bucket_s)
    w = (Window.partitionBy(*keys, "_bucket").orderBy(F.col(ts_s))
         .rangeBetween(-int(horizon_s), 0))
    return (ctx.withColumn(out, F.count(F.lit(1)).over(w))
            .filter(F.col("_home")).drop("_bucket", "_home"))


def lag_within(df: DataFrame, keys: list[str], order: list[Column | str], ts_s: str,
               horizon_s: int, cols: dict[str, str], bucket_s: int | None = None) -> DataFrame:
    """``lag(1)`` of ``cols`` (source -> output name) per key, exact whenever
    the previous row is less than ``horizon_s`` seconds (floored) earlier;
    otherwise the lag may be NULL. Callers must discard rows whose gap is
    ``>= horizon_s``."""
    ctx = with_context(df, ts_s, horizon_s, bucket_s)
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    for src, dst in cols.items():
        ctx = ctx.withColumn(dst, F.lag(src).over(w))
    return ctx.filter(F.col("_home")).drop("_bucket", "_home")
