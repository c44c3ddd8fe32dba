"""SRC10-12: "is there data yet" predicates, as one-row DataFrames.

The source polled these with SQL sensors; here they are plain existence checks
(``EXISTS``) that stop scanning at the first qualifying row. A scheduler can
call them and decide; no polling loop is built.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import in_window


def window_ready(df: DataFrame, start: datetime, end: datetime | None = None,
                 ts_col: str = "time_received") -> DataFrame:
    """One row ``ready``: any row in ``[start, end)`` (``end=None``: ``>= start``)."""
    hit = df.filter(in_window(F.col(ts_col), start, end)).select(F.lit(1).alias("_one")).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("ready"))


def day_closed(df: DataFrame, day: date, ts_col: str = "time_received") -> DataFrame:
    """One row ``ready``: any row at or after ``day`` 23:00 (later days count too)."""
    last_hour = datetime(day.year, day.month, day.day) + timedelta(hours=23)
    return window_ready(df, last_hour, None, ts_col)
