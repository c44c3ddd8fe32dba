"""Time windows and idempotent replacement (FIL1-4, SNK8-11, SNK13, INC2, INC5).

Windows are half-open ``[start, end)`` typed timestamps, compared directly to
the column so the predicate stays sargable (pushed to the Parquet reader).

``replace_window`` / ``replace_slice`` are the pure DataFrame meaning of the
source's "DELETE the window, then INSERT the new rows": keep every existing row
the delete would not remove (a NULL condition does not delete), then append the
new rows. Physically the sinks overwrite exactly one partition instead
(``pagetrail.sinks.tables``).
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ntz(value: datetime) -> Column:
    """A zone-less timestamp literal (independent of the session time zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def is_one_of(ts: str, hours: list[datetime]) -> Column:
    """The zone-less timestamp column ``ts`` equals one of the given times."""
    listed = ", ".join(f"TIMESTAMP_NTZ'{h:%Y-%m-%d %H:%M:%S}'" for h in hours)
    return F.expr(f"`{ts}` IN ({listed})") if hours else F.lit(False)


def truncate_hour(ts: Column) -> Column:
    """The hour of a TIMESTAMP_NTZ, computed from its fields (no time-zone round trip)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def in_window(ts: Column, start: datetime, end: datetime | None = None) -> Column:
    """``ts >= start and ts < end`` (``end=None``: no upper bound)."""
    cond = ts >= ntz(start)
    if end is not None:
        cond = cond & (ts < ntz(end))
    return cond


def hour_window(hour: datetime) -> tuple[datetime, datetime]:
    """FIL1: ``date_trunc('hour', ts) = hour`` as a half-open range."""
    h = hour.replace(minute=0, second=0, microsecond=0)
    return h, h + timedelta(hours=1)


def day_window(day: date | datetime) -> tuple[datetime, datetime]:
    """FIL2 / FIL8: ``date(ts) = day`` as a half-open range."""
    d = datetime(day.year, day.month, day.day)
    return d, d + timedelta(days=1)


def month_window(day: date | datetime) -> tuple[datetime, datetime]:
    """The calendar month of ``day`` (INC5, without the +32-day overshoot)."""
    start = datetime(day.year, day.month, 1)
    nxt = datetime(day.year + (day.month == 12), day.month % 12 + 1, 1)
    return start, nxt


def replace_window(existing: DataFrame, new: DataFrame, ts_col: str,
                   start: datetime, end: datetime) -> DataFrame:
    """SNK8-10: existing rows outside ``[start, end)`` plus ``new``."""
    doomed = F.coalesce(in_window(F.col(ts_col), start, end), F.lit(False))
    return existing.filter(~doomed).unionByName(new.select(*existing.columns))


def replace_slice(existing: DataFrame, new: DataFrame, col: str, value) -> DataFrame:
    """SNK11: existing rows with ``col <> value`` (or NULL) plus ``new``."""
    doomed = F.coalesce(F.col(col) == F.lit(value), F.lit(False))
    return existing.filter(~doomed).unionByName(new.select(*existing.columns))


def straddling_rows(parsed_good: DataFrame, path_hour_col: str = "path_hour") -> DataFrame:
    """SNK13 / FIL3: rows whose own time lies outside the hour their file was filed under.

    Returns the row's target month (``target_month``) and whether it lies before
    or after its file's hour; with row-derived partition values no row is moved.
    """
    ts = F.col("time_received")
    hour = F.col(path_hour_col)
    earlier = ts < hour
    later = ts >= hour + F.expr("INTERVAL 1 HOUR")
    return (parsed_good.filter(earlier | later)
            .select("filename", "line_number", "time_received", hour.alias("path_hour"),
                    F.trunc(F.to_date(ts), "month").alias("target_month"),
                    F.when(earlier, F.lit("earlier")).otherwise(F.lit("later")).alias("direction")))


def hourly_slices(df: DataFrame, ts_col: str = "time_received") -> DataFrame:
    """INC2: rows per half-open hour slice (``slice_start``, ``n_rows``)."""
    return (df.groupBy(truncate_hour(F.col(ts_col)).alias("slice_start"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
