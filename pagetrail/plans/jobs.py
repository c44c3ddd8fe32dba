"""End-to-end runs: each reads its inputs, applies the operators and replaces
exactly its own slice of output, so any run can be repeated (retries,
backfills, late data) and gives the same tables.

These are the scheduled units of the source pipeline, re-expressed as plain
functions with typed arguments; scheduling, sensing and retries belong to
whatever orchestrator calls them (``pagetrail.operators.readiness`` holds the
predicates a sensor would test).

Order inside a run (INC7): write the rows, then the data-quality tables, so a
failure never leaves quality rows describing rows that were not written; every
write replaces its own partition, so re-running after a failure is safe. Every ingest
notes the event hours it touches (before it writes, and after), which is what
:func:`derive_changes` follows.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import HOURLY, RAW_COLUMNS
from ..operators import pages, snapshot, views, visitors, windows
from ..session import scratch_path
from ..sinks import commits, tables
from ..sinks.visitor_state import BUCKETS, VisitorState
from ..sources.logfiles import SOURCE_LAYOUT, path_hour
from .staging import ParsedFiles, parse_files


def _load_hours(spark: SparkSession, parsed: ParsedFiles, warehouse: str, hours: list[datetime], strict: bool, layout: str) -> DataFrame:
    """Replace everything the ingest ``hours`` loaded by the parsed files; returns the quality rows."""
    filed = (lambda df: df.withColumn("_ingest_hour", windows.ntz(hours[0])) if len(hours) == 1
             else df.withColumn("_ingest_hour", path_hour(F.col("filename"), layout)))
    good = filed(parsed.good(strict=strict, with_file=True)).drop("filename")
    touched = commits.event_hours(good.select("time_received").unionByName(
        tables.raw_hours(spark, f"{warehouse}/raw_logs", hours)))
    name = f"batch-{hours[0]:%Y%m%d%H}-{hours[-1]:%Y%m%d%H}"
    kept = scratch_path(spark, "touched")
    touched.write.parquet(kept)  # the old rows are gone when it is asked for again
    touched = spark.read.parquet(kept)
    commits.record_change(touched, warehouse, f"{name}-intent")
    tables.write_raw_hours(good, f"{warehouse}/raw_logs", hours, "_ingest_hour")
    for rows, table in ((parsed.rejected(), "rejected_lines"), (parsed.samples(), "raw_regex_failure_lines"),
                        (parsed.quality(), "files_processed")):
        tables.write_loads(filed(rows), f"{warehouse}/{table}", hours, "_ingest_hour")
    commits.record_change(touched, warehouse, name)
    tables.delete(spark, kept)
    parsed.drop()
    done = tables.read_known(spark, f"{warehouse}/files_processed",
                             "filename STRING, file_line_count BIGINT, file_bad_lines BIGINT, file_regex_failed BIGINT, "
                             "ingest_date DATE, ingest_hour INT, load STRING")
    own = F.lit(False)
    for d, hs in tables._by_date(hours).items():
        own = own | ((F.col("ingest_date") == F.lit(d)) & F.col("ingest_hour").isin(*hs))
    return done.where(own)


def ingest_hour(spark: SparkSession, logs_root: str, warehouse: str, hour: datetime, mode: str = HOURLY,
                strict: bool = False, layout: str = SOURCE_LAYOUT) -> DataFrame:
    """Parse the files filed under ``hour`` and replace that ingest hour in the raw table.

    Writes ``raw_logs`` (by event date and ingest hour), ``files_processed`` and
    ``raw_regex_failure_lines`` (hourly mode; the backfill kept no samples) and
    ``rejected_lines``. Returns the per-file quality rows.
    """
    hour = hour.replace(minute=0, second=0, microsecond=0)
    parsed = parse_files(spark, logs_root, hour=hour, mode=mode, layout=layout)
    return _load_hours(spark, parsed, warehouse, [hour], strict, layout)


def ingest_day(spark: SparkSession, logs_root: str, warehouse: str, day: date, mode: str = "backfill",
               layout: str = SOURCE_LAYOUT) -> DataFrame:
    """The one-off daily backfill: all files under ``day`` in one job.

    Each row keeps the ingest hour of its file's path, so the day lands in the
    same (ingest_date, ingest_hour) partitions the hourly run writes; the day's
    24 hours are replaced together. The backfill kept no failure samples.
    """
    start = datetime(day.year, day.month, day.day)
    parsed = parse_files(spark, logs_root, day=day, mode=mode, layout=layout)
    return _load_hours(spark, parsed, warehouse, [start + timedelta(hours=h) for h in range(24)], False, layout)


def raw_window(spark: SparkSession, warehouse: str, start: datetime | None, end: datetime | None = None) -> DataFrame:
    """Raw rows of a time window, of committed loads."""
    known = commits.committed(spark, warehouse)
    return tables.read_ingested(spark, f"{warehouse}/raw_logs", start, end, known).select(*RAW_COLUMNS)


def page_log_run(spark: SparkSession, warehouse: str, blacklist: DataFrame, start: datetime,
                 end: datetime) -> None:
    """Replace ``user_page_log`` for ``[start, end)`` (normally one hour)."""
    raw = raw_window(spark, warehouse, start, end)
    tables.write_window(pages.user_page_log(raw, blacklist, start, end), f"{warehouse}/user_page_log", start, end)
    days = {h.date() for h, _ in hourly_runs(start, end)}
    VisitorState(spark, warehouse).drop_days(sorted(days))  # the visitor run finds them anew


def page_log_window(spark: SparkSession, warehouse: str, start: datetime | None,
                    end: datetime | None = None) -> DataFrame:
    return tables.read_window(spark, f"{warehouse}/user_page_log", start, end,
                              schema=tables.PAGE_LOG_DDL).drop("row_added")


def bounty_view_run(spark: SparkSession, warehouse: str, start: datetime, end: datetime) -> None:
    """Replace ``log_bounty_view`` for ``[start, end)``."""
    rows = views.bounty_views(page_log_window(spark, warehouse, start, end), start, end)
    tables.write_window(rows, f"{warehouse}/log_bounty_view", start, end)


def _page_log_days(spark: SparkSession, warehouse: str, days: list[date]) -> DataFrame:
    """The page log of some dates, with its partition column: only their folders are read."""
    return tables.read_dates(spark, f"{warehouse}/user_page_log", days, "event_date DATE, event_hour INT",
                             tables.PAGE_LOG_DDL).drop("row_added", "event_hour")


def _visitors_of(spark: SparkSession, warehouse: str, days: list[date]) -> DataFrame:
    log = _page_log_days(spark, warehouse, days)
    return log.select("user_id_uuid", "user_id", F.col("event_date").alias("visited"))


def _stored_days(spark: SparkSession, root: str, key: str) -> list[date]:
    found = tables._partitions(spark, root, [None])
    return sorted(date.fromisoformat(d.rsplit(f"{key}=", 1)[1]) for d in found if f"{key}=__" not in d)


def visitor_run(spark: SparkSession, warehouse: str, day: date, buckets: int = BUCKETS) -> None:
    """Replace the ``ymd = day`` slice of ``agg_visitor_previous_visit``.

    Past visits come from the visitor state, a row per visitor and day bucketed by uuid, to which days
    of the page log that it does not hold yet are added first.
    """
    visitor_days_run(spark, warehouse, [day], buckets)


def visitor_days_run(spark: SparkSession, warehouse: str, days: list[date], buckets: int = BUCKETS) -> None:
    """Replace the slices of several days, from one pass over their page log and the visitor state."""
    if not days:
        return
    last = max(days) - timedelta(days=1)
    state = VisitorState(spark, warehouse, buckets)
    known = set(state.days())
    missing = [d for d in _stored_days(spark, f"{warehouse}/user_page_log", "event_date") if d <= last and d not in known]
    state.put_days(missing, _visitors_of(spark, warehouse, missing))
    if last.day == 1 and min(days) > last and last in set(state.days()):
        state.put_upto(last)  # once a month, so that a run reads a month of days at most
    history = state.visits(last, min(days)).withColumnRenamed("visited", "ymd")
    rows = visitors.visitor_previous_visits(_page_log_days(spark, warehouse, days), days, history=history)
    tables.write_slices(rows, f"{warehouse}/agg_visitor_previous_visit", days)
    state.close()


def snapshot_run(spark: SparkSession, warehouse: str, bounties: DataFrame, ds: date) -> None:
    """Replace the ``ymd = ds`` slice of ``agg_bounty_snapshot``."""
    tables.write_slice(snapshot.bounty_snapshot(bounties, ds), f"{warehouse}/agg_bounty_snapshot", ds)


def hourly_runs(start: datetime, end: datetime):
    """INC2: the half-open hour slices an hourly schedule covers for ``[start, end)``."""
    h, _ = windows.hour_window(start)
    while h < end:
        yield h, h + timedelta(hours=1)
        h += timedelta(hours=1)


def derive_changes(spark: SparkSession, warehouse: str, blacklist: DataFrame, consumer: str = "derived",
                   through: date | None = None, buckets: int = BUCKETS) -> tuple[list[datetime], list[date]]:
    """INC6: re-derive what the raw log's changes since the last call touch, and nothing else.

    Follows the change feed (:mod:`pagetrail.sinks.commits`): the page log and views of the touched event hours
    are replaced; then the visitor slices of the touched days, and of those later days whose answer a
    change of visitors on a touched day reaches (up to that visitor's next visit). Slices are re-run only for
    days that have one, or, with ``through``, up to that day. Partitions not named in the
    result keep their files. The changes are marked as worked off last, so a failed call is repeated whole.
    Returns (event hours, days of visitor slices) replaced.
    """
    changes = commits.pending(spark, warehouse, consumer)
    if not changes:
        return [], []
    hours = commits.changed_hours(spark, warehouse, changes)
    days = sorted({h.date() for h in hours})
    # page log and views of the touched hours
    raw = tables.read_dates(spark, f"{warehouse}/raw_logs", days, "event_date DATE, ingest_date DATE, ingest_hour INT, load STRING",
                            tables.RAW_LOGS_DDL).where(commits.committed(spark, warehouse)).select(*RAW_COLUMNS)
    if hours:
        lo, hi = hours[0], hours[-1] + timedelta(hours=1)
        tables.write_hours(pages.user_page_log(raw, blacklist, lo, hi), f"{warehouse}/user_page_log", hours)
        log = _page_log_days(spark, warehouse, days).drop("event_date")
        tables.write_hours(views.bounty_views(log, lo, hi), f"{warehouse}/log_bounty_view", hours)
    # visitors that came or went on the touched days
    state = VisitorState(spark, warehouse, buckets)
    kept = scratch_path(spark, "visitors-before")
    state.day(days).write.parquet(kept)
    before = spark.read.parquet(kept)
    state.put_days(days, _visitors_of(spark, warehouse, days))
    after = state.day(days)
    changed = before.exceptAll(after).unionByName(after.exceptAll(before))
    slices = set(_stored_days(spark, f"{warehouse}/agg_visitor_previous_visit", "ymd"))
    if through is not None:
        slices |= {d for d in _stored_days(spark, f"{warehouse}/user_page_log", "event_date") if d <= through}
    later = state.day([d for d in state.days() if days and d > days[0]])
    reached = _reached_days(changed, later) if slices else set()
    rerun = sorted((set(days) | reached) & slices)
    visitor_days_run(spark, warehouse, rerun, buckets)
    tables.delete(spark, kept)
    state.close()
    commits.mark_done(spark, warehouse, consumer, changes)
    return hours, rerun


def _reached_days(changed: DataFrame, later: DataFrame) -> set[date]:
    """Days after a changed visit on which the same uuid was seen, up to that visitor's own next visit."""
    c = changed.select("user_id_uuid", "user_id", F.col("visited").alias("changed_on")).distinct()
    own = later.select(F.col("user_id_uuid").alias("_u"), F.col("user_id").alias("_i"), F.col("visited").alias("_d"))
    same = (F.col("_u") == F.col("user_id_uuid")) & F.col("_i").eqNullSafe(F.col("user_id")) & (F.col("_d") > F.col("changed_on"))
    until = c.join(own, same, "left").groupBy("user_id_uuid", "changed_on", "user_id").agg(F.min("_d").alias("until"))
    seen = later.select(F.col("user_id_uuid").alias("_u"), F.col("visited").alias("_d")).distinct()
    hit = (F.col("_u") == F.col("user_id_uuid")) & (F.col("_d") > F.col("changed_on")) & (F.col("until").isNull() | (F.col("_d") <= F.col("until")))
    return {r["_d"] for r in until.join(seen, hit).select("_d").distinct().collect()}  # days


def reprocess(spark: SparkSession, logs_root: str, warehouse: str, blacklist: DataFrame, bounties: DataFrame | None,
              start: datetime, end: datetime, layout: str = SOURCE_LAYOUT, through: date | None = None,
              buckets: int = BUCKETS) -> None:
    """INC6: pick up late or corrected files for ``[start, end)`` (whole hours).

    Ingests every hour again and follows the change feed (:func:`derive_changes`), visitor slices
    up to ``through`` (default: those there are, and the touched days). Snapshots are re-stamped for the touched days if
    ``bounties`` is given. Each step replaces only its own partitions, so the call can be repeated.
    """
    hours = list(hourly_runs(start, end))
    for lo, _ in hours:
        ingest_hour(spark, logs_root, warehouse, lo, layout=layout)
    touched = sorted({lo.date() for lo, _ in hours})
    done = _stored_days(spark, f"{warehouse}/agg_visitor_previous_visit", "ymd")
    derive_changes(spark, warehouse, blacklist, through=through or max([*done, touched[-1]]), buckets=buckets)
    if bounties is not None:
        for day in touched:
            snapshot_run(spark, warehouse, bounties, day)
