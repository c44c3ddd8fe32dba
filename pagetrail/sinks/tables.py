"""SNK1-15: partitioned Parquet tables and idempotent window replacement.

Layout decisions (the source's PostgreSQL child tables are re-aimed):

* raw log: partitioned by event date, then by the **ingest** hour
  (``event_date``/``ingest_date``/``ingest_hour``, the latter from the file
  path), then by ``load``. Re-running an hour replaces exactly that hour's files' rows, whatever
  times they carry, so rows that straddle hours are neither lost nor loaded
  twice; readers of a time window list only its event dates. The batch run of an
  hour is the load ``batch`` and replaces all loads of the hour; a micro-batch of the stream
  is a load of its own and replaces only itself, and is read once it is committed
  (:mod:`pagetrail.sinks.commits`). The quality tables have the same last levels.
* derived tables (page log, views): partitioned by the **event** date and hour,
  so "delete window then insert" is a static overwrite of those partitions.
* daily aggregates / snapshots: partitioned by ``ymd``.

Replacing a window is one dynamic partition overwrite, after which partitions of
the window that got no rows are dropped; a slice or a single hour is a static
overwrite of its directory. Rows are sorted by ``time_received`` within each file so Parquet
row-group min/max statistics skip data for narrow windows (the role of the
source's BRIN index). ``row_added`` is stamped at write time.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import in_window, is_one_of, ntz, truncate_hour


#: The load that the batch run of an ingest hour writes.
BATCH_LOAD = "batch"


def _file_system(spark: SparkSession, path: str):
    """(the path's own Hadoop file system, the path): names go to it as they are, never as patterns."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def _partitions(spark: SparkSession, root: str, levels: list[set[str] | None]) -> dict[str, tuple[str, ...]]:
    """Partition directories below ``root``, each with its file names.

    ``levels`` gives the directory names wanted at each level (None: all). Asked from the table's
    own file system; a listing that fails (denied, timed out) raises instead of reading as empty.
    """
    fs, at = _file_system(spark, root)
    level = [at] if fs.exists(at) else []
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for names in levels:
        below = []
        for d in level:
            if names is not None and len(names) == 1:
                below += [c for c in [Path(d, next(iter(names)))] if fs.exists(c)]
            else:
                below += [s.getPath() for s in fs.listStatus(d) if s.isDirectory() and "=" in s.getPath().getName()
                          and (names is None or s.getPath().getName() in names)]
        level = below
    return {d.toString(): tuple(sorted(f.getPath().getName() for f in fs.listStatus(d) if f.isFile())) for d in level}


def _replace(rows: DataFrame, root: str, keys: list[str], wanted: list[list[set[str] | None]],
             sort_by: str | None = None, many_small: bool = False) -> None:
    """Make the partitions that ``wanted`` describes hold exactly ``rows``, each file sorted by ``sort_by``.

    Rows are gathered by partition before they are written, so that the number of files follows
    the partitions and the rows' bytes and not the number of tasks that held the rows: a small partition is one
    file, a large one is split over several tasks. Adaptive execution would gather a table of little text in one
    task, which then writes all its files one after another; with ``many_small`` the partitions are dealt to
    all shuffle partitions instead.

    One job overwrites every partition it has rows for when it commits; then the
    matching partitions that it did not touch (their files are the same as before)
    are dropped. Until then a reader sees the old rows, never none, and a run that
    fails in between can simply be repeated.
    """
    spark = rows.sparkSession
    before = {d: files for levels in wanted for d, files in _partitions(spark, root, levels).items()}
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gathered = rows.repartition(number, *keys) if many_small else rows.hint("rebalance", *keys)
    gathered = gathered.sortWithinPartitions(*keys, *([sort_by] if sort_by else []))
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)
    after = {d: files for levels in wanted for d, files in _partitions(spark, root, levels).items()}
    for d in sorted(before):
        if after.get(d) == before[d]:
            delete(spark, d)


def _by_date(hours: list[datetime]) -> dict[date, set[int]]:
    out: dict[date, set[int]] = {}
    for h in hours:
        out.setdefault(h.date(), set()).add(h.hour)
    return out


def write_loads(rows: DataFrame, root: str, hours: list[datetime], hour_col: str | None = None, load: str = BATCH_LOAD,
                by_event_date: bool = False, sort_by: str | None = None) -> None:
    """SNK1-3, SNK8-9: replace what ``load`` brought for the ingest ``hours`` (the batch load: what any load brought).

    ``hour_col`` names a TIMESTAMP_NTZ column with each row's ingest hour, which must be one of ``hours`` (others
    fail the run); without it all rows belong to the single hour. One job.
    """
    if not hours:
        return
    if hour_col is None:
        (h,) = hours
        rows, hour_col = rows.withColumn("_ingest_hour", ntz(h)), "_ingest_hour"
    hour = F.col(hour_col)
    known = F.when(is_one_of(hour_col, hours), hour).otherwise(
        F.raise_error(F.concat(F.lit("row of an hour that is not replaced: "), F.coalesce(hour.cast("string"), F.lit("none")))))
    out = rows.withColumn("row_added", F.localtimestamp()).withColumn(hour_col, known)
    if by_event_date:
        out = out.withColumn("event_date", F.to_date(F.col("time_received")))
    out = (out.withColumn("ingest_date", F.to_date(hour)).withColumn("ingest_hour", F.hour(hour)).withColumn("load", F.lit(load))
           .drop(hour_col))
    keys = [*(["event_date"] if by_event_date else []), "ingest_date", "ingest_hour", "load"]
    loads = None if load == BATCH_LOAD else {f"load={load}"}
    wanted = [[*([None] if by_event_date else []), {f"ingest_date={d:%Y-%m-%d}"}, {f"ingest_hour={h}" for h in hs}, loads]
              for d, hs in _by_date(hours).items()]
    _replace(out, root, keys, wanted, sort_by, many_small=not by_event_date)


def write_raw_hours(rows: DataFrame, root: str, hours: list[datetime], hour_col: str | None = None, load: str = BATCH_LOAD) -> None:
    """SNK1 / SNK8-9 for the raw log: replace what the files of ``hours`` loaded.

    Layout ``event_date=E/ingest_date=D/ingest_hour=H/load=L``: readers of a time
    window list only its event dates (exact, since ``event_date`` is the date of
    the row's own time), while a re-run of an ingest hour replaces that hour under
    every event date.
    """
    write_loads(rows, root, hours, hour_col, load, by_event_date=True, sort_by="time_received")


def write_hours(rows: DataFrame, root: str, hours: list[datetime], date_col: str = "event_date", hour_col: str = "event_hour") -> None:
    """SNK4-5 / SNK10 for any set of whole hours: their partitions hold exactly the ``rows`` of those hours."""
    ts = F.col("time_received")
    kept = rows.withColumn("_hour", truncate_hour(ts)).filter(is_one_of("_hour", hours)).drop("_hour")
    stamped = (kept.withColumn("row_added", F.localtimestamp())
               .withColumn(date_col, F.to_date(ts)).withColumn(hour_col, F.hour(ts)))
    wanted = [[{f"{date_col}={d:%Y-%m-%d}"}, {f"{hour_col}={h}" for h in hs}] for d, hs in _by_date(hours).items()]
    _replace(stamped, root, [date_col, hour_col], wanted, "time_received")


def write_window(rows: DataFrame, root: str, start: datetime, end: datetime,
                 date_col: str = "event_date", hour_col: str = "event_hour") -> None:
    """SNK4-5 / SNK10: make the hour partitions of ``[start, end)`` hold exactly ``rows`` of that window.

    One job overwrites the window's event hours by time-sorted files; a hot hour is
    spread over many tasks. Re-running the same window gives the same table.
    """
    if start.minute or start.second or end.minute or end.second:
        raise ValueError("write_window needs whole-hour bounds")
    ts = F.col("time_received")
    stamped = (rows.filter(in_window(ts, start, end))
               .withColumn("row_added", F.localtimestamp())
               .withColumn(date_col, F.to_date(ts))
               .withColumn(hour_col, F.hour(ts)))
    hours = [start + timedelta(hours=i) for i in range(int((end - start).total_seconds() // 3600))]
    wanted = [[{f"{date_col}={d:%Y-%m-%d}"}, None if len(hs) == 24 else {f"{hour_col}={h}" for h in hs}]
              for d, hs in _by_date(hours).items()]
    _replace(stamped, root, [date_col, hour_col], wanted, "time_received")


def write_slice(rows: DataFrame, root: str, day: date, col: str = "ymd") -> str:
    """SNK6-7 / SNK11: replace the ``ymd = day`` slice."""
    path = f"{root}/{col}={day:%Y-%m-%d}"
    rows.drop(col).write.mode("overwrite").parquet(path)
    return path


def write_slices(rows: DataFrame, root: str, days: list[date], col: str = "ymd") -> None:
    """SNK6-7 / SNK11 for several days: replace their slices in one job."""
    if days:
        _replace(rows, root, [col], [[{f"{col}={d:%Y-%m-%d}" for d in days}]])


# Stored schemas (without partition columns), used to read tables that have no files yet.
RAW_LOGS_DDL = ("pid INT, ip STRING, num_request_variables INT, packet_size INT, time_received TIMESTAMP_NTZ, "
                "http_method STRING, uri STRING, response_size INT, http_status INT, num_headers INT, "
                "header_size INT, switches INT, core INT, referrer STRING, user_agent STRING, has_wallet BOOLEAN, "
                "session_id STRING, user_id INT, user_id_uuid STRING, ga_ga STRING, ga_gid STRING, "
                "row_added TIMESTAMP_NTZ")
PAGE_LOG_DDL = ("time_received TIMESTAMP_NTZ, uri STRING, referrer STRING, user_agent STRING, has_wallet BOOLEAN, "
                "ip STRING, session_id STRING, user_id INT, user_id_uuid STRING, ga_ga STRING, ga_gid STRING, "
                "row_added TIMESTAMP_NTZ")
VIEW_LOG_DDL = ("time_received TIMESTAMP_NTZ, bounty_id INT, user_agent STRING, has_wallet BOOLEAN, ip STRING, "
                "session_id STRING, user_id INT, user_id_uuid STRING, ga_ga STRING, ga_gid STRING, "
                "row_added TIMESTAMP_NTZ")


def _as_is(path: str) -> str:
    """A path whose special characters Spark's readers, which take patterns, take as they are."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_known(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """A partitioned table by its full schema; empty while its folder does not exist."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(_as_is(root))


def read_table(spark: SparkSession, root: str, partition_schema: str, schema: str | None = None) -> DataFrame:
    """Read a partitioned table with its partition columns typed as given.

    ``partition_schema`` e.g. ``"event_date DATE, event_hour INT"``: stated
    explicitly because inference would turn ``07`` into an INT and a date into
    a DATE only by luck. With ``schema`` (the stored columns) a table that has
    no files yet reads as empty instead of failing.
    """
    if schema is not None:
        full = f"{schema}, {partition_schema}"
        if not exists(spark, root):
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", root).parquet(_as_is(root))
    df = spark.read.option("basePath", root).parquet(_as_is(root))
    for field in partition_schema.split(","):
        name, typ = field.strip().split()
        df = df.withColumn(name, F.col(name).cast(typ))
    return df


def read_window(spark: SparkSession, root: str, start: datetime | None, end: datetime | None = None,
                date_col: str = "event_date", hour_col: str = "event_hour", schema: str | None = None) -> DataFrame:
    """SRC5: rows of an event-partitioned table in ``[start, end)`` (``None``: unbounded).

    Both the partition predicate (prunes directories) and the row predicate
    (pushed into the Parquet scan) are applied.
    """
    df = read_table(spark, root, f"{date_col} DATE, {hour_col} INT", schema)
    ts = F.col("time_received")
    if start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start.date())).filter(ts >= ntz(start))
    if end is not None:
        df = df.filter(F.col(date_col) <= F.lit(end.date())).filter(ts < ntz(end))
    return df.drop(date_col, hour_col)


def read_dates(spark: SparkSession, root: str, days: list[date], partition_schema: str, schema: str) -> DataFrame:
    """Rows of an event-partitioned table on the given event dates; only their directories are listed and read."""
    paths = [p for p in (f"{root}/event_date={d:%Y-%m-%d}" for d in days) if exists(spark, p)]
    full = f"{schema}, {partition_schema}"
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).parquet(*map(_as_is, paths))


def raw_hours(spark: SparkSession, root: str, hours: list[datetime]) -> DataFrame:
    """(time_received) of the raw rows filed under the ingest hours, whatever load brought them."""
    paths = [d for day, hs in _by_date(hours).items()
             for d in _partitions(spark, root, [None, {f"ingest_date={day:%Y-%m-%d}"}, {f"ingest_hour={h}" for h in hs}, None])]
    if not paths:
        return spark.createDataFrame([], "time_received timestamp_ntz")
    return spark.read.schema("time_received TIMESTAMP_NTZ").parquet(*map(_as_is, paths))


def read_ingested(spark: SparkSession, root: str, start: datetime | None, end: datetime | None = None,
                  committed: Column | None = None) -> DataFrame:
    """Raw-log rows in ``[start, end)`` (``None``: unbounded).

    Only the event-date directories of the window are listed and read; the row
    predicate is pushed into the Parquet scan. ``committed`` (on the partition column
    ``load``) keeps out loads that are not committed yet.
    """
    parts = "event_date DATE, ingest_date DATE, ingest_hour INT, load STRING"
    if start is not None and end is not None:
        last = (end - timedelta(microseconds=1)).date()
        days = [start.date() + timedelta(days=i) for i in range((last - start.date()).days + 1)]
        df = read_dates(spark, root, days, parts, RAW_LOGS_DDL)
    else:
        df = read_table(spark, root, parts, RAW_LOGS_DDL)
        if start is not None:
            df = df.filter(F.col("event_date") >= F.lit(start.date()))
        if end is not None:
            df = df.filter(F.col("event_date") <= F.lit(end.date()))
    if committed is not None:
        df = df.filter(committed)
    return (df.filter(in_window(F.col("time_received"), start, end) if start is not None
                      else F.col("time_received") < ntz(end) if end is not None else F.lit(True))
            .drop("event_date", "ingest_date", "ingest_hour", "load"))
