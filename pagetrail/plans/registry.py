"""Registered queries (Spark) and their DuckDB oracles.

Every query reads the given test tables at ``sf_dir`` through the adapters of
``pagetrail.sources.fixtures`` and runs the library's operators over the whole
tables. The oracle of a query is independent SQL over the same tables: the
adapters' SQL text is shared (so inputs are identical), the operator itself is
re-stated in plain SQL, and for the parser the oracle does not parse at all but
states the expected values straight from ``events``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import RAW_COLUMNS
from ..operators import pages, parse, quality, readiness, snapshot, views, visitors, windows
from ..session import scratch_path
from ..sinks import commits, tables
from ..sources import fixtures as fx
from ..sources import logfiles
from ..streaming import ingest as stream_ingest
from . import jobs, staging

# Parameters of the registered queries (the period of ``events`` is January 2024).
HOUR = datetime(2024, 1, 5, 10)
DAY = date(2024, 1, 5)
VISIT_DAY = date(2024, 1, 15)
PREV_DAY = date(2024, 1, 14)
SNAPSHOT_DS = date(2024, 1, 15)
MONTH = date(2024, 1, 1)
LATE = datetime(2024, 3, 1)

DUCK = fx.Dialect("duckdb")


def _lit_ts(ts: datetime) -> str:
    return f"TIMESTAMP '{ts:%Y-%m-%d %H:%M:%S}'"


def _lit_date(d: date) -> str:
    return f"DATE '{d:%Y-%m-%d}'"


# ---------------------------------------------------------------------------
# shared Spark inputs
# ---------------------------------------------------------------------------

def _page_log(spark, sf):
    return fx.page_log(spark, fx.load(spark, sf, "events"))


def _blacklist(spark, sf, with_null=False):
    return fx.blacklist(spark, fx.load(spark, sf, "nation"), with_null)


def _empty_blacklist(spark, sf):
    return fx.blacklist(spark, fx.load(spark, sf, "nation")).filter(F.lit(False))


def _lines(spark, sf, with_case=False):
    return fx.raw_lines(spark, fx.load(spark, sf, "events"), with_case)


def _parsed(spark, sf, mode="hourly"):
    return parse.parse_lines(_lines(spark, sf), mode)


# ---------------------------------------------------------------------------
# shared oracle SQL pieces
# ---------------------------------------------------------------------------

PAGE_LOG = f"({fx.page_log_sql('events')})"
BLACKLIST = f"({fx.blacklist_sql('nation')})"
BLACKLIST_NULL = f"({fx.blacklist_sql('nation', with_null=True)})"
BLACKLIST_EMPTY = f"(SELECT * FROM {BLACKLIST} b WHERE false)"
BOUNTIES = f"({fx.bounties_sql('orders')})"
LINE_BASE = f"({fx.line_base_sql(DUCK, 'events')})"
LINES = f"({fx.raw_lines_sql(DUCK, 'events')})"



def _good(mode_index: int, col: str = "c") -> str:
    """SQL predicate: the case number ``col`` yields a good line (1 hourly, 2 backfill)."""
    cases = [c for c, v in sorted(fx.LINE_CASES.items()) if v[mode_index] == "good"]
    return f"({col} IN ({', '.join(map(str, cases))}) OR {col} >= {max(fx.LINE_CASES) + 1})"


_GOOD_HOURLY = _good(1)
_GOOD_BACKFILL = _good(2)


def _case_outcome(mode_index: int) -> str:
    whens = " ".join(f"WHEN c = {c} THEN '{v[mode_index]}'" for c, v in sorted(fx.LINE_CASES.items()))
    return f"CASE {whens} ELSE 'good' END"


def _expected_raw(where: str) -> str:
    """Stored columns the parser must produce for the events selected by ``where``."""
    return f"""
SELECT CAST(event_id % 32768 AS INT) AS pid, ip,
  CAST(10 + event_id % 40 AS INT) AS num_request_variables,
  CAST(400 + event_id % 600 AS INT) AS packet_size,
  date_trunc('second', line_ts) AS time_received,
  method AS http_method, uri,
  CAST((event_id * 7) % 5000 AS INT) AS response_size,
  CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS INT) AS http_status,
  CAST(5 + event_id % 4 AS INT) AS num_headers,
  CAST(150 + event_id % 100 AS INT) AS header_size,
  CAST(1 + event_id % 3 AS INT) AS switches,
  CAST(event_id % 8 AS INT) AS core,
  referrer, agent AS user_agent,
  (c <> 19 AND event_type = 'purchase') AS has_wallet,
  'sess-' || CAST(user_id AS STRING) AS session_id,
  CASE WHEN c = 23 THEN NULL ELSE CAST(user_id AS INT) END AS user_id,
  CASE WHEN c = 23 THEN NULL ELSE uuid END AS user_id_uuid,
  CASE WHEN c = 23 THEN NULL ELSE 'GA1.2.' || CAST(user_id AS STRING) END AS ga_ga,
  CASE WHEN c = 23 THEN NULL ELSE 'GA1.2.' || CAST(event_id % 1000 AS STRING) END AS ga_gid
FROM {LINE_BASE} b WHERE {where}"""


def _not_listed(blacklist: str, agent: str = "p.user_agent") -> str:
    """The agent is on no entry of the list: always for an empty list, never for a NULL agent or a list with a NULL."""
    return f"""((SELECT count(*) FROM {blacklist} bl) = 0
   OR (user_agent IS NOT NULL AND (SELECT count(*) FROM {blacklist} bl WHERE bl.user_agent IS NULL) = 0
       AND (SELECT count(*) FROM {blacklist} bl WHERE bl.user_agent = {agent}) = 0))"""


def _page_log_window_sql(lo: datetime, hi: datetime, blacklist: str = BLACKLIST) -> str:
    return f"""
SELECT time_received, uri, referrer, user_agent, has_wallet, ip, session_id, user_id, user_id_uuid, ga_ga, ga_gid
FROM {PAGE_LOG} p
WHERE (NOT regexp_matches(uri, '^/notification/'))
  AND time_received >= {_lit_ts(lo)} AND time_received < {_lit_ts(hi)}
  AND {_not_listed(blacklist)}"""


def _daily_sql(day: date) -> str:
    """Page views of one calendar day per visitor."""
    return f"""
SELECT user_id_uuid, user_id, bool_or(has_wallet) AS has_wallet, count(*) AS pageviews
FROM {PAGE_LOG} p
WHERE time_received >= TIMESTAMP '{day:%Y-%m-%d} 00:00:00'
  AND time_received < TIMESTAMP '{day:%Y-%m-%d} 00:00:00' + INTERVAL 1 DAY
GROUP BY 1, 2"""


def _past_sql(day: date) -> str:
    """Of each visitor's days up to the cut-off, the one that no later day follows.

    The run of execution date E describes the day E - 1 and takes past visits up to and including E - 2.
    """
    execution = day + timedelta(days=1)
    return f"""
SELECT user_id_uuid, user_id, visit_day AS ymd
FROM (SELECT user_id_uuid, user_id, visit_day,
             lead(visit_day) OVER (PARTITION BY user_id_uuid, user_id ORDER BY visit_day) AS later_day
      FROM (SELECT DISTINCT user_id_uuid, user_id, CAST(date_trunc('day', time_received) AS DATE) AS visit_day
            FROM {PAGE_LOG} p) visits
      WHERE visit_day <= CAST({_lit_date(execution)} - INTERVAL 2 DAY AS DATE)) ordered_visits
WHERE later_day IS NULL"""


def _visitor_sql(day: date, strict: bool = False) -> str:
    same = "past.user_id_uuid = seen.user_id_uuid" + (" AND past.user_id = seen.user_id" if strict else "")
    return f"""
SELECT seen.user_id_uuid, seen.user_id, {_lit_date(day)} AS ymd, seen.has_wallet, seen.pageviews,
       CASE WHEN past.ymd IS NULL THEN DATE '0001-01-01' ELSE past.ymd END AS last_visit
FROM ({_daily_sql(day)}) seen LEFT JOIN ({_past_sql(day)}) past ON {same}"""


# ---------------------------------------------------------------------------
# the registry
# ---------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- visitors (AGG1, AGG2, AGG5, JOI2, PRJ3-5) -------------------------------

@register("visitor_previous_visit", _visitor_sql(VISIT_DAY))
def q_visitor_previous_visit(spark, sf):
    return visitors.visitor_previous_visit(_page_log(spark, sf), VISIT_DAY)


@register("visitor_previous_visit_strict", _visitor_sql(VISIT_DAY, strict=True))
def q_visitor_previous_visit_strict(spark, sf):
    return visitors.visitor_previous_visit(_page_log(spark, sf), VISIT_DAY, join_keys=("user_id_uuid", "user_id"))


@register("visitor_previous_visits_of_days", " UNION ALL ".join(f"SELECT * FROM ({_visitor_sql(d)})" for d in (PREV_DAY, VISIT_DAY)))
def q_visitor_previous_visits_of_days(spark, sf):
    """Several days in one pass."""
    return visitors.visitor_previous_visits(_page_log(spark, sf), [PREV_DAY, VISIT_DAY])


@register("visitor_daily_pageviews", _daily_sql(VISIT_DAY))
def q_visitor_daily_pageviews(spark, sf):
    return visitors.daily_pageviews(_page_log(spark, sf), VISIT_DAY)


@register("visitor_last_past_visit", _past_sql(VISIT_DAY))
def q_visitor_last_past_visit(spark, sf):
    return visitors.last_past_visit(_page_log(spark, sf), VISIT_DAY)


# --- page log (SRC5, FIL4-5, JOI1, AGG3) --------------------------------------

_H0, _H1 = windows.hour_window(HOUR)
_D0, _D1 = windows.day_window(DAY)
_M0, _M1 = windows.month_window(MONTH)


@register("user_page_log_hour", _page_log_window_sql(_H0, _H1))
def q_user_page_log_hour(spark, sf):
    return pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf), _H0, _H1)


@register("user_page_log_day", _page_log_window_sql(_D0, _D1))
def q_user_page_log_day(spark, sf):
    return pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf), _D0, _D1)


@register("user_page_log_month", _page_log_window_sql(_M0, _M1))
def q_user_page_log_month(spark, sf):
    return pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf), _M0, _M1)


@register("user_page_log_large_blacklist", _page_log_window_sql(_M0, _M1, f"(SELECT user_agent FROM {BLACKLIST} listed UNION ALL SELECT c_name FROM customer)"))
def q_user_page_log_large_blacklist(spark, sf):
    listed = _blacklist(spark, sf).select("user_agent").unionAll(fx.load(spark, sf, "customer").select("c_name"))
    return pages.user_page_log(_page_log(spark, sf), listed, _M0, _M1, large_list=True)


@register("user_page_log_null_blacklist", _page_log_window_sql(_M0, _M1, BLACKLIST_NULL))
def q_user_page_log_null_blacklist(spark, sf):
    return pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf, with_null=True), _M0, _M1)


@register("user_page_log_empty_blacklist", _page_log_window_sql(_M0, _M1, BLACKLIST_EMPTY))
def q_user_page_log_empty_blacklist(spark, sf):
    return pages.user_page_log(_page_log(spark, sf), _empty_blacklist(spark, sf), _M0, _M1)


@register("visitor_previous_visit_from_history", _visitor_sql(VISIT_DAY))
def q_visitor_previous_visit_from_history(spark, sf):
    """Past visits taken from a visitor-day table instead of every page view."""
    pl = _page_log(spark, sf)
    history = (pl.groupBy("user_id_uuid", "user_id", F.to_date("time_received").alias("ymd"))
               .agg(F.count(F.lit(1)).alias("pageviews")))
    return visitors.visitor_previous_visit(pl, VISIT_DAY, history=history)


@register("page_log_from_raw_lines", f"""
SELECT time_received, uri, referrer, user_agent, has_wallet, ip, session_id, user_id, user_id_uuid, ga_ga, ga_gid
FROM ({_expected_raw(_GOOD_HOURLY)}) e
WHERE (NOT regexp_matches(uri, '^/notification/'))
  AND time_received >= {_lit_ts(_D0)} AND time_received < {_lit_ts(_D1)}
  AND {_not_listed(f"({fx.agent_blacklist_sql('nation')})", "e.user_agent")}""")
def q_page_log_from_raw_lines(spark, sf):
    """The whole chain from raw text: parse, keep good rows, derive a day's page log."""
    raw = parse.good_rows(_parsed(spark, sf))
    return pages.user_page_log(raw, fx.agent_blacklist(spark, fx.load(spark, sf, "nation")), _D0, _D1)


# --- bounty views (FIL6-7, PRJ1) and snapshot (PRJ2-3) -------------------------

_VIEWS_SQL = f"""
SELECT time_received, CAST(regexp_extract(referrer, '/bounty/([0-9]+)', 1) AS INT) AS bounty_id,
       user_agent, has_wallet, ip, session_id, user_id, user_id_uuid, ga_ga, ga_gid
FROM {PAGE_LOG} p
WHERE uri = '/analytics/ping/' AND regexp_matches(referrer, '/bounty/[0-9]+')"""


@register("bounty_view_log", _VIEWS_SQL)
def q_bounty_view_log(spark, sf):
    return views.bounty_views(_page_log(spark, sf))


@register("bounty_view_log_hour", _VIEWS_SQL + f"""
  AND time_received >= {_lit_ts(_H0)} AND time_received < {_lit_ts(_H1)}""")
def q_bounty_view_log_hour(spark, sf):
    return views.bounty_views(_page_log(spark, sf), _H0, _H1)


@register("bounty_view_log_via_tables", _VIEWS_SQL + f"""
  AND time_received >= {_lit_ts(_D0)} AND time_received < {_lit_ts(_D1)}""")
def q_bounty_view_log_via_tables(spark, sf):
    """Through the table layer: write the month's page log by event hour, read one
    day back (partition-pruned), derive that day's views."""
    root = scratch_path(spark, "user_page_log")
    tables.write_window(_page_log(spark, sf), root, _M0, _M1)
    page_log = tables.read_window(spark, root, _D0, _D1, schema=tables.PAGE_LOG_DDL).drop("row_added")
    return views.bounty_views(page_log, _D0, _D1)


@register("bounty_snapshot", f"""
SELECT bounty_id, title, description, bountyStage AS bounty_stage, usd_price, user_id, deadline, created,
       {_lit_date(SNAPSHOT_DS)} AS ymd
FROM {BOUNTIES} b""")
def q_bounty_snapshot(spark, sf):
    return snapshot.bounty_snapshot(fx.bounties(spark, fx.load(spark, sf, "orders")), SNAPSHOT_DS)


# --- parser (PRS1-15), quality (AGG4, SNK2-3) ----------------------------------

_RAW_COLS = ", ".join(RAW_COLUMNS)


@register("parse_access_log", _expected_raw(_GOOD_HOURLY))
def q_parse_access_log(spark, sf):
    return parse.good_rows(_parsed(spark, sf))


@register("parse_access_log_backfill", _expected_raw(_GOOD_BACKFILL))
def q_parse_access_log_backfill(spark, sf):
    return parse.good_rows(_parsed(spark, sf, "backfill"))


@register("parse_outcomes_hourly", f"SELECT filename, line_number, {_case_outcome(1)} AS outcome FROM {LINES} l")
def q_parse_outcomes_hourly(spark, sf):
    return _parsed(spark, sf).select("filename", "line_number", "outcome")


@register("parse_outcomes_backfill", f"SELECT filename, line_number, {_case_outcome(2)} AS outcome FROM {LINES} l")
def q_parse_outcomes_backfill(spark, sf):
    return _parsed(spark, sf, "backfill").select("filename", "line_number", "outcome")


@register("parse_outcomes_exact_literals",
          f"SELECT filename, line_number, {_case_outcome(1)} AS outcome FROM {LINES} l")
def q_parse_outcomes_exact_literals(spark, sf):
    """Two passes: what strict JSON decides natively, then only the other lines through Python's literal parser."""
    lines = _lines(spark, sf)
    first = parse.parse_lines(lines, rule="strict")
    rest = parse.parse_lines(first.filter(F.col("outcome") == "undecided").select(*lines.columns), rule="literal")
    return first.filter(F.col("outcome") != "undecided").unionByName(rest).select("filename", "line_number", "outcome")


@register("cookie_fields", f"""
SELECT session_id, user_id, user_id_uuid, ga_ga, ga_gid FROM ({_expected_raw(_GOOD_HOURLY)}) e""")
def q_cookie_fields(spark, sf):
    return parse.good_rows(_parsed(spark, sf)).select("session_id", "user_id", "user_id_uuid", "ga_ga", "ga_gid")


@register("file_quality", f"""
WITH o AS (SELECT filename, {_case_outcome(1)} AS outcome FROM {LINES} l)
SELECT filename, count(*) AS file_line_count,
       count(*) FILTER (WHERE outcome = 'bad') AS file_bad_lines,
       count(*) FILTER (WHERE outcome = 'regex_failed') AS file_regex_failed
FROM o GROUP BY filename""")
def q_file_quality(spark, sf):
    return quality.file_quality(_parsed(spark, sf))


@register("regex_failure_samples", f"""
SELECT filename, line_number, line AS bad_line FROM {LINES} l WHERE {_case_outcome(1)} = 'regex_failed'""")
def q_regex_failure_samples(spark, sf):
    return quality.failure_samples(_parsed(spark, sf))


@register("rejected_rows", f"""
SELECT filename, line_number, line FROM {LINES} l WHERE {_case_outcome(1)} = 'rejected'""")
def q_rejected_rows(spark, sf):
    return parse.rejected_rows(_parsed(spark, sf))


# --- windows and replacement (SNK8-11, SNK13, FIL1-3, INC2) --------------------

_PL_COLS = "time_received, uri, referrer, user_agent, has_wallet, ip, session_id, user_id, user_id_uuid, ga_ga, ga_gid"


def _replace_window_sql(lo: datetime, hi: datetime) -> str:
    return f"""
SELECT {_PL_COLS} FROM {PAGE_LOG} p
WHERE NOT coalesce(time_received >= {_lit_ts(lo)} AND time_received < {_lit_ts(hi)}, false)
UNION ALL
{_page_log_window_sql(lo, hi)}"""


@register("replace_window_hour", _replace_window_sql(_H0, _H1))
def q_replace_window_hour(spark, sf):
    existing = _page_log(spark, sf)
    new = pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf), _H0, _H1)
    return windows.replace_window(existing, new, "time_received", _H0, _H1)


@register("replace_window_day", _replace_window_sql(_D0, _D1))
def q_replace_window_day(spark, sf):
    existing = _page_log(spark, sf)
    new = pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf), _D0, _D1)
    return windows.replace_window(existing, new, "time_received", _D0, _D1)


@register("replace_slice_ymd", f"""
WITH existing AS (SELECT * FROM ({_visitor_sql(PREV_DAY)}) a UNION ALL SELECT * FROM ({_visitor_sql(VISIT_DAY)}) b)
SELECT * FROM existing WHERE NOT coalesce(ymd = {_lit_date(VISIT_DAY)}, false)
UNION ALL SELECT * FROM ({_visitor_sql(VISIT_DAY, strict=True)}) c""")
def q_replace_slice_ymd(spark, sf):
    pl = _page_log(spark, sf)
    existing = visitors.visitor_previous_visit(pl, PREV_DAY).unionByName(
        visitors.visitor_previous_visit(pl, VISIT_DAY))
    new = visitors.visitor_previous_visit(pl, VISIT_DAY, join_keys=("user_id_uuid", "user_id"))
    return windows.replace_slice(existing, new, "ymd", VISIT_DAY)


@register("straddling_rows", f"""
WITH g AS (
  SELECT l.filename, l.line_number, date_trunc('second', b.line_ts) AS time_received,
         date_trunc('hour', b.ts) AS path_hour
  FROM {LINES} l JOIN {LINE_BASE} b ON l.event_id = b.event_id
  WHERE {_good(1, 'b.c')})
SELECT filename, line_number, time_received, path_hour,
       CAST(date_trunc('month', time_received) AS DATE) AS target_month,
       CASE WHEN time_received < path_hour THEN 'earlier' ELSE 'later' END AS direction
FROM g WHERE time_received < path_hour OR time_received >= path_hour + INTERVAL 1 HOUR""")
def q_straddling_rows(spark, sf):
    parsed = _parsed(spark, sf).filter(F.col("outcome") == "good")
    with_hour = parsed.withColumn(
        "path_hour", F.to_timestamp_ntz(F.regexp_extract("filename", r"^logs/(\d{4}/\d{2}/\d{2}/\d{2})/", 1),
                                        F.lit("yyyy/MM/dd/HH")))
    return windows.straddling_rows(with_hour)


@register("hourly_windows", f"""
SELECT date_trunc('hour', time_received) AS slice_start, count(*) AS n_rows FROM {PAGE_LOG} p GROUP BY 1""")
def q_hourly_windows(spark, sf):
    return windows.hourly_slices(_page_log(spark, sf))


# --- readiness (SRC10-12) -------------------------------------------------------

@register("window_ready", f"""
SELECT EXISTS (SELECT 1 FROM {PAGE_LOG} p
               WHERE time_received >= {_lit_ts(_H0)} AND time_received < {_lit_ts(_H1)}) AS ready""")
def q_window_ready(spark, sf):
    return readiness.window_ready(_page_log(spark, sf), _H0, _H1)


@register("window_ready_open", f"""
SELECT EXISTS (SELECT 1 FROM {PAGE_LOG} p WHERE time_received >= {_lit_ts(LATE)}) AS ready""")
def q_window_ready_open(spark, sf):
    return readiness.window_ready(_page_log(spark, sf), LATE, None)


@register("day_closed", f"""
SELECT EXISTS (SELECT 1 FROM {PAGE_LOG} p
               WHERE time_received >= {_lit_ts(datetime(2024, 1, 14, 23))}) AS ready""")
def q_day_closed(spark, sf):
    return readiness.day_closed(_page_log(spark, sf), PREV_DAY)


# --- written tables, each written twice (SNK1, SNK4-11) ---------------------------

@register("page_log_rewritten", _replace_window_sql(_D0, _D1) + f"""
  AND extract(hour FROM time_received) <> 7""")
def q_page_log_rewritten(spark, sf):
    """A month of page log; one of its days written again with other rows and one hour fewer; read back."""
    root = scratch_path(spark, "user page log [1]")
    tables.write_window(_page_log(spark, sf), root, _M0, _M1)
    again = pages.user_page_log(_page_log(spark, sf), _blacklist(spark, sf), _D0, _D1)
    tables.write_window(again.filter(F.hour("time_received") != 7), root, _D0, _D1)
    return tables.read_window(spark, root, _M0, _M1, schema=tables.PAGE_LOG_DDL).drop("row_added")


def _filed(df):
    """Rows with the ingest hour that the adapter's file names carry."""
    return df.withColumn("_ingest_hour", F.to_timestamp_ntz(
        F.regexp_extract("filename", r"^logs/(\d{4}/\d{2}/\d{2}/\d{2})/", 1), F.lit("yyyy/MM/dd/HH")))


_HOURS = [_M0 + timedelta(hours=h) for h in range(31 * 24)]
_DAY_HOURS = [_D0 + timedelta(hours=h) for h in range(24)]


def _of_day(lines):
    """The lines of the day's hours: their files' names tell them, so they are picked before they are parsed."""
    return _filed(lines).filter(windows.in_window(F.col("_ingest_hour"), _D0, _D1)).select(*lines.columns)


@register("raw_log_rewritten", _expected_raw(f"{_GOOD_HOURLY} AND (event_id % 8 < 4 OR NOT (ts >= {_lit_ts(_D0)} AND ts < {_lit_ts(_D1)}))"))
def q_raw_log_rewritten(spark, sf):
    """The raw log by ingest hour; one day's hours written again with other rows; read back."""
    root = scratch_path(spark, "raw log")
    lines = _lines(spark, sf)
    first, again = (_filed(parse.parse_lines(x).filter(F.col("outcome") == "good")).select(*RAW_COLUMNS, "_ingest_hour")
                    for x in (lines, _of_day(lines)))
    tables.write_raw_hours(first, root, _HOURS, hour_col="_ingest_hour")
    tables.write_raw_hours(again.filter("core < 4"), root, _DAY_HOURS, hour_col="_ingest_hour")
    return tables.read_ingested(spark, root, None, None).select(*RAW_COLUMNS)


def _rewritten_sql(columns: str, first: str, again: str) -> str:
    """Rows of the hours outside the day by the first rule, of the day's hours by the second."""
    day = f"substring(filename, 6, 10) = '{DAY:%Y/%m/%d}'"
    return f"SELECT {columns} FROM ({first}) x WHERE NOT {day} UNION ALL SELECT {columns} FROM ({again}) y WHERE {day}"


def _quality_sql(mode_index: int) -> str:
    return f"""SELECT filename, count(*) AS file_line_count, count(*) FILTER (WHERE outcome = 'bad') AS file_bad_lines,
  count(*) FILTER (WHERE outcome = 'regex_failed') AS file_regex_failed
FROM (SELECT filename, {_case_outcome(mode_index)} AS outcome FROM {LINES} l) o GROUP BY filename"""


def _rewritten(spark, sf, name, rows_of, columns):
    """Write a table of all ingest hours from the backfill's outcomes, then one day's hours from the hourly ones."""
    root = scratch_path(spark, name)
    lines = _lines(spark, sf)
    tables.write_loads(_filed(rows_of(parse.parse_lines(lines, "backfill"))), root, _HOURS, "_ingest_hour")
    tables.write_loads(_filed(rows_of(parse.parse_lines(_of_day(lines)))), root, _DAY_HOURS, "_ingest_hour")
    return tables.read_table(spark, root, "ingest_date DATE, ingest_hour INT, load STRING").select(*columns)


@register("files_processed_rewritten", _rewritten_sql(
    "filename, file_line_count, file_bad_lines, file_regex_failed", _quality_sql(2), _quality_sql(1)))
def q_files_processed_rewritten(spark, sf):
    """SNK2: per-file counts by ingest hour, a day replaced."""
    return _rewritten(spark, sf, "files processed", quality.file_quality,
                      ["filename", "file_line_count", "file_bad_lines", "file_regex_failed"])


def _samples_sql(mode_index: int) -> str:
    return f"SELECT filename, line_number, line AS bad_line FROM {LINES} l WHERE {_case_outcome(mode_index)} = 'regex_failed'"


@register("failure_samples_rewritten", _rewritten_sql("filename, line_number, bad_line", _samples_sql(2), _samples_sql(1)))
def q_failure_samples_rewritten(spark, sf):
    """SNK3: failing lines by ingest hour, a day replaced."""
    return _rewritten(spark, sf, "failure lines", quality.failure_samples,
                      ["filename", "line_number", "bad_line"])


_IN_DAY = f"(time_received >= {_lit_ts(_D0)} AND time_received < {_lit_ts(_D1)})"


@register("bounty_views_rewritten", f"""
SELECT * FROM ({_VIEWS_SQL}) v WHERE time_received >= {_lit_ts(_M0)} AND time_received < {_lit_ts(_M1)}
  AND (NOT {_IN_DAY} OR bounty_id % 3 = 1 AND extract(hour FROM time_received) <> 9)""")
def q_bounty_views_rewritten(spark, sf):
    """SNK5: the view log by event hour, a day replaced by other rows with an hour fewer."""
    root = scratch_path(spark, "log bounty view")
    found = views.bounty_views(_page_log(spark, sf))
    tables.write_window(found, root, _M0, _M1)
    tables.write_window(found.filter("bounty_id % 3 = 1").filter(F.hour("time_received") != 9), root, _D0, _D1)
    return tables.read_window(spark, root, _M0, _M1, schema=tables.VIEW_LOG_DDL).drop("row_added")


def _snapshot_sql(ds: date, where: str = "true") -> str:
    return f"""SELECT bounty_id, title, description, bountyStage AS bounty_stage, usd_price, user_id, deadline, created,
       {_lit_date(ds)} AS ymd FROM {BOUNTIES} b WHERE {where}"""


@register("bounty_snapshots_rewritten", f"{_snapshot_sql(PREV_DAY)} UNION ALL {_snapshot_sql(SNAPSHOT_DS, 'bounty_id % 3 = 0')}")
def q_bounty_snapshots_rewritten(spark, sf):
    """SNK7: two days of snapshots, one of them replaced by the table as it is later."""
    root = scratch_path(spark, "bounty snapshots")
    bounties = fx.bounties(spark, fx.load(spark, sf, "orders"))
    for ds, rows in ((PREV_DAY, bounties), (SNAPSHOT_DS, bounties), (SNAPSHOT_DS, bounties.filter("bounty_id % 3 = 0"))):
        tables.write_slice(snapshot.bounty_snapshot(rows, ds), root, ds)
    return tables.read_table(spark, root, "ymd DATE")


@register("visitor_slice_rewritten", _visitor_sql(VISIT_DAY))
def q_visitor_slice_rewritten(spark, sf):
    root = scratch_path(spark, "visitors")
    for strict in (True, False):
        keys = ("user_id_uuid", "user_id") if strict else ("user_id_uuid",)
        tables.write_slice(visitors.visitor_previous_visit(_page_log(spark, sf), VISIT_DAY, join_keys=keys), root, VISIT_DAY)
    return tables.read_table(spark, root, "ymd DATE")


# --- visitor state (AGG2, AGG5, JOI2) ---------------------------------------------

@register("visitor_previous_visit_from_state", " UNION ALL ".join(f"SELECT * FROM ({_visitor_sql(d)}) v" for d in (PREV_DAY, VISIT_DAY)))
def q_visitor_previous_visit_from_state(spark, sf):
    """Through the tables: the page log by event hour, the bucketed visitor state, a day and then a backdated one."""
    warehouse = scratch_path(spark, "visitor warehouse")
    tables.write_window(_page_log(spark, sf), f"{warehouse}/user_page_log", _M0, _M1)
    for day in (VISIT_DAY, PREV_DAY):
        jobs.visitor_run(spark, warehouse, day, buckets=_BUCKETS)
    return tables.read_table(spark, f"{warehouse}/agg_visitor_previous_visit", "ymd DATE")


_BUCKETS = 8


# --- files and streams (SRC1-4, SRC9, SNK1, INC1, INC6) -----------------------------

def _files(spark, sf):
    return logfiles.write_log_files(spark, _lines(spark, sf))


@register("ingest_files_roundtrip", _expected_raw(_GOOD_HOURLY))
def q_ingest_files_roundtrip(spark, sf):
    """All files, their text read once."""
    return staging.parse_files(spark, _files(spark, sf), layout=logfiles.SPARK_LAYOUT).good()


@register("ingest_hour_prefix", _expected_raw(f"{_GOOD_HOURLY} AND ts >= {_lit_ts(_H0)} AND ts < {_lit_ts(_H1)}"))
def q_ingest_hour_prefix(spark, sf):
    """Only the files under one hour's prefix."""
    return staging.parse_files(spark, _files(spark, sf), hour=HOUR, layout=logfiles.SPARK_LAYOUT).good()


@register("ingest_day_prefix", _expected_raw(f"{_GOOD_HOURLY} AND ts >= {_lit_ts(_D0)} AND ts < {_lit_ts(_D1)}"))
def q_ingest_day_prefix(spark, sf):
    """The files under every hour prefix of one day, by the reader that numbers every line."""
    return parse.good_rows(parse.parse_lines(logfiles.read_log_lines(spark, _files(spark, sf), day=DAY, layout=logfiles.SPARK_LAYOUT)))


_NAME_RE = r"hour=(\d{4})-(\d{2})-(\d{2})-(\d{2})/file=([^/]+)/"


def _source_name():
    """The adapter's file name of a file as :func:`write_log_files` writes it."""
    return F.regexp_replace(F.regexp_extract("filename", _NAME_RE, 0), _NAME_RE, "logs/$1/$2/$3/$4/$5").alias("filename")


_QUALITY_OF_FILES = f"""
WITH o AS (SELECT filename, {_case_outcome(1)} AS outcome FROM {LINES} l)
SELECT filename, count(*) + 1 AS file_line_count,
       count(*) FILTER (WHERE outcome = 'bad') + 1 AS file_bad_lines,
       count(*) FILTER (WHERE outcome = 'regex_failed') AS file_regex_failed
FROM o GROUP BY filename"""


@register("file_quality_roundtrip", _QUALITY_OF_FILES)
def q_file_quality_roundtrip(spark, sf):
    """Per-file counts after a trip through real files: each written file ends
    with a newline, so it reads back with one extra, empty (bad) last line."""
    q = staging.parse_files(spark, _files(spark, sf), layout=logfiles.SPARK_LAYOUT).quality()
    return q.select(_source_name(), "file_line_count", "file_bad_lines", "file_regex_failed")


@register("failing_lines_of_files", f"""
SELECT filename, line_number, line AS bad_line, {_case_outcome(1)} AS outcome FROM {LINES} l
WHERE {_case_outcome(1)} IN ('regex_failed', 'rejected')""")
def q_failing_lines_of_files(spark, sf):
    """Absolute line numbers, resolved after the one scan and only for the rows that carry them."""
    parsed = staging.parse_files(spark, _files(spark, sf), layout=logfiles.SPARK_LAYOUT)
    both = parsed.samples().withColumn("outcome", F.lit("regex_failed")).unionByName(
        parsed.rejected().withColumnRenamed("line", "bad_line").withColumn("outcome", F.lit("rejected")))
    return both.select(_source_name(), "line_number", "bad_line", "outcome")


#: The file that arrives late in the streamed warehouse: the first one of this hour.
_LATE_NAME = f"logs/{HOUR:%Y/%m/%d/%H}/"
_STREAMED: dict[tuple, str] = {}


def _streamed_warehouse(spark, sf):
    """A warehouse filled by the stream and its followers, with late files in a replayed batch.

    All files but those of one hour are streamed; page log, views and every visitor slice follow the change feed.
    Then the late hour's files arrive, and their micro-batch is replayed, once after its commit and once as if the
    run had died before it; they are followed in turn. Five queries read the tables: they are filled once a session.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _STREAMED:
        return _STREAMED[key]
    warehouse, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "stream-state")
    lines = _lines(spark, sf)
    late = F.col("filename").startswith(_LATE_NAME)
    root = logfiles.write_log_files(spark, lines.filter(~late))
    stream = lambda: stream_ingest.ingest_available(spark, root, warehouse, checkpoint, layout=logfiles.SPARK_LAYOUT)
    blacklist = fx.agent_blacklist(spark, fx.load(spark, sf, "nation"))
    stream()
    jobs.derive_changes(spark, warehouse, blacklist, through=_M1.date(), buckets=_BUCKETS)
    logfiles.write_log_files(spark, lines.filter(late), root, mode="append")
    stream()
    load = max(commits.last_loads(spark, warehouse).values())
    for committed in (True, False):
        tables.delete(spark, f"{checkpoint}/commits/1")  # Spark then replays the micro-batch
        if not committed:
            tables.delete(spark, f"{warehouse}/{commits.COMMITS}/load={load}")
        stream()
    jobs.derive_changes(spark, warehouse, blacklist, buckets=_BUCKETS)
    _STREAMED[key] = warehouse
    return warehouse


@register("ingest_stream_available_now", _expected_raw(_GOOD_HOURLY))
def q_ingest_stream_available_now(spark, sf):
    """The raw log as the stream filled it, replays included."""
    return jobs.raw_window(spark, _streamed_warehouse(spark, sf), None, None)


@register("stream_file_quality", _QUALITY_OF_FILES)
def q_stream_file_quality(spark, sf):
    known = commits.committed(spark, _streamed_warehouse(spark, sf))
    rows = tables.read_table(spark, f"{_streamed_warehouse(spark, sf)}/files_processed", "ingest_date DATE, ingest_hour INT, load STRING")
    return rows.filter(known).select(_source_name(), "file_line_count", "file_bad_lines", "file_regex_failed")


_RAW_PAGE_LOG = f"""(SELECT {_PL_COLS} FROM ({_expected_raw(_GOOD_HOURLY)}) e
WHERE (NOT regexp_matches(uri, '^/notification/')) AND {_not_listed(f"({fx.agent_blacklist_sql('nation')})", "e.user_agent")})"""


@register("late_data_page_log", f"SELECT * FROM {_RAW_PAGE_LOG} p")
def q_late_data_page_log(spark, sf):
    """The page log after late files were followed hour by hour."""
    return jobs.page_log_window(spark, _streamed_warehouse(spark, sf), None)


@register("late_data_views", _VIEWS_SQL.replace(PAGE_LOG, _RAW_PAGE_LOG))
def q_late_data_views(spark, sf):
    return tables.read_window(spark, f"{_streamed_warehouse(spark, sf)}/log_bounty_view", None, schema=tables.VIEW_LOG_DDL).drop("row_added")


@register("late_data_visitors", f"""
WITH p AS MATERIALIZED (SELECT user_id_uuid, user_id, has_wallet, CAST(time_received AS DATE) AS ymd FROM {_RAW_PAGE_LOG} q),
seen AS (SELECT user_id_uuid, user_id, ymd, bool_or(has_wallet) AS has_wallet, count(*) AS pageviews FROM p GROUP BY 1, 2, 3),
past AS (SELECT s.user_id_uuid, s.user_id, s.ymd, v.user_id AS past_id, max(v.ymd) AS last_visit
         FROM seen s JOIN (SELECT DISTINCT user_id_uuid, user_id, ymd FROM p) v
           ON v.user_id_uuid = s.user_id_uuid AND v.ymd <= CAST(s.ymd - INTERVAL 1 DAY AS DATE) GROUP BY 1, 2, 3, 4)
SELECT s.user_id_uuid, s.user_id, s.ymd, s.has_wallet, s.pageviews, coalesce(t.last_visit, DATE '0001-01-01') AS last_visit
FROM seen s LEFT JOIN past t
  ON t.user_id_uuid = s.user_id_uuid AND t.ymd = s.ymd AND t.user_id IS NOT DISTINCT FROM s.user_id""")
def q_late_data_visitors(spark, sf):
    """Every day's visitor slice after the late files."""
    return tables.read_table(spark, f"{_streamed_warehouse(spark, sf)}/agg_visitor_previous_visit", "ymd DATE")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
