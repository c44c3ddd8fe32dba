"""Adapters: derive web-log shaped inputs from the given test tables.

The test tables hold no web logs, so the registered queries derive them,
deterministically, from ``events`` (page views and raw log lines), ``orders``
(the bounty table) and ``nation`` (the user-agent blacklist). Each adapter is
one SQL text written for both engines: Spark runs it here, and the DuckDB
oracle (``pagetrail.plans.oracle``) embeds the very same text, so both sides
start from identical inputs. Only a handful of functions differ by engine and
are supplied by :class:`Dialect`.

Raw lines carry one case per ``event_id % 40`` so every outcome rule of the
parser is exercised (see :data:`LINE_CASES`).
"""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import DataFrame, SparkSession


class Dialect:
    """The few spellings that differ between Spark SQL and DuckDB."""

    def __init__(self, engine: str, tasks: int | None = None):
        if engine not in ("spark", "duckdb"):
            raise ValueError(engine)
        self.engine = engine
        self.tasks = tasks

    def dealt(self, sql: str, key: str) -> str:
        """The rows of ``sql``; in Spark dealt by ``key`` to ``tasks`` tasks, however few bytes they are."""
        return sql if self.tasks is None else f"SELECT /*+ REPARTITION({self.tasks}, {key}) */ * FROM ({sql}) rows_dealt"

    def ctime(self, ts: str) -> str:
        """``%c`` text (``Mon Jan 01 00:00:07 2024``) of a timestamp."""
        if self.engine == "spark":
            return f"date_format({ts}, 'EEE MMM dd HH:mm:ss yyyy')"
        return f"strftime({ts}, '%a %b %d %H:%M:%S %Y')"

    def ctime_space_day(self, ts: str) -> str:
        """``%c`` text with a space-padded day (``Mon Jan  1 ...``)."""
        if self.engine == "spark":
            return (f"date_format({ts}, 'EEE MMM ') || lpad(CAST(dayofmonth({ts}) AS STRING), 2, ' ') "
                    f"|| date_format({ts}, ' HH:mm:ss yyyy')")
        return (f"strftime({ts}, '%a %b ') || lpad(CAST(dayofmonth({ts}) AS STRING), 2, ' ') "
                f"|| strftime({ts}, ' %H:%M:%S %Y')")

    def hour_path(self, ts: str) -> str:
        if self.engine == "spark":
            return f"date_format({ts}, 'yyyy/MM/dd/HH')"
        return f"strftime({ts}, '%Y/%m/%d/%H')"

    def idiv(self, a: str, b: int) -> str:
        return f"({a} div {b})" if self.engine == "spark" else f"({a} // {b})"


def _uuid_of(expr: str) -> str:
    h = f"md5(CAST({expr} AS STRING))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' "
            f"|| substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


# --------------------------------------------------------------------------
# page log from events
# --------------------------------------------------------------------------

def page_log_sql(events: str = "events") -> str:
    """The page-log columns (raw log subset) for every event."""
    return f"""
SELECT
  ts AS time_received,
  CASE WHEN event_type = 'error' THEN '/notification/' || CAST(event_id AS STRING)
       WHEN event_type IN ('view', 'click') THEN '/analytics/ping/'
       WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN NULL
       WHEN event_type = 'purchase' THEN '/api/notification/' || CAST(event_id AS STRING)
       ELSE '/api/' || event_type END AS uri,
  CASE WHEN event_id % 3 = 0 THEN '-'
       WHEN event_id % 17 = 0 THEN 'https://x.example/bounty/' || CAST(event_id % 500 AS STRING) || '/bounty/9'
       ELSE 'https://x.example/bounty/' || CAST(event_id % 500 AS STRING) || '/' || CAST(event_id % 7 AS STRING)
  END AS referrer,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'UA-' || CAST(user_id % 11 AS STRING) END AS user_agent,
  event_type = 'purchase' AS has_wallet,
  '10.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 251 AS STRING) || '.'
    || CAST(event_id % 241 AS STRING) AS ip,
  'sess-' || CAST(user_id AS STRING) AS session_id,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS user_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE {_uuid_of('user_id')} END AS user_id_uuid,
  'GA1.2.' || CAST(user_id AS STRING) AS ga_ga,
  'GA1.2.' || CAST(event_id % 1000 AS STRING) AS ga_gid
FROM {events}"""


def blacklist_sql(nation: str = "nation", with_null: bool = False) -> str:
    """A user agent per nation (some of them seen in the page log); ``with_null`` turns region 2's into NULLs."""
    agent = "'UA-' || CAST(n_nationkey * 5 AS STRING)"
    return f"SELECT {f'CASE WHEN n_regionkey <> 2 THEN {agent} END' if with_null else agent} AS user_agent FROM {nation}"


def agent_blacklist_sql(nation: str = "nation") -> str:
    """The same nations' agents, spelt as the raw-line adapter writes user agents."""
    return f"SELECT 'Mozilla/5.0 (agent ' || CAST(n_nationkey * 5 AS STRING) || ')' AS user_agent FROM {nation}"


def bounties_sql(orders: str = "orders") -> str:
    """The bounty table (source column names, incl. ``bountyStage``) from orders."""
    return f"""
SELECT CAST(o_orderkey AS INT) AS bounty_id,
       o_orderpriority AS title,
       'order ' || CAST(o_orderkey AS STRING) || ' of customer ' || CAST(o_custkey AS STRING) AS description,
       o_orderstatus AS bountyStage,
       o_totalprice AS usd_price,
       CAST(o_custkey AS INT) AS user_id,
       o_orderdate + INTERVAL 30 DAY AS deadline,
       o_orderdate AS created
FROM {orders}"""


# --------------------------------------------------------------------------
# raw log lines from events
# --------------------------------------------------------------------------

# case (event_id % 40) -> (what the line holds, hourly outcome, backfill outcome)
LINE_CASES = {
    0: ("empty line", "bad", "bad"),
    1: ("text after the literal", "bad", "bad"),
    2: ("JSON null inside the dict", "bad", "bad"),
    3: ("dict without log", "bad", "bad"),
    4: ("numeric log", "regex_failed", "regex_failed"),
    5: ("framework 404 line", "bad", "skipped"),
    6: ("short 404 line", "bad", "skipped"),
    7: ("not an access line", "regex_failed", "regex_failed"),
    8: ("cookie user_id not an int", "bad", "bad"),
    9: ("30 February", "bad", "bad"),
    10: ("empty pid", "bad", "bad"),
    11: ("11-character method", "regex_failed", "rejected"),
    12: ("forwarded IP list", "good", "regex_failed"),
    13: ("duplicate cookie, value with two '='", "good", "good"),
    14: ("second 60", "bad", "bad"),
    15: ("pid beyond INT", "rejected", "rejected"),
    16: ("malformed uuid", "rejected", "rejected"),
    17: ("single-quoted literal", "good", "good"),
    18: ("upper-case uuid in braces", "good", "good"),
    19: ("wallet 'True'", "good", "good"),
    20: ("log without its newline", "regex_failed", "regex_failed"),
    21: ("time two hours before the file's hour", "good", "good"),
    22: ("time 90 minutes after the event", "good", "good"),
    23: ("only a session cookie", "good", "good"),
    24: ("empty user_id cookie", "bad", "bad"),
    25: ("empty response time", "bad", "bad"),
    26: ("spaced, signed user_id cookie", "good", "good"),
    27: ("space-padded day", "good", "good"),
    28: ("escaped non-ASCII agent", "good", "good"),
    29: ("None, True, a tuple and 0x1F beside log", "good", "good"),
    30: ("trailing comma and comment", "good", "good"),
    31: ("escape that JSON lacks", "good", "good"),
    32: ("single quotes with a JSON true", "bad", "bad"),
    33: ("None as log", "regex_failed", "regex_failed"),
    34: ("leading zero", "bad", "bad"),
    35: ("three hundred forwarded IPs", "good", "regex_failed"),
    36: ("forwarded list that ends in a dot", "regex_failed", "regex_failed"),
}
N_CASES = 40  # cases 37..39 are plain good lines


def line_base_sql(d: Dialect, events: str = "events") -> str:
    """Per event: the values written into its line, and the case number ``c``."""
    bs = "chr(92)"
    return f"""
SELECT event_id, ts, user_id, event_type, event_id % {N_CASES} AS c,
  {_uuid_of('user_id')} AS uuid,
  '10.' || CAST(user_id % 256 AS STRING) || '.' || CAST(event_id % 251 AS STRING) || '.'
    || CAST(event_id % 241 AS STRING) AS ip,
  CASE WHEN event_type = 'purchase' THEN 'POST' WHEN event_type = 'error' THEN 'PUT' ELSE 'GET' END AS method,
  CASE WHEN event_type = 'error' THEN '/notification/' || CAST(event_id AS STRING)
       WHEN event_type IN ('view', 'click') THEN '/analytics/ping/'
       ELSE '/api/' || event_type END AS uri,
  CASE WHEN event_id % 3 = 0 THEN '-'
       WHEN event_id % 17 = 0 THEN 'https://x.example/bounty/' || CAST(event_id % 500 AS STRING) || '/bounty/9'
       ELSE 'https://x.example/bounty/' || CAST(event_id % 500 AS STRING) || '/' || CAST(event_id % 7 AS STRING)
  END AS referrer,
  CASE WHEN event_id % {N_CASES} = 28
       THEN 'Mozilla/5.0 (agent ' || {bs} || 'u00e9 ' || CAST(user_id % 11 AS STRING) || ')'
       ELSE 'Mozilla/5.0 (agent ' || CAST(user_id % 11 AS STRING) || ')' END AS agent_text,
  CASE WHEN event_id % {N_CASES} = 28
       THEN 'Mozilla/5.0 (agent ' || chr(233) || ' ' || CAST(user_id % 11 AS STRING) || ')'
       ELSE 'Mozilla/5.0 (agent ' || CAST(user_id % 11 AS STRING) || ')' END AS agent,
  CASE WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END AS wallet,
  CASE WHEN event_id % {N_CASES} = 21 THEN ts - INTERVAL 2 HOUR
       WHEN event_id % {N_CASES} = 22 THEN ts + INTERVAL 90 MINUTE
       ELSE ts END AS line_ts,
  'logs/' || {d.hour_path('ts')} || '/api-' || CAST({d.idiv('event_id', 256)} AS STRING) || '.log' AS filename
FROM {events}"""


def raw_lines_sql(d: Dialect, events: str = "events") -> str:
    """(filename, line_number, line, event_id, c): one log line per event."""
    bs = "chr(92)"
    nl = f"{bs} || 'n'"
    u = "CAST(user_id AS STRING)"
    cookies = f"""CASE
      WHEN c = 8 THEN 'session_id=sess-' || {u} || '; user_id=u' || {u} || '; uuid=' || uuid
      WHEN c = 13 THEN 'session_id=sess-' || {u} || '=x; user_id=999; user_id=' || {u} || '; uuid=' || uuid
                       || '; _ga=GA1.2.' || {u} || '; _gid=GA1.2.' || CAST(event_id % 1000 AS STRING)
      WHEN c = 16 THEN 'session_id=sess-' || {u} || '; user_id=' || {u} || '; uuid=not-a-uuid'
      WHEN c = 18 THEN 'session_id=sess-' || {u} || '; user_id=' || {u} || '; uuid={{' || upper(uuid) || '}}'
                       || '; _ga=GA1.2.' || {u} || '; _gid=GA1.2.' || CAST(event_id % 1000 AS STRING)
      WHEN c = 23 THEN 'session_id=sess-' || {u}
      WHEN c = 24 THEN 'session_id=sess-' || {u} || '; user_id=; uuid=' || uuid
      WHEN c = 26 THEN 'session_id=sess-' || {u} || ';  user_id = +' || {u} || ' ; uuid=' || uuid
                       || '; _ga=GA1.2.' || {u} || '; _gid=GA1.2.' || CAST(event_id % 1000 AS STRING)
      ELSE 'session_id=sess-' || {u} || '; user_id=' || {u} || '; uuid=' || uuid
           || '; _ga=GA1.2.' || {u} || '; _gid=GA1.2.' || CAST(event_id % 1000 AS STRING) END"""
    access = f"""'[pid: ' || CASE WHEN c = 10 THEN '' WHEN c = 15 THEN '99999999999'
                          ELSE CAST(event_id % 32768 AS STRING) END
  || '|app: -|req: -/-] '
  || CASE WHEN c = 12 THEN ip || ', 172.16.0.' || CAST(event_id % 200 AS STRING)
          WHEN c = 35 THEN ip || repeat(', 172.16.0.1', 300)
          WHEN c = 36 THEN ip || ', 172.16.0.' ELSE ip END
  || ' (-) {{' || CAST(10 + event_id % 40 AS STRING) || ' vars in ' || CAST(400 + event_id % 600 AS STRING)
  || ' bytes}} ['
  || CASE WHEN c = 9 THEN 'Fri Feb 30 10:00:00 2024'
          WHEN c = 14 THEN 'Mon Jan 01 10:00:60 2024'
          WHEN c = 27 THEN {d.ctime_space_day('line_ts')}
          ELSE {d.ctime('line_ts')} END
  || '] ' || CASE WHEN c = 11 THEN 'PROPFINDALL' ELSE method END || ' ' || uri
  || ' => generated ' || CAST((event_id * 7) % 5000 AS STRING) || ' bytes in '
  || CASE WHEN c = 25 THEN '' ELSE CAST(event_id % 300 AS STRING) END || ' msecs (HTTP/1.1 '
  || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ') '
  || CAST(5 + event_id % 4 AS STRING) || ' headers in ' || CAST(150 + event_id % 100 AS STRING) || ' bytes ('
  || CAST(1 + event_id % 3 AS STRING) || ' switches on core ' || CAST(event_id % 8 AS STRING) || ') referrer: '
  || referrer || ' UA ' || agent_text || ' has wallet: ' || CASE WHEN c = 19 THEN 'True' ELSE wallet END
  || ' cookies: ' || {cookies}"""
    line = f"""CASE
      WHEN c = 0 THEN ''
      WHEN c = 1 THEN '{{"log":"' || access || {nl} || '","stream":"stderr"}} trailing'
      WHEN c = 2 THEN '{{"log":"' || access || {nl} || '","stream":null}}'
      WHEN c = 3 THEN '{{"message":"' || access || {nl} || '","stream":"stderr"}}'
      WHEN c = 4 THEN '{{"log":' || CAST(event_id AS STRING) || ',"stream":"stderr"}}'
      WHEN c = 5 THEN '{{"log":"WARNING:django.request:Not Found: ' || uri || {nl} || '","stream":"stderr"}}'
      WHEN c = 6 THEN '{{"log":"Not Found: ' || uri || {nl} || '","stream":"stderr"}}'
      WHEN c = 7 THEN '{{"log":"GET ' || uri || ' 200' || {nl} || '","stream":"stderr"}}'
      WHEN c = 17 THEN '{{''log'': ''' || access || {nl} || ''', ''stream'': ''stderr''}}'
      WHEN c = 29 THEN '{{"log":"' || access || {nl} || '","a":None,"b":True,"c":(1, 2),"d":0x1F}}'
      WHEN c = 30 THEN '{{"log":"' || access || {nl} || '","stream":"stderr",}} # end'
      WHEN c = 31 THEN '{{"log":"' || {bs} || 'x5bpid' || substring(access, 5) || {nl} || '"}}'
      WHEN c = 32 THEN '{{''log'': ''' || access || {nl} || ''', ''ok'': true}}'
      WHEN c = 33 THEN '{{''log'': None}}'
      WHEN c = 34 THEN '{{"log":"' || access || {nl} || '","n":01}}'
      WHEN c = 20 THEN '{{"log":"' || access || '","stream":"stderr"}}'
      ELSE '{{"log":"' || access || {nl} || '","stream":"stderr"}}' END"""
    # lines are numbered on the narrow per-event columns, before their text is built
    sql = f"""
WITH base AS ({d.dealt(line_base_sql(d, events), "filename")}),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY filename ORDER BY event_id) AS INT) AS line_number
             FROM base),
accessed AS (SELECT *, {access} AS access FROM numbered),
lined AS (SELECT filename, line_number, event_id, c, {line} AS line FROM accessed)
SELECT filename, line_number, line, event_id, c
FROM lined"""
    return sql


# --------------------------------------------------------------------------
# Spark entry points
# --------------------------------------------------------------------------

def _run(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run adapter SQL with each ``{name}`` bound to a DataFrame via a private view."""
    names = {}
    for key, df in tables.items():
        view = f"_pt_{key}_{_uuid.uuid4().hex[:12]}"
        df.createOrReplaceTempView(view)
        names[key] = view
    for key, view in names.items():
        sql = sql.replace(f"@{key}@", view)
    try:
        return spark.sql(sql)          # analysed now: the views can go afterwards
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_log(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _run(spark, page_log_sql("@events@"), events=events)


def blacklist(spark: SparkSession, nation: DataFrame, with_null: bool = False) -> DataFrame:
    return _run(spark, blacklist_sql("@nation@", with_null), nation=nation)


def agent_blacklist(spark: SparkSession, nation: DataFrame) -> DataFrame:
    return _run(spark, agent_blacklist_sql("@nation@"), nation=nation)


def bounties(spark: SparkSession, orders: DataFrame) -> DataFrame:
    return _run(spark, bounties_sql("@orders@"), orders=orders)


def raw_lines(spark: SparkSession, events: DataFrame, with_case: bool = False) -> DataFrame:
    # a line's text is built and parsed after the exchange, so the work follows the rows; left to itself, adaptive
    # execution gathers these narrow rows by their bytes (and a query that drops the numbers keeps the scan's tasks)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = _run(spark, raw_lines_sql(Dialect("spark", tasks), "@events@"), events=events)
    return df if with_case else df.select("filename", "line_number", "line")
