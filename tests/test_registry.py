"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from pagetrail.plans import registry  # noqa: E402

SLOW = {"ingest_files_roundtrip", "ingest_stream_available_now", "file_quality_roundtrip",
        "bounty_view_log_via_tables", "stream_file_quality", "late_data_page_log", "late_data_views", "late_data_visitors",
        "ingest_hour_prefix", "ingest_day_prefix", "failing_lines_of_files", "raw_log_rewritten", "page_log_rewritten",
        "files_processed_rewritten", "failure_samples_rewritten", "bounty_views_rewritten", "visitor_previous_visit_from_state"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if n not in SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = rows_of(res.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id_uuid", "user_id", "ymd", "has_wallet", "pageviews", "last_visit"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["user_page_log_hour", "visitor_previous_visit", "hourly_windows",
                                  "straddling_rows", "parse_access_log"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = entry.queries()[name](spark, SF_SMALL)
        got = rows_of([tuple(r) for r in df.collect()], df.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(entry.oracle_sql()[name])
    assert got == rows_of(res.fetchall(), [d[0] for d in res.description])
