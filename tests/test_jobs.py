"""End-to-end runs over real files: ingest, page log, views, visitors, snapshot."""

import os
from collections import defaultdict
from datetime import date, datetime, timedelta

from conftest import SF_SMALL
from pagetrail.operators import pages, parse, views, visitors
from pagetrail.plans import jobs
from pagetrail.sinks import commits, tables
from pagetrail.sources import fixtures as fx
from pagetrail.sources.logfiles import read_log_lines


def _write_source_files(spark, root):
    """Write the adapter's lines of three hours as files in the source layout (YYYY/MM/DD/HH/*.log)."""
    lines = fx.raw_lines(spark, fx.load(spark, "/root/testdata/sf0.01", "events"))
    lines = lines.filter(lines.filename.rlike("^logs/2024/01/01/0[0-2]/")).collect()
    files = defaultdict(list)
    for r in lines:
        files[r.filename].append((r.line_number, r.line))
    for name, rows in files.items():
        path = os.path.join(root, name[len("logs/"):])
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as fh:
            fh.write("\n".join(line for _, line in sorted(rows)))
    return list(files)


def test_daily_chain_is_repeatable(spark, tmp_dir):
    logs, wh = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "wh")
    names = _write_source_files(spark, logs)
    hours = sorted({datetime.strptime(n.split("/", 1)[1][:13], "%Y/%m/%d/%H") for n in names})
    for h in hours:
        q = jobs.ingest_hour(spark, logs, wh, h)
        assert q.count() == len([n for n in names if f"{h:%Y/%m/%d/%H}" in n])
    jobs.ingest_hour(spark, logs, wh, hours[0])                      # rerun: same table
    raw = spark.read.parquet(f"{wh}/raw_logs")
    all_lines = read_log_lines(spark, logs)
    wanted = all_lines.filter(all_lines.filename.rlike("|".join(f"{h:%Y/%m/%d/%H}" for h in hours)))
    expected_raw = parse.good_rows(parse.parse_lines(wanted))
    assert raw.count() == expected_raw.count() > 0

    blacklist = fx.blacklist(spark, fx.load(spark, SF_SMALL, "nation"))
    start, end = hours[0], hours[-1] + timedelta(hours=1)
    for lo, hi in jobs.hourly_runs(start, end):
        jobs.page_log_run(spark, wh, blacklist, lo, hi)
        jobs.bounty_view_run(spark, wh, lo, hi)
    jobs.page_log_run(spark, wh, blacklist, start, start + timedelta(hours=1))   # rerun one hour
    page_log = jobs.page_log_window(spark, wh, start, end)
    direct = pages.user_page_log(jobs.raw_window(spark, wh, start, end), blacklist, start, end)
    assert sorted(map(tuple, page_log.collect())) == sorted(map(tuple, direct.collect()))
    got_views = spark.read.parquet(f"{wh}/log_bounty_view").drop("row_added", "event_date", "event_hour")
    assert got_views.count() == views.bounty_views(direct).count()

    day = date(2024, 1, 1)
    for _ in range(2):
        jobs.visitor_run(spark, wh, day, buckets=2)
    out = spark.read.parquet(f"{wh}/agg_visitor_previous_visit")
    assert out.count() == visitors.visitor_previous_visit(page_log, day).count()

    bounties = fx.bounties(spark, fx.load(spark, SF_SMALL, "orders"))
    jobs.snapshot_run(spark, wh, bounties, day)
    jobs.snapshot_run(spark, wh, bounties, day)
    assert spark.read.parquet(f"{wh}/agg_bounty_snapshot").count() == bounties.count()


def test_backfill_day_in_one_job_equals_hourly_backfill(spark, tmp_dir):
    logs = os.path.join(tmp_dir, "logs")
    names = _write_source_files(spark, logs)
    day = date(2024, 1, 1)
    wh_day, wh_hours = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    files_seen = jobs.ingest_day(spark, logs, wh_day, day).count()
    jobs.ingest_day(spark, logs, wh_day, day)                                  # rerun: same table
    hours = sorted({datetime.strptime(n.split("/", 1)[1][:13], "%Y/%m/%d/%H") for n in names})
    for h in hours:
        jobs.ingest_hour(spark, logs, wh_hours, h, mode="backfill")
    a = spark.read.parquet(f"{wh_day}/raw_logs").drop("row_added")
    b = spark.read.parquet(f"{wh_hours}/raw_logs").drop("row_added")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.count() > 0
    assert files_seen == len(names)


def test_reprocess_picks_up_a_late_file(spark, tmp_dir):
    logs, wh = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "wh")
    names = sorted(_write_source_files(spark, logs))
    late = os.path.join(logs, names[-1][len("logs/"):])
    held_back = late + ".hold"
    os.rename(late, held_back)                         # the last file arrives late
    blacklist = fx.blacklist(spark, fx.load(spark, SF_SMALL, "nation"))
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 3)
    for lo, hi in jobs.hourly_runs(start, end):
        jobs.ingest_hour(spark, logs, wh, lo)
    jobs.page_log_run(spark, wh, blacklist, start, end)
    jobs.visitor_run(spark, wh, date(2024, 1, 1), buckets=2)
    before = jobs.page_log_window(spark, wh, start, end).count()
    os.rename(held_back, late)
    late_hour = datetime.strptime(names[-1].split("/", 1)[1][:13], "%Y/%m/%d/%H")
    jobs.reprocess(spark, logs, wh, blacklist, None, late_hour, late_hour + timedelta(hours=1), buckets=2)
    after = jobs.page_log_window(spark, wh, start, end)
    expected = pages.user_page_log(jobs.raw_window(spark, wh, start, end), blacklist, start, end)
    assert sorted(map(str, after.collect())) == sorted(map(str, expected.collect()))
    assert after.count() >= before


def files_of(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_changes_are_followed_and_nothing_else(spark, tmp_dir):
    """Late rows reach the touched hours and the days that look back on them; all other files stay."""
    wh = os.path.join(tmp_dir, "wh")
    times = {1: ["a", "b"], 2: ["c"], 3: ["a"], 4: ["b", "c"], 5: ["a"]}   # day: visitors

    def load(day, visitors, name):
        rows = spark.createDataFrame(
            [(1, "1.2.3.4", 1, 1, datetime(2024, 1, day, 10, i), "GET", "/x", 1, 200, 1, 1, 1, 1, "-", "UA", False, "s", 1, u, "g", "h")
             for i, u in enumerate(visitors)], tables.RAW_LOGS_DDL.rsplit(", row_added", 1)[0])
        tables.write_raw_hours(rows, f"{wh}/raw_logs", [datetime(2024, 1, day, 10)])
        commits.record_change(commits.event_hours(rows), wh, name)

    for day, visitors_ in times.items():
        load(day, visitors_, f"first-{day}")
    none = spark.createDataFrame([], "user_agent string")
    hours, days = jobs.derive_changes(spark, wh, none, through=date(2024, 1, 31), buckets=2)
    assert len(hours) == 5 and days == [date(2024, 1, d) for d in range(1, 6)]
    assert jobs.derive_changes(spark, wh, none, buckets=2) == ([], [])     # worked off

    def answers():
        out = spark.read.parquet(f"{wh}/agg_visitor_previous_visit").collect()
        return {(r.ymd.day, r.user_id_uuid): r.last_visit.day if r.last_visit.year > 1 else None for r in out}

    assert answers() == {(1, "a"): None, (1, "b"): None, (2, "c"): None, (3, "a"): 1, (4, "b"): 1, (4, "c"): 2, (5, "a"): 3}
    before = files_of(wh)
    load(2, ["c", "a"], "late")                                     # a was there on the 2nd, too
    hours, days = jobs.derive_changes(spark, wh, none, buckets=2)
    assert hours == [datetime(2024, 1, 2, 10)] and days == [date(2024, 1, 2), date(2024, 1, 3)]
    assert answers() == {(1, "a"): None, (1, "b"): None, (2, "c"): None, (2, "a"): 1, (3, "a"): 2, (4, "b"): 1, (4, "c"): 2, (5, "a"): 3}
    kept = [f for f in before if "user_page_log" in f or "agg_" in f]
    gone = [f for f in kept if not os.path.exists(f)]
    assert gone and all("2024-01-02" in f or "ymd=2024-01-03" in f for f in gone)
    load(2, ["a"], "c was never there")
    assert jobs.derive_changes(spark, wh, none, buckets=2)[1] == [date(2024, 1, 2), date(2024, 1, 4)]
    assert answers()[4, "c"] is None and (2, "c") not in answers()
