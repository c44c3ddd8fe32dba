"""Page log, views, visitors, snapshot, windows and readiness on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from pagetrail.functions.fixed import PAGE_LOG_COLUMNS
from pagetrail.operators import pages, readiness, snapshot, views, visitors, windows
from pagetrail.sources import fixtures as fx

PL_SCHEMA = ("time_received timestamp_ntz, uri string, referrer string, user_agent string, has_wallet boolean, "
             "ip string, session_id string, user_id int, user_id_uuid string, ga_ga string, ga_gid string")


def row(ts, uri="/analytics/ping/", referrer="-", agent="UA-1", wallet=False, user_id=1, uuid="u1"):
    return (ts, uri, referrer, agent, wallet, "1.2.3.4", "s", user_id, uuid, "g", "h")


def frame(spark, rows):
    return spark.createDataFrame(rows, PL_SCHEMA)


def agents(spark, values):
    return spark.createDataFrame([(v,) for v in values], "user_agent string")


LO, HI = datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11)


def test_window_bounds_and_notification(spark):
    rows = [row(LO), row(HI), row(HI - timedelta(microseconds=1)), row(LO - timedelta(seconds=1)),
            row(LO, uri="/notification/3"), row(LO, uri="/api/notification/3"), row(LO, uri=None)]
    out = pages.user_page_log(frame(spark, rows), agents(spark, ["UA-9"]), LO, HI).collect()
    uris = sorted((r.time_received, r.uri) for r in out)
    assert uris == sorted([(LO, "/analytics/ping/"), (HI - timedelta(microseconds=1), "/analytics/ping/"),
                           (LO, "/api/notification/3")])
    assert list(out[0].asDict()) == list(PAGE_LOG_COLUMNS)


@pytest.mark.parametrize("blacklist,expected", [
    ([], {"UA-1", "UA-2", None}),          # empty list keeps everything, NULL agents too
    (["UA-2"], {"UA-1"}),                  # NULL agent dropped once the list is non-empty
    (["UA-2", "UA-2"], {"UA-1"}),
    (["UA-2", None], set()),               # a NULL in the list empties the result
])
def test_not_in_null_semantics(spark, blacklist, expected):
    rows = [row(LO, agent="UA-1"), row(LO, agent="UA-2"), row(LO, agent=None)]
    out = pages.user_page_log(frame(spark, rows), agents(spark, blacklist), LO, HI).collect()
    assert {r.user_agent for r in out} == expected
    # the same answer as SQL NOT IN on Spark itself
    frame(spark, rows).createOrReplaceTempView("t_rows")
    agents(spark, blacklist).createOrReplaceTempView("t_bl")
    sql = spark.sql("SELECT user_agent FROM t_rows WHERE user_agent NOT IN (SELECT user_agent FROM t_bl)")
    assert {r.user_agent for r in sql.collect()} == expected


def test_bounty_views(spark):
    rows = [row(LO, referrer="https://x/bounty/12/34"), row(LO, referrer="/bounty/7/bounty/9"),
            row(LO, referrer="-"), row(LO, uri="/other", referrer="/bounty/5"), row(LO, referrer=None)]
    out = views.bounty_views(frame(spark, rows), LO, HI).collect()
    assert sorted(r.bounty_id for r in out) == [7, 12]


def test_bounty_view_overflow_fails(spark):
    df = views.bounty_views(frame(spark, [row(LO, referrer="/bounty/99999999999")]))
    with pytest.raises((ArithmeticException, NumberFormatException, Exception)):
        df.collect()


D = date(2024, 1, 15)


def at(day_offset, hour=12):
    return datetime(2024, 1, 15, hour) + timedelta(days=day_offset)


def test_visitor_previous_visit_cases(spark):
    rows = [
        row(at(0), uuid="a", user_id=1, wallet=False), row(at(0), uuid="a", user_id=1, wallet=True),
        row(at(-3), uuid="a", user_id=1), row(at(-5), uuid="a", user_id=2),        # two past user ids
        row(at(0), uuid="b", user_id=3), row(at(-1, 23), uuid="b", user_id=3),     # the day before: the cut-off, included
        row(at(0), uuid=None, user_id=4), row(at(-4), uuid=None, user_id=4),       # NULL uuid never matches
        row(at(0), uuid="c", user_id=None), row(at(-2, 23), uuid="c", user_id=None),
        row(at(0), uuid="e", user_id=6), row(at(0, 1), uuid="e", user_id=6),       # only on the day itself: first visit
        row(at(1), uuid="d", user_id=5),                                           # other day: ignored
    ]
    out = visitors.visitor_previous_visit(frame(spark, rows), D).collect()
    got = sorted((r.user_id_uuid or "", r.user_id or 0, r.pageviews, r.has_wallet, str(r.last_visit)) for r in out)
    assert got == sorted([
        ("a", 1, 2, True, "2024-01-12"), ("a", 1, 2, True, "2024-01-10"),
        ("b", 3, 1, False, "2024-01-14"),
        ("e", 6, 2, False, "0001-01-01"),
        ("", 4, 1, False, "0001-01-01"),
        ("c", 0, 1, False, "2024-01-13"),
    ])
    assert all(r.ymd == D for r in out)
    strict = visitors.visitor_previous_visit(frame(spark, rows), D, join_keys=("user_id_uuid", "user_id"))
    assert sorted((r.user_id_uuid or "", str(r.last_visit)) for r in strict.collect() if r.user_id_uuid == "a") \
        == [("a", "2024-01-12")]


def test_visitor_history_table_gives_same_answer(spark):
    rows = [row(at(k), uuid=u, user_id=i) for k in range(-6, 1) for i, u in enumerate("abc") if (k + i) % 2 == 0]
    pl = frame(spark, rows)
    history = None
    for k in range(-6, 0):
        day = D + timedelta(days=k)
        part = visitors.daily_pageviews(pl, day).select("user_id_uuid", "user_id", F.lit(day).alias("ymd"))
        history = part if history is None else history.unionByName(part)
    a = visitors.visitor_previous_visit(pl, D).collect()
    b = visitors.visitor_previous_visit(pl, D, history=history).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_hot_and_null_uuids_are_joined_apart(spark, monkeypatch):
    """A uuid with a third of a day's rows, and a third without one: same rows, salted and set aside."""
    rows = [row(at(0), uuid="hot", user_id=i) for i in range(40)] + [row(at(0), uuid=None, user_id=i) for i in range(40)]
    rows += [row(at(0), uuid=f"u{i}", user_id=i) for i in range(40)] + [row(at(-2), uuid="hot", user_id=i) for i in (1, 99)]
    rows += [row(at(-3), uuid=f"u{i}", user_id=None) for i in range(0, 40, 2)] + [row(at(-1), uuid=None, user_id=3)]
    pl = frame(spark, rows)
    assert visitors.hot_uuids(visitors.daily_pageviews(pl, D)) == ["hot"]
    for keys in (("user_id_uuid",), ("user_id_uuid", "user_id")):
        split = sorted(map(str, visitors.visitor_previous_visit(pl, D, keys).collect()))
        days = sorted(map(str, visitors.visitor_previous_visits(pl, [D], keys).collect()))
        with monkeypatch.context() as m:
            m.setattr(visitors, "hot_uuids", lambda daily: [])
            plain = sorted(map(str, visitors.visitor_previous_visit(pl, D, keys).collect()))
        assert split == plain == days and len(plain) == (160 if len(keys) == 1 else 120)


def test_state_side_is_never_moved(spark, tmp_dir):
    from pagetrail.sinks.visitor_state import VisitorState
    pl = frame(spark, [row(at(k), uuid=u, user_id=i) for k in range(-6, 1) for i, u in enumerate("abcdefgh") if (k + i) % 3 == 0])
    state = VisitorState(spark, tmp_dir, buckets=4)
    past = [D + timedelta(days=k) for k in range(-6, 0)]
    state.put_days(past, pl.withColumn("visited", F.to_date("time_received")).filter(F.col("visited") < F.lit(D)))
    state.put_upto(D + timedelta(days=-4))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for day in (D, D + timedelta(days=-2)):                       # the second is backdated
            history = state.visits(day - timedelta(days=1), day).withColumnRenamed("visited", "ymd")
            got = visitors.visitor_previous_visit(pl, day, history=history)
            want = visitors.visitor_previous_visit(pl, day)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
            plan = got._jdf.queryExecution().sparkPlan().toString()
            physical = got._jdf.queryExecution().executedPlan().toString()
            physical = physical.split("== Initial Plan ==")[-1]
            state_side = physical[physical.index("pt_state"):]
            assert "Bucketed: true" in physical and physical.count("Exchange hashpartitioning") == 2, plan
            assert state_side.count("Exchange") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    state.close()


def test_snapshot(spark):
    df = spark.createDataFrame([(1, "t", "d", "Active", 1.5, 7, datetime(2024, 2, 1), datetime(2024, 1, 1))],
                               "bounty_id int, title string, description string, bountyStage string, "
                               "usd_price double, user_id int, deadline timestamp_ntz, created timestamp_ntz")
    out = snapshot.bounty_snapshot(df, date(2024, 1, 15)).collect()[0]
    assert out.bounty_stage == "Active" and out.ymd == date(2024, 1, 15)


def test_replace_window_idempotent_and_keeps_null_times(spark):
    existing = frame(spark, [row(LO), row(LO - timedelta(hours=1)), row(None)])
    new = frame(spark, [row(LO + timedelta(minutes=5), agent="UA-new")])
    once = windows.replace_window(existing, new, "time_received", LO, HI)
    twice = windows.replace_window(once, new, "time_received", LO, HI)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    agents_ = sorted((r.user_agent, r.time_received is None) for r in once.collect())
    assert agents_ == [("UA-1", False), ("UA-1", True), ("UA-new", False)]


def test_hour_slices_union_equals_period(spark):
    rows = [row(datetime(2024, 1, 5) + timedelta(minutes=17 * i)) for i in range(300)]
    pl = frame(spark, rows)
    start, end = datetime(2024, 1, 5), datetime(2024, 1, 7)
    whole = pages.user_page_log(pl, agents(spark, []), start, end).count()
    parts = 0
    h = start
    while h < end:
        parts += pages.user_page_log(pl, agents(spark, []), h, h + timedelta(hours=1)).count()
        h += timedelta(hours=1)
    assert whole == parts == len([r for r in rows if start <= r[0] < end])


def test_month_window_and_slices():
    assert windows.month_window(date(2024, 12, 31)) == (datetime(2024, 12, 1), datetime(2025, 1, 1))
    assert windows.month_window(date(2019, 1, 31)) == (datetime(2019, 1, 1), datetime(2019, 2, 1))
    assert windows.hour_window(datetime(2019, 1, 31, 23, 59)) == (datetime(2019, 1, 31, 23), datetime(2019, 2, 1))


def test_straddling_rows(spark):
    df = spark.createDataFrame([
        ("f", 1, datetime(2019, 1, 31, 23, 59), datetime(2019, 2, 1, 0)),
        ("f", 2, datetime(2019, 2, 1, 0, 30), datetime(2019, 2, 1, 0)),
        ("f", 3, datetime(2019, 2, 1, 1, 0), datetime(2019, 2, 1, 0)),
    ], "filename string, line_number int, time_received timestamp_ntz, path_hour timestamp_ntz")
    out = {r.line_number: (r.direction, r.target_month) for r in windows.straddling_rows(df).collect()}
    assert out == {1: ("earlier", date(2019, 1, 1)), 3: ("later", date(2019, 2, 1))}


def test_readiness(spark):
    pl = frame(spark, [row(LO), row(datetime(2024, 1, 14, 23, 30))])
    assert readiness.window_ready(pl, LO, HI).collect()[0].ready is True
    assert readiness.window_ready(pl, HI, HI + timedelta(hours=1)).collect()[0].ready is False
    assert readiness.window_ready(pl, datetime(2024, 1, 1)).collect()[0].ready is True
    assert readiness.day_closed(pl, date(2024, 1, 14)).collect()[0].ready is True
    assert readiness.day_closed(pl, date(2024, 1, 15)).collect()[0].ready is False


def test_replace_window_property(spark):
    """Random rows and windows: the result equals the SQL meaning, and a second
    replacement with the same rows changes nothing."""
    import random
    rng = random.Random(5)
    base = datetime(2024, 1, 5)
    for _ in range(5):
        times = [None if rng.random() < 0.1 else base + timedelta(minutes=rng.randint(0, 600)) for _ in range(40)]
        existing = frame(spark, [row(t, agent="old") for t in times])
        lo = base + timedelta(hours=rng.randint(0, 8))
        hi = lo + timedelta(hours=rng.randint(1, 3))
        new_times = [lo + timedelta(minutes=rng.randint(0, int((hi - lo).total_seconds() // 60) - 1))
                     for _ in range(rng.randint(0, 5))]
        new = frame(spark, [row(t, agent="new") for t in new_times])
        once = windows.replace_window(existing, new, "time_received", lo, hi)
        keep = [t for t in times if t is None or not (lo <= t < hi)]
        assert sorted(map(str, ((r.time_received, r.user_agent) for r in once.collect()))) == sorted(
            map(str, [(t, "old") for t in keep] + [(t, "new") for t in new_times]))
        twice = windows.replace_window(once, new, "time_received", lo, hi)
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_not_in_large_list_sends_only_possible_hits_to_the_join(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("agent "), F.col("id") * 1000)).alias("user_agent"))
    listed = spark.range(1_000_000).select(F.concat(F.lit("agent "), F.col("id") * 2).alias("user_agent"))
    some = listed.filter("hash(user_agent) % 2 = 0")
    null = spark.createDataFrame([(None,)], "user_agent string")
    for excluded in (listed, some, some.unionAll(null), some.limit(0), null):
        want = pages.not_in_list(rows, "user_agent", excluded)
        got = pages.not_in_list(rows, "user_agent", excluded, large_list=True)
        assert got.columns == rows.columns
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
    plan = pages.not_in_list(rows, "user_agent", some, large_list=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("getbit") >= 2 and "LeftAnti" in plan
    surely, possible = plan.split("Union", 1)[1].split("SortMergeJoin", 1)
    assert "hashpartitioning(user_agent" not in surely  # rows that are surely not listed are not moved
    assert possible.index("hashpartitioning(user_agent") < possible.index("getbit")  # tested below the exchange


def test_lines_of_few_bytes_are_parsed_in_many_tasks(spark):
    """Lines are built and parsed in all shuffle partitions, not in the tasks that read the narrow rows."""
    events = spark.range(0, 20000, 1, 3).selectExpr(
        "id AS event_id", "CAST(date_add(DATE '2024-01-01', CAST(id % 20 AS INT)) AS TIMESTAMP_NTZ) AS ts", "id % 50 AS user_id", "'view' AS event_type")
    lines = fx.raw_lines(spark, events)
    tasks = lines.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum(F.length("line")))
    counts = [r["n"] for r in tasks.collect()]
    assert sum(counts) == 20000
    assert len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
