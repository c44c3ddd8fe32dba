"""Log files in, partitioned tables out, and the incremental file stream."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_parse import ACCESS, env
from pagetrail.operators.parse import good_rows, parse_lines, rejected_rows
from pagetrail.operators.quality import failure_samples, file_quality
from pagetrail.plans import jobs
from pagetrail.plans.staging import parse_files
from pagetrail.sinks import commits, tables
from pagetrail.sources.logfiles import empty_files, read_log_lines
from pagetrail.streaming import ingest
from pagetrail.streaming.ingest import ingest_available

LINE = env(ACCESS + "\n")


def write_file(root, rel, text, binary=False):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if binary:
        with open(path, "wb") as fh:
            fh.write(text)
    else:
        with open(path, "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    return path


def test_read_hour_keeps_trailing_empty_line(spark, tmp_dir):
    write_file(tmp_dir, "2019/01/21/00/a.log", LINE + "\n" + LINE + "\n")     # final newline: 3 pieces
    write_file(tmp_dir, "2019/01/21/00/b.log", LINE)                         # no final newline: 1 piece
    write_file(tmp_dir, "2019/01/21/00/c.txt", LINE)                         # not a .log: ignored
    write_file(tmp_dir, "2019/01/21/01/d.log", LINE)                         # other hour
    lines = read_log_lines(spark, tmp_dir, hour=datetime(2019, 1, 21, 0))
    q = {os.path.basename(r.filename): (r.file_line_count, r.file_bad_lines)
         for r in file_quality(parse_lines(lines)).collect()}
    assert q == {"a.log": (3, 1), "b.log": (1, 0)}
    assert sorted(r.line_number for r in lines.collect() if r.filename.endswith("a.log")) == [1, 2, 3]
    day = read_log_lines(spark, tmp_dir, day=date(2019, 1, 21))
    assert {os.path.basename(r.filename) for r in day.collect()} == {"a.log", "b.log", "d.log"}


def test_strict_utf8(spark, tmp_dir):
    write_file(tmp_dir, "2019/01/21/00/a.log", LINE.encode() + b"\n\xff\xfe\n", binary=True)
    lenient = read_log_lines(spark, tmp_dir, hour=datetime(2019, 1, 21, 0), strict_utf8=False)
    assert lenient.count() == 3
    with pytest.raises(Exception, match="invalid UTF-8"):
        read_log_lines(spark, tmp_dir, hour=datetime(2019, 1, 21, 0)).collect()


def pl_rows(spark, times):
    return spark.createDataFrame([(t, "/analytics/ping/", "-", "UA", False, "1.2.3.4", "s", 1, "u", "g", "h")
                                  for t in times],
                                 "time_received timestamp_ntz, uri string, referrer string, user_agent string, "
                                 "has_wallet boolean, ip string, session_id string, user_id int, "
                                 "user_id_uuid string, ga_ga string, ga_gid string")


def test_write_window_replaces_exactly_the_window(spark, tmp_dir):
    root = os.path.join(tmp_dir, "page_log")
    h9, h10, h11 = (datetime(2024, 1, 5, h) for h in (9, 10, 11))
    tables.write_window(pl_rows(spark, [h9, h10, h10 + timedelta(minutes=5)]), root, h9, h11)
    assert tables.read_window(spark, root, h9, h11).count() == 3
    # rerun of hour 10 with one row: hour 9 untouched, hour 10 replaced
    tables.write_window(pl_rows(spark, [h10 + timedelta(minutes=1)]), root, h10, h11)
    tables.write_window(pl_rows(spark, [h10 + timedelta(minutes=1)]), root, h10, h11)
    got = sorted(r.time_received for r in tables.read_window(spark, root, h9, h11).collect())
    assert got == [h9, h10 + timedelta(minutes=1)]
    # an empty result clears the hour
    tables.write_window(pl_rows(spark, []), root, h10, h11)
    assert [r.time_received for r in tables.read_window(spark, root, h9, h11).collect()] == [h9]
    # rows outside the window are never written
    tables.write_window(pl_rows(spark, [h11 + timedelta(minutes=3)]), root, h10, h11)
    assert tables.read_window(spark, root, h9, h11 + timedelta(hours=2)).count() == 1


def test_write_slice_and_ingest_hour(spark, tmp_dir):
    root = os.path.join(tmp_dir, "agg")
    df = spark.createDataFrame([("u", 1, date(2024, 1, 15))], "user_id_uuid string, user_id int, ymd date")
    tables.write_slice(df, root, date(2024, 1, 15))
    tables.write_slice(df, root, date(2024, 1, 15))
    back = tables.read_table(spark, root, "ymd DATE")
    assert back.count() == 1 and back.collect()[0].ymd == date(2024, 1, 15)

    raw_root = os.path.join(tmp_dir, "raw")
    lines = spark.createDataFrame([("f", 1, LINE)], "filename string, line_number int, line string")
    good = good_rows(parse_lines(lines))
    hour = datetime(2019, 1, 21, 1)
    tables.write_raw_hours(good, raw_root, [hour])
    tables.write_raw_hours(good, raw_root, [hour])
    # the row's own time (00:00:01) lies outside its ingest hour; a time filter still finds it
    got = tables.read_ingested(spark, raw_root, datetime(2019, 1, 21), datetime(2019, 1, 21, 1))
    assert got.count() == 1


def rows_in(spark, wh):
    return sorted(map(str, jobs.raw_window(spark, wh, None).collect()))


def quality_in(spark, wh):
    rows = tables.read_table(spark, f"{wh}/files_processed", "ingest_date DATE, ingest_hour INT, load STRING")
    return sorted((os.path.basename(r.filename), r.file_line_count, r.file_bad_lines, r.file_regex_failed)
                  for r in rows.filter(commits.committed(spark, wh)).collect())


def test_stream_into_the_raw_log_is_exactly_once(spark, tmp_dir, monkeypatch):
    src, wh, ck = (os.path.join(tmp_dir, n) for n in ("logs", "wh", "ck"))
    write_file(src, "2019/01/21/00/a.log", LINE + "\n" + LINE + "\n")
    write_file(src, "2019/01/21/01/b.log", LINE + "\nnot a literal\n" + env(ACCESS.replace("pid: 12", "pid: 99999999999") + "\n"))
    write_file(src, "2019/01/21/01/empty.log", "")
    write_file(src, "2019/01/21/01/mark.log", "\ufeff")
    ingest_available(spark, src, wh, ck)
    batch = os.path.join(tmp_dir, "batch")
    for h in (0, 1):
        jobs.ingest_hour(spark, src, batch, datetime(2019, 1, 21, h))
    assert rows_in(spark, wh) == rows_in(spark, batch) and len(rows_in(spark, wh)) == 3
    assert quality_in(spark, wh) == quality_in(spark, batch) == [
        ("a.log", 3, 1, 0), ("b.log", 3, 1, 0), ("empty.log", 1, 1, 0), ("mark.log", 1, 1, 0)]
    rejected = spark.read.parquet(f"{wh}/rejected_lines").collect()
    assert [(os.path.basename(r.filename), r.line_number) for r in rejected] == [("b.log", 3)]
    # nothing new: nothing loaded
    loads = commits.last_loads(spark, wh)
    ingest_available(spark, src, wh, ck)
    assert commits.last_loads(spark, wh) == loads and len(rows_in(spark, wh)) == 3
    # a new file, and a run that dies between its rows and its commit
    write_file(src, "2019/01/21/02/c.log", LINE)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(Exception):
            ingest_available(spark, src, wh, ck)
    assert len(rows_in(spark, wh)) == 3                              # not committed: not read
    ingest_available(spark, src, wh, ck)                             # replayed by the stream
    assert len(rows_in(spark, wh)) == 4
    # replayed after its commit: found and left
    tables.delete(spark, f"{ck}/commits/1")
    ingest_available(spark, src, wh, ck)
    assert len(rows_in(spark, wh)) == 4 and len(quality_in(spark, wh)) == 5
    # the batch run of an hour takes over what the stream loaded there
    jobs.ingest_hour(spark, src, wh, datetime(2019, 1, 21, 2))
    assert len(rows_in(spark, wh)) == 4
    write_file(src, "2019/01/21/02/d.log", LINE)
    jobs.ingest_hour(spark, src, wh, datetime(2019, 1, 21, 2))
    ingest_available(spark, src, wh, ck)                             # finds d.log loaded already
    assert len(rows_in(spark, wh)) == 5 and len(quality_in(spark, wh)) == 6
    with pytest.raises(ValueError):
        ingest_available(spark, src, wh, "")


def test_one_scan_numbers_like_the_line_reader(spark, tmp_dir):
    """Numbers, counts and rows of the staged parse equal those of the reader that numbers every line."""
    bad_uuid = env(ACCESS.replace("pid: 12", "pid: 99999999999") + "\n")
    body = [LINE, "", "{'log': 'GET / 200\\n'}", env("GET / 200\n"), bad_uuid, "{'log': None}", "x"] * 40
    contents = {"a.log": "\n".join(body) + "\n", "b.log": "\n".join(body[3:]), "empty.log": "", "mark.log": "\ufeff",
                "marked good.log": "\ufeff" + LINE + "\n" + LINE, "marked failed.log": "\ufeff" + env("GET / 200\n") + "\n", "nl.log": "\n"}
    for name, text in contents.items():
        write_file(tmp_dir, f"2019/01/21/00/{name}", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        staged = parse_files(spark, tmp_dir, hour=datetime(2019, 1, 21))
        parsed = parse_lines(read_log_lines(spark, tmp_dir, hour=datetime(2019, 1, 21))).cache()
        parsed.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    plain = lambda df: df.withColumn("filename", F.regexp_replace("filename", "^file:/+", "/"))
    assert same(staged.good(), good_rows(parsed))
    assert same(plain(staged.samples()), plain(failure_samples(parsed)))
    assert same(plain(staged.rejected()), plain(rejected_rows(parsed)))
    assert same(plain(staged.quality()), plain(file_quality(parsed)))
    assert staged.quality().count() == len(contents)
    with pytest.raises(ValueError, match="unstorable"):
        staged.good(strict=True)
    parsed.unpersist()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = lambda df: df._jdf.queryExecution().toString()
        clean = parse_files(spark, os.path.join(tmp_dir, "nothing here"), hour=datetime(2019, 1, 21))
        assert "Exchange" not in text(clean.good()) and "Join" not in text(clean.good())  # no file has a mark
        assert "ArrowEvalPython" not in text(staged.good()) and "FileScan text" not in text(staged.quality())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_root_with_pattern_characters(spark, tmp_dir):
    root = os.path.join(tmp_dir, "wh[1]{a}*?")
    h9, h10, h11 = (datetime(2024, 1, 5, h) for h in (9, 10, 11))
    tables.write_window(pl_rows(spark, [h9, h10]), root, h9, h11)
    tables.write_window(pl_rows(spark, [h10]), root, h9, h11)
    read = tables.read_window(spark, root, h9, h11, schema=tables.PAGE_LOG_DDL).collect()
    assert [r.time_received for r in read] == [h10]


def test_rows_of_other_hours_are_refused(spark, tmp_dir):
    lines = spark.createDataFrame([("f", 1, LINE)], "filename string, line_number int, line string")
    rows = good_rows(parse_lines(lines)).withColumn("h", F.lit("2019-01-21 05:00:00").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="hour that is not replaced"):
        tables.write_raw_hours(rows, os.path.join(tmp_dir, "raw"), [datetime(2019, 1, 21, 4)], hour_col="h")


def test_split_reader_equals_python_split(spark, tmp_dir):
    """Files cut into many splits read back exactly as text.split("\\n") numbers them."""
    import random
    rng = random.Random(11)
    contents = {
        "2019/01/21/00/empty.log": "",
        "2019/01/21/00/nl.log": "a\nb\n",
        "2019/01/21/00/no_nl.log": "a\nb",
        "2019/01/21/00/only_nl.log": "\n",
        "2019/01/21/00/crlf.log": "x\r\ny\r\n",
        "2019/01/21/00/utf8.log": "café\n中文\nlast",
        "2019/01/21/00/bom.log": "\ufeffa\nb\n",         # byte-order mark kept, as decode("utf-8") does
        "2019/01/21/00/bom_no_nl.log": "\ufeffa\nb",
        "2019/01/21/00/only_bom.log": "\ufeff",
        "2019/01/21/00/a b+c%20d.log": "one\ntwo",
        "2019/01/21/00/empty name.log": "",
    }
    for i in range(3):
        body = "\n".join(LINE if rng.random() < 0.7 else "x" * rng.randint(0, 300) for _ in range(rng.randint(50, 200)))
        contents[f"2019/01/21/00/big{i}.log"] = body + ("\n" if i % 2 == 0 else "")
    for rel, text in contents.items():
        write_file(tmp_dir, rel, text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")    # many splits per big file
    try:
        split = read_log_lines(spark, tmp_dir, hour=datetime(2019, 1, 21, 0))
        got = {(os.path.basename(r.filename), r.line_number): r.line for r in split.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = read_log_lines(spark, tmp_dir, hour=datetime(2019, 1, 21, 0))
    want = {}
    for rel, text in contents.items():
        for i, piece in enumerate(text.split("\n")):
            want[(os.path.basename(rel), i + 1)] = piece
    assert got == want
    assert len(split.select("filename", "line_number").distinct().collect()) == len(want)
    assert {(os.path.basename(r.filename), r.line_number): r.line for r in whole.collect()} == want


def test_rewriting_a_path_with_a_space_and_an_unreadable_file(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw log")
    hour = datetime(2019, 1, 21, 0)
    lines = spark.createDataFrame([("f", 1, env(ACCESS + "\n"))], "filename string, line_number int, line string")
    for _ in range(2):
        tables.write_raw_hours(good_rows(parse_lines(lines)), root, [hour])
    assert tables.read_ingested(spark, root, None).count() == 1
    broken = os.path.join(root, "event_date=2019-01-21", "ingest_date=2019-01-21", "ingest_hour=0", "load=batch", "part-broken.parquet")
    write_file(os.path.dirname(broken), "part-broken.parquet", "not parquet")
    with pytest.raises(Exception):
        tables.read_ingested(spark, root, None).collect()
    tables.write_raw_hours(good_rows(parse_lines(lines)), root, [hour])  # replaced, not appended to
    assert tables.read_ingested(spark, root, None).count() == 1


def test_raw_hour_rerun_clears_rows_of_other_event_dates(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    hour = datetime(2019, 2, 1, 0)
    lines = spark.createDataFrame(
        [("f", 1, env(ACCESS.replace("Mon Jan 21 00:00:01 2019", "Thu Jan 31 23:59:59 2019") + "\n")),
         ("f", 2, env(ACCESS.replace("Mon Jan 21 00:00:01 2019", "Fri Feb  1 00:10:00 2019") + "\n"))],
        "filename string, line_number int, line string")
    tables.write_raw_hours(good_rows(parse_lines(lines)), root, [hour])
    both = tables.read_ingested(spark, root, datetime(2019, 1, 31), datetime(2019, 2, 2))
    assert both.count() == 2
    # the file of that hour now holds only the February row: the January row must go
    tables.write_raw_hours(good_rows(parse_lines(lines.filter("line_number = 2"))), root, [hour])
    left = tables.read_ingested(spark, root, datetime(2019, 1, 31), datetime(2019, 2, 2)).collect()
    assert [r.time_received for r in left] == [datetime(2019, 2, 1, 0, 10)]
    # a window read only lists its own event dates
    assert tables.read_ingested(spark, root, datetime(2019, 1, 31), datetime(2019, 2, 1)).count() == 0


def test_open_ended_window_reads(spark, tmp_dir):
    from pagetrail.plans.jobs import hourly_runs
    root = os.path.join(tmp_dir, "pl")
    times = [datetime(2024, 1, 5, h, 30) for h in (8, 9, 10, 23)] + [datetime(2024, 1, 6, 0, 5)]
    tables.write_window(pl_rows(spark, times), root, datetime(2024, 1, 5), datetime(2024, 1, 7))
    read = lambda lo, hi: sorted(r.time_received for r in tables.read_window(
        spark, root, lo, hi, schema=tables.PAGE_LOG_DDL).collect())
    assert read(None, datetime(2024, 1, 5, 10)) == times[:2]
    assert read(datetime(2024, 1, 5, 23), None) == times[3:]
    assert read(None, None) == times
    slices = list(hourly_runs(datetime(2024, 1, 5, 22, 15), datetime(2024, 1, 6, 1)))
    assert slices == [(datetime(2024, 1, 5, 22), datetime(2024, 1, 5, 23)),
                      (datetime(2024, 1, 5, 23), datetime(2024, 1, 6, 0)),
                      (datetime(2024, 1, 6, 0), datetime(2024, 1, 6, 1))]


def test_writes_make_a_file_per_small_partition_whatever_the_tasks(spark, tmp_dir):
    """Rows of few hours held by many tasks: a file an hour, not a file an hour and task."""
    hours = [datetime(2024, 1, 5, h) for h in range(6)]
    rows = spark.range(0, 600, 1, 12).select(
        F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 6 as int), cast(id % 60 as int), 0)").alias("time_received"),
        F.col("id").alias("pid"))
    filed = rows.withColumn("_ingest_hour", F.date_trunc("hour", "time_received").cast("timestamp_ntz"))
    tables.write_window(rows, f"{tmp_dir}/window", hours[0], hours[-1] + timedelta(hours=1))
    tables.write_hours(rows, f"{tmp_dir}/hours", hours)
    tables.write_raw_hours(filed, f"{tmp_dir}/raw", hours, "_ingest_hour")
    tables.write_loads(filed, f"{tmp_dir}/loads", hours, "_ingest_hour")
    for name in ("window", "hours", "raw", "loads"):
        files = [f for _, _, names in os.walk(f"{tmp_dir}/{name}") for f in names if f.endswith(".parquet")]
        assert len(files) == 6, name
        found = spark.read.parquet(f"{tmp_dir}/{name}").select("pid").collect()
        assert sorted(r["pid"] for r in found) == list(range(600)), name


def test_loaded_files_are_not_looked_through_for_empty_ones(spark, tmp_dir, monkeypatch):
    logs, warehouse, checkpoint = (os.path.join(tmp_dir, x) for x in ("logs", "wh", "state"))
    write_file(logs, "2019/01/21/00/a.log", LINE + "\n")
    write_file(logs, "2019/01/21/00/b.log", LINE)
    calls = []
    monkeypatch.setattr(ingest, "empty_files", lambda *a: calls.append(a) or empty_files(*a))
    ingest_available(spark, logs, warehouse, checkpoint)
    assert not calls  # all files that are listed have been loaded
    write_file(logs, "2019/01/21/00/none.log", "")
    write_file(logs, "2019/01/21/00/mark.log", b"\xef\xbb\xbf", binary=True)
    write_file(logs, "2019/01/21/01/c d.log", LINE)
    ingest_available(spark, logs, warehouse, checkpoint)
    assert len(calls) == 1
    ingest_available(spark, logs, warehouse, checkpoint)
    assert len(calls) == 1
    done = tables.read_table(spark, f"{warehouse}/files_processed", "ingest_date DATE, ingest_hour INT, load STRING")
    assert sorted((os.path.basename(r.filename), r.file_line_count, r.file_bad_lines) for r in done.collect()) == [
        ("a.log", 2, 1), ("b.log", 1, 0), ("c d.log", 1, 0), ("mark.log", 1, 1), ("none.log", 1, 1)]
