"""Parser tests: one hand-written line per outcome rule, then generated lines
compared with the brute-force model (``line_model.expected``)."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from line_model import expected, random_line
from pagetrail.functions.fixed import RAW_COLUMNS
from pagetrail.operators.parse import good_rows, parse_lines, rejected_rows
from pagetrail.operators.quality import failure_samples, file_quality

ACCESS = ("[pid: 12|app: -|req: -/-] 1.2.3.4 (-) {48 vars in 800 bytes} [Mon Jan 21 00:00:01 2019] "
          "GET /analytics/ping/ => generated 123 bytes in 45 msecs (HTTP/1.1 200) 5 headers in 200 bytes "
          "(1 switches on core 0) referrer: https://x.example/bounty/7/ UA Test Agent has wallet: true "
          "cookies: session_id=s1; user_id=5; uuid=a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11; _ga=G1; _gid=G2")


def env(log: str, extra: str = ',"stream":"stderr"') -> str:
    return '{"log":"' + log.replace("\n", "\\n") + '"' + extra + "}"


GOOD = env(ACCESS + "\n")

# (line, hourly outcome, backfill outcome)
RULES = [
    ("", "bad", "bad"),                                              # 1: empty
    (GOOD + " trailing", "bad", "bad"),                              # 1: trailing text
    (env(ACCESS + "\n", ',"stream":null'), "bad", "bad"),            # 1: null literal
    (env(ACCESS + "\n", ',"tty":false'), "bad", "bad"),              # 1: false literal
    ('"just a string"', "bad", "bad"),                               # 2: not a dict
    ('{"message":"x"}', "bad", "bad"),                               # 2: no log
    ('{"log":12,"stream":"stderr"}', "regex_failed", "regex_failed"),  # 3: numeric log
    ('{"log":{"a":"b"}}', "regex_failed", "regex_failed"),           # 3: dict log
    (env("WARNING:django.request:Not Found: /x\n"), "bad", "skipped"),  # 4
    (env("Not Found: /x\n"), "bad", "skipped"),                      # 4
    (env("hello\n"), "regex_failed", "regex_failed"),                # 5
    (env(ACCESS), "regex_failed", "regex_failed"),                   # 5: no newline
    (env(ACCESS.replace("user_id=5", "user_id=five") + "\n"), "bad", "bad"),   # 6
    (env(ACCESS.replace("user_id=5", "user_id=") + "\n"), "bad", "bad"),       # 6: empty value
    (env(ACCESS.replace("Jan 21", "Feb 30") + "\n"), "bad", "bad"),            # 7
    (env(ACCESS.replace("00:00:01", "00:00:60") + "\n"), "bad", "bad"),        # 7: second 60
    (env(ACCESS.replace("[pid: 12|", "[pid: |") + "\n"), "bad", "bad"),        # 8
    (env(ACCESS.replace("GET", "PROPFINDALL") + "\n"), "regex_failed", "rejected"),  # 9
    (GOOD, "good", "good"),                                          # 10
    (env(ACCESS.replace("1.2.3.4", "1.2.3.4, 5.6.7.8") + "\n"), "good", "regex_failed"),  # forwarded list
    (env(ACCESS.replace("[pid: 12|", "[pid: 99999999999|") + "\n"), "rejected", "rejected"),  # 11
    (env(ACCESS.replace("a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", "zz") + "\n"), "rejected", "rejected"),
    (env(ACCESS.replace("1.2.3.4", "1.2.3.400") + "\n"), "rejected", "rejected"),
]


def _frame(spark, lines):
    rows = [("f.log", i + 1, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "filename string, line_number int, line string")


@pytest.mark.parametrize("mode,index", [("hourly", 1), ("backfill", 2)])
def test_rule_table(spark, mode, index):
    lines = [r[0] for r in RULES]
    got = {r.line_number: r.outcome for r in parse_lines(_frame(spark, lines), mode).collect()}
    for i, rule in enumerate(RULES):
        assert got[i + 1] == rule[index], (mode, rule[0][:80])
        assert expected(rule[0], mode)[0] == rule[index], ("model", mode, rule[0][:80])


def test_good_values(spark):
    row = good_rows(parse_lines(_frame(spark, [GOOD]))).collect()[0].asDict()
    assert row["ip"] == "1.2.3.4"
    assert row["time_received"] == datetime(2019, 1, 21, 0, 0, 1)
    assert row["pid"] == 12 and row["core"] == 0 and row["http_status"] == 200
    assert row["has_wallet"] is True
    assert (row["session_id"], row["user_id"], row["user_id_uuid"], row["ga_ga"], row["ga_gid"]) == (
        "s1", 5, "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", "G1", "G2")
    assert list(row) == list(RAW_COLUMNS)


def test_cookie_rules(spark):
    lines = [
        env(ACCESS.replace("session_id=s1", "session_id=a=b") + "\n"),          # cut at second '='
        env(ACCESS.replace("user_id=5", "user_id=9; user_id= +7 ") + "\n"),    # last duplicate wins
        env(ACCESS.replace("uuid=a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11",
                           "uuid={A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11}") + "\n"),  # canonical uuid
        env(ACCESS.replace("; _ga=G1; _gid=G2", "") + "\n"),                    # missing cookies
        env(ACCESS.replace("user_id=5", "user_id=5; user_id=x") + "\n"),       # any bad user_id: bad
    ]
    rows = {r.line_number: r for r in parse_lines(_frame(spark, lines)).collect()}
    assert rows[1].session_id == "a"
    assert rows[2].user_id == 7
    assert rows[3].user_id_uuid == "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    assert rows[4].ga_ga is None and rows[4].ga_gid is None
    assert rows[5].outcome == "bad"


def test_single_quoted_and_duplicate_log(spark):
    py_dict = "{'log': '" + ACCESS.replace("'", "\\'") + "\\n', 'stream': 'stderr'}"
    dup = '{"log":"x","log":"' + ACCESS + '\\n"}'
    out = {r.line_number: r.outcome for r in parse_lines(_frame(spark, [py_dict, dup])).collect()}
    assert out == {1: "good", 2: "good"}


@pytest.mark.parametrize("mode", ["hourly", "backfill"])
def test_generated_lines_match_model(spark, mode):
    rng = random.Random(20240105 + (mode == "backfill"))
    lines = [random_line(rng) for _ in range(600)]
    parsed = {r.line_number: r.asDict() for r in parse_lines(_frame(spark, lines), mode).collect()}
    mismatches = []
    for i, line in enumerate(lines):
        outcome, values = expected(line, mode)
        got = parsed[i + 1]
        if got["outcome"] != outcome:
            mismatches.append((line, outcome, got["outcome"]))
            continue
        if outcome == "good":
            for key, val in values.items():
                if got[key] != val:
                    mismatches.append((line, key, val, got[key]))
    assert not mismatches, mismatches[:5]
    outcomes = {o for o in (expected(x, mode)[0] for x in lines)}
    assert {"good", "bad", "regex_failed", "rejected"} <= outcomes


def test_python_only_envelopes_follow_the_literal_rule(spark):
    rng = random.Random(7)
    good = '"log":"' + ACCESS + '\\n"'
    lines = [random_line(rng) for _ in range(200)] + ["{'log': None}", "(1, 2)", "{'log': b'x'}"]
    lines += ["{" + good + extra + "}" for extra in (',"a":None', ',"a":True', ',"a":(1, 2)', ',"a":0x1F', ",", ',"a":01', ',"a":1_000')]
    lines += ["{" + good + "} # comment", "{" + good.replace("[pid", "\\x5bpid") + "}", "{'a': true, " + good + "}", "{'a': null, " + good + "}"]
    got = {r.line_number: r.outcome for r in parse_lines(_frame(spark, lines)).collect()}
    for i, line in enumerate(lines):
        assert got[i + 1] == expected(line)[0], line


def test_quality_counts_invariant(spark):
    rng = random.Random(3)
    rows = [(f"f{i % 3}.log", i + 1, random_line(rng)) for i in range(300)]
    df = spark.createDataFrame(rows, "filename string, line_number int, line string")
    parsed = parse_lines(df)
    q = {r.filename: r for r in file_quality(parsed).collect()}
    by_file = {}
    for r in parsed.collect():
        by_file.setdefault(r.filename, []).append(r.outcome)
    for name, outs in by_file.items():
        assert q[name].file_line_count == len(outs)
        assert q[name].file_bad_lines == outs.count("bad")
        assert q[name].file_regex_failed == outs.count("regex_failed")
        assert outs.count("good") + outs.count("rejected") + q[name].file_bad_lines + q[name].file_regex_failed \
            == q[name].file_line_count
    samples = failure_samples(parsed).collect()
    assert len(samples) == sum(q[n].file_regex_failed for n in q)
    assert rejected_rows(parsed).count() == sum(o.count("rejected") for o in by_file.values())


def test_unicode_digits_follow_python_int(spark):
    arabic = str.maketrans("0123456789", "٠١٢٣٤٥٦٧٨٩")
    lines = [
        env(ACCESS.replace("[pid: 12|", "[pid: " + "12".translate(arabic) + "|") + "\n"),
        env(ACCESS.replace("user_id=5", "user_id=" + "57".translate(arabic)) + "\n"),
        env(ACCESS.replace("00:00:01 2019", "00:00:01 " + "2019".translate(arabic)) + "\n"),
        env(ACCESS.replace("1.2.3.4", "1.2.3." + "4".translate(arabic)) + "\n"),     # inet needs ASCII
    ]
    got = {r.line_number: r.asDict() for r in parse_lines(_frame(spark, lines)).collect()}
    for i, line in enumerate(lines):
        outcome, values = expected(line)
        assert got[i + 1]["outcome"] == outcome, line
        if outcome == "good":
            assert all(got[i + 1][k] == v for k, v in values.items()), (line, values)
    assert [got[k]["outcome"] for k in (1, 2, 3, 4)] == ["good", "good", "good", "rejected"]
    assert got[1]["pid"] == 12 and got[2]["user_id"] == 57


def test_long_forwarded_ip_lists_do_not_overflow(spark):
    lists = [", ".join(f"10.0.{i % 256}.{i % 200}" for i in range(n)) for n in (2000, 20000)]
    lists += ["1.2.3.45.6.7.8", "1.2.3.4.5.6.7", "1.2.3.4, ", "1.2.3.4,5.6.7.8", "1.2.3.4,  5.6.7.8", "1.2.3", ", 1.2.3.4", "1..2.3"]
    lines = [env(ACCESS.replace("1.2.3.4", x) + "\n") for x in lists]
    lines += [env(ACCESS.replace("user_id=5", "user_id=" + "1_" * 20000 + "1") + "\n"),
              env(ACCESS.replace("Test Agent", "A " * 500_000) + "\n")]
    got = {r.line_number: r for r in parse_lines(_frame(spark, lines)).collect()}
    for i, line in enumerate(lines):
        if i != len(lists):  # later Pythons refuse to convert this long an int
            assert got[i + 1].outcome == expected(line)[0], line[:200]
    assert got[1].ip == got[2].ip == "10.0.0.0"
    assert got[len(lists) + 1].outcome == "rejected"          # a valid int literal that does not fit INT
    assert got[len(lines)].outcome == "good" and len(got[len(lines)].user_agent) == 1_000_000


def test_lenient_fallback_follows_python_literals(spark):
    lines = [
        '{"log":"' + ACCESS + '\\n","n":NaN}',                          # NaN is not a Python literal
        '{"log":"' + ACCESS.replace("Test Agent", "Test\tAgent") + '\\n"}',  # raw tab inside a string
    ]
    got = {r.line_number: r.outcome for r in parse_lines(_frame(spark, lines)).collect()}
    assert [got[1], got[2]] == [expected(lines[0])[0], expected(lines[1])[0]] == ["bad", "good"]


def test_escaped_slashes_keep_their_backslash_as_in_python(spark):
    lines = [
        env(ACCESS.replace("/analytics/ping/", "\\\\/analytics\\\\/ping\\\\/") + "\n"),
        env(ACCESS.replace("https://x.example/bounty/7/", "https:\\\\/\\\\/x.example\\\\/bounty\\\\/7\\\\/") + "\n"),
        env(ACCESS.replace("Test Agent", "A\\\\\\\\/B \\\\\\\\\\\\/C") + "\n"),
    ]
    got = {r.line_number: r for r in parse_lines(_frame(spark, lines)).collect()}
    for i, line in enumerate(lines):
        outcome, values = expected(line)
        assert got[i + 1].outcome == outcome, line
        if outcome == "good":
            assert got[i + 1].referrer == values["referrer"] and got[i + 1].user_agent == values["user_agent"]
    assert [got[k].outcome for k in (1, 2, 3)] == ["regex_failed", "good", "good"]


@pytest.mark.parametrize("rule", ["both", "strict"])
def test_a_line_is_parsed_as_json_once(spark, rule):
    """Neither the Python pass nor the filters above copy the JSON parse of a line."""
    lines = spark.createDataFrame([("f", 1, "{}")], "filename string, line_number int, line string").repartition(2)
    plan = good_rows(parse_lines(lines, rule=rule))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parse_?json", plan, re.I)) == 1, plan


def test_address_lists_and_octets_on_both_ways(spark):
    """What the plain patterns decide agrees with the rule for the rest."""
    from pagetrail.functions import access, coerce

    cases = [("1.2.3.4", True, "1.2.3.4"), ("1.2.3.4, 5.6.7.8", True, None), ("1.2.3.4,", False, None), ("1.2.3.4, ", True, None), ("1.2.3.45.6.7.8", True, None),
             ("1.2.3.4.5.6.7", False, None), ("01.002.3.4", True, "1.2.3.4"), ("256.1.1.1", True, None), ("1.2.3", False, None), ("", False, None)]
    rows = spark.createDataFrame([(c[0],) for c in cases], "ip string").repartition(1)
    got = {r["ip"]: (r["listed"], r["inet"]) for r in rows.select("ip", access.is_ip_list(F.col("ip")).alias("listed"), coerce.inet_text(F.col("ip")).alias("inet")).collect()}
    assert {k: v[1] for k, v in got.items()} == {c[0]: c[2] for c in cases}
    model = re.compile(r"(?:\d+\.\d+\.\d+\.\d+(?:,\s)?)+")
    assert {k: bool(v[0]) for k, v in got.items()} == {c[0]: bool(model.fullmatch(c[0])) for c in cases}


def test_ascii_lines_are_matched_without_unicode_classes(spark):
    from pagetrail.functions import access, coerce, fixed, text

    rng = random.Random(7)
    seps = [" ", "\t", "\x1c", "\x0b", "\r", "\x1f"]
    logs = [ACCESS + "\n", ACCESS, ACCESS.replace("1.2.3.4", "1.2.3.4, 5.6.7.8,\t9.9.9.9") + "\n\nrest\x1c\n", "\n" + ACCESS + "\n"]
    for _ in range(200):
        log = list(rng.choice(logs))
        for i in rng.sample([i for i, ch in enumerate(log) if ch == " "], 2):
            log[i] = rng.choice(seps + ["_"])
        logs.append("".join(log))
    assert all(x.isascii() for x in logs)
    for py in (fixed.ACCESS_PATTERN_HOURLY, fixed.ACCESS_PATTERN_BACKFILL):
        pattern = access.AccessPattern(py)
        assert "(?dU)" not in pattern.ascii_regex and text.PY_SPACE not in pattern.ascii_regex
        rows = spark.createDataFrame([(x,) for x in logs], "log string")
        by = {r: F.regexp_replace(F.concat(F.lit("\n"), "log"), F.lit(r), F.lit(pattern.replacement)) for r in (pattern.regex, pattern.ascii_regex)}
        out = rows.select(*[c.alias(n) for n, c in zip("ua", by.values(), strict=True)], pattern.packed(F.col("log")).alias("p")).collect()
        assert any(r["p"].startswith("\x01") for r in out)
        assert all(r["u"] == r["a"] == r["p"] for r in out)
    cookies = ["a=1; b = 2 ;c=", " a =x=y;\tb\x1c= 3 ;b=4", "b=é; a", "=;;a==", ""]
    rows = spark.createDataFrame([(x,) for x in cookies], "cookies string").select("cookies", coerce.cookie_pairs(F.col("cookies")).alias("p"))
    for r in rows.collect():
        want = [(i.split("=")[0].strip(), i.split("=")[1].strip()) for i in r["cookies"].split(";") if "=" in i]
        assert [(p["k"], p["v"]) for p in r["p"]] == want


def test_only_the_lines_of_a_rewritten_day_are_parsed_again(spark, monkeypatch):
    from pagetrail.operators import parse
    from pagetrail.plans import registry

    days = [f"logs/2024/01/{d:02d}/{h:02d}/api-0.log" for d in (4, 5, 6) for h in (0, 23)]
    lines = spark.createDataFrame([(f, i + 1, line) for f in days for i, line in enumerate((GOOD, "", env("x\n")))],
                                  "filename string, line_number int, line string")
    monkeypatch.setattr(registry, "_lines", lambda spark, sf: lines)
    plain, seen = parse.parse_lines, []
    monkeypatch.setattr(parse, "parse_lines", lambda rows, *a, **k: (seen.append(rows.count()), plain(rows, *a, **k))[1])
    out = registry.q_files_processed_rewritten(spark, None).collect()
    assert sorted((r["filename"], r["file_line_count"], r["file_bad_lines"], r["file_regex_failed"]) for r in out) == [(f, 3, 1, 1) for f in days]
    failed = registry.q_failure_samples_rewritten(spark, None).collect()
    assert sorted((r["filename"], r["line_number"]) for r in failed) == [(f, 3) for f in days]
    assert registry.q_raw_log_rewritten(spark, None).count() == 6  # core 0 everywhere
    assert seen == [18, 6, 18, 6, 18, 6]
