"""Brute-force model of the line rules, used as the oracle in the parser tests.

It states the documented behaviour with the Python standard library (literal
evaluation, ``re``, ``strptime``) one line at a time; the Spark parser must
agree with it on every line the tests generate.
"""

from __future__ import annotations

import ast
import random
import re
from datetime import datetime

from pagetrail.functions.fixed import (ACCESS_PATTERN_BACKFILL, ACCESS_PATTERN_HOURLY, INT_FIELDS,
                                       NOT_FOUND_PREFIXES)

_PATTERNS = {"hourly": re.compile(ACCESS_PATTERN_HOURLY), "backfill": re.compile(ACCESS_PATTERN_BACKFILL)}
_UUID = re.compile(r"\{[0-9a-fA-F]{4}(-?[0-9a-fA-F]{4}){7}\}|[0-9a-fA-F]{4}(-?[0-9a-fA-F]{4}){7}")


class Bad(Exception):
    pass


def _log_of(line: str):
    try:
        value = ast.literal_eval(line)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        raise Bad
    if not isinstance(value, dict) or "log" not in value:
        raise Bad
    return value["log"]


def _cookies(text: str) -> dict:
    """Rules PRS6-8: ';'-separated items, each cut on '='; items 0 and 1 stripped,
    items without '=' ignored, the last duplicate wins, any non-int user_id is bad."""
    cut = [item.split("=") for item in text.split(";")]
    pairs = [(p[0].strip(), p[1].strip()) for p in cut if len(p) >= 2]
    try:
        ids = [int(v) for k, v in pairs if k == "user_id"]
    except ValueError:
        raise Bad
    found = dict(pairs)
    if ids:
        found["user_id"] = ids[-1]
    return found


def _inet(ip: str):
    parts = ip.split(".")
    if len(parts) != 4 or not all(p.isascii() and p.isdigit() and 1 <= len(p) <= 3 for p in parts):
        return None
    nums = [int(p) for p in parts]
    return ".".join(map(str, nums)) if all(n <= 255 for n in nums) else None


def _uuid(text):
    if text is None:
        return None, True
    if not _UUID.fullmatch(text):
        return None, False
    h = re.sub("[{}-]", "", text).lower()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", True


def expected(line: str, mode: str = "hourly"):
    """(outcome, values or None) for one raw line."""
    try:
        log = _log_of(line)
    except Bad:
        return "bad", None
    if isinstance(log, bytes):
        return "bad", None
    if not isinstance(log, str):
        return "regex_failed", None
    if log.startswith(NOT_FOUND_PREFIXES):
        return ("bad" if mode == "hourly" else "skipped"), None
    m = _PATTERNS[mode].match(log)
    if m is None:
        return "regex_failed", None
    g = m.groupdict()
    try:
        cookies = _cookies(g["cookies"])
        ts = datetime.strptime(g["time_received"], "%c")
        ints = {f: int(g[f]) for f in INT_FIELDS}
    except (Bad, ValueError):
        return "bad", None
    if mode == "hourly" and len(g["http_method"]) > 10:
        return "regex_failed", None
    ip = g["ip"].strip().split(",")[0] if mode == "hourly" else g["ip"]
    values = {k: v for k, v in ints.items() if k != "response_time"}
    uuid, uuid_ok = _uuid(cookies.get("uuid"))
    values.update(
        ip=_inet(ip), time_received=ts, http_method=g["http_method"], uri=g["uri"], referrer=g["referrer"],
        user_agent=g["user_agent"], has_wallet=g["has_wallet"] == "true",
        session_id=cookies.get("session_id"), user_id=cookies.get("user_id"), user_id_uuid=uuid,
        ga_ga=cookies.get("_ga"), ga_gid=cookies.get("_gid"),
    )
    storable = (values["ip"] is not None and uuid_ok
                and all(-2 ** 31 <= values[k] < 2 ** 31 for k in values if k in INT_FIELDS)
                and (values["user_id"] is None or -2 ** 31 <= values["user_id"] < 2 ** 31)
                and not any(isinstance(v, str) and "\x00" in v for v in values.values())
                and (mode == "hourly" or len(values["http_method"]) <= 10))
    return ("good" if storable else "rejected"), values


# ---------------------------------------------------------------------------
# a seeded generator of lines around the access format
# ---------------------------------------------------------------------------

def _access(rng: random.Random) -> str:
    pid = rng.choice(["12", "0", "", "4294967296", "31337", "007"])
    n_ips = rng.choice([1, 1, 1, 2, 3])
    ips = [".".join(str(rng.choice([0, 1, 10, 127, 255, 256, 300])) for _ in range(4)) for _ in range(n_ips)]
    ip = rng.choice([", ", ",  ", ","]).join(ips) if n_ips > 1 else ips[0]
    day = rng.choice(["21", "01", " 5", "5", "30", "31", "29"])
    month = rng.choice(["Jan", "Feb", "jan", "FEB", "Dec", "Foo"])
    clock = rng.choice(["00:00:01", "23:59:59", "1:2:3", "10:00:60", "24:00:00", "12:30:45"])
    year = rng.choice(["2019", "2024", "0000", "99999"])
    wday = rng.choice(["Mon", "Fri", "mon", "Monday"])
    sep = rng.choice([" ", " ", "  ", "\t"])
    when = sep.join([wday, month, day, clock, year])
    if rng.random() < 0.05:
        when = " " + when
    method = rng.choice(["GET", "POST", "get", "PROPFINDALL", "", "DELETE"])
    uri = rng.choice(["/analytics/ping/", "/a b/c", "/x]y", "/notification/1", "/" + "p" * 30])
    referrer = rng.choice(["-", "https://x.example/bounty/7/", "https://x.example/bounty/12/34", ""])
    agent = rng.choice(["Test Agent", "Mozilla/5.0 (X11; Linux)", "UA has wallet: false", "", "caf\u00e9"])
    wallet = rng.choice(["true", "false", "True", "", "true "])
    uuid = rng.choice(["a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", "A0EEBC999C0B4EF8BB6D6BB9BD380A11",
                       "{a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11}", "not-a-uuid", "", "a0eebc99-9c0b4ef8-bb6d6bb9-bd380a11"])
    user_id = rng.choice(["5", " 5 ", "+7", "1_000", "5x", "", "99999999999", "-3"])
    items = [f"session_id={rng.choice(['s1', 's1=x', ''])}", f"user_id={user_id}", f"uuid={uuid}",
             f"_ga={rng.choice(['G1', 'GA1.2.3'])}", "_gid=G2", "flag"]
    if rng.random() < 0.3:
        items.append(f"user_id={rng.choice(['9', 'x'])}")
    rng.shuffle(items)
    cookies = rng.choice(["; ", ";", " ; "]).join(items)
    resp_time = rng.choice(["45", "", "0"])
    tail = rng.choice(["\n", "\n", "\n", "", "\nextra", " \n"])
    return (f"[pid: {pid}|app: -|req: -/-] {ip} (-) {{48 vars in 800 bytes}} [{when}] {method} {uri} => "
            f"generated 123 bytes in {resp_time} msecs (HTTP/1.1 200) 5 headers in 200 bytes "
            f"(1 switches on core 0) referrer: {referrer} UA {agent} has wallet: {wallet} cookies: {cookies}{tail}")


def _json_str(s: str) -> str:
    out = []
    for ch in s:
        if ch == "\\":
            out.append("\\\\")
        elif ch == '"':
            out.append('\\"')
        elif ch == "\n":
            out.append("\\n")
        elif ch == "\t":
            out.append("\\t")
        elif ord(ch) > 126 and ord(ch) % 2:
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return '"' + "".join(out) + '"'


def random_line(rng: random.Random) -> str:
    r = rng.random()
    if r < 0.04:
        return rng.choice(["", "   ", "null", "[]", '"just text"', "42", "{}", "(1, 2)"])
    if r < 0.08:
        return rng.choice([
            '{"log": 5, "stream": "stderr"}', '{"log": ["a"]}', '{"log": {"a": "b"}}', '{"msg": "x"}',
            '{"log": "x", "stream": null}', '{"log": "x", "ok": true}', '{"log": "Not Found: /x\\n"}',
            '{"log": "WARNING:django.request:Not Found: /y\\n"}', '{"log": "x"} junk', '{"log": "x"}, {"log": "y"}',
        ])
    log = _access(rng)
    kind = rng.random()
    if kind < 0.1:
        # single-quoted Python dict
        body = log.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t")
        return "{'log': '" + body + "', 'stream': 'stderr'}"
    if kind < 0.15:
        return '{"log": "first", "log": ' + _json_str(log) + "}"
    return '{"log":' + _json_str(log) + ',"stream":"stderr"}'
