"""PRS1-PRS15: classify and parse raw log lines, all JVM-side, no shuffle.

``parse_lines`` keeps every input row and adds ``outcome`` plus the 21 stored
columns. Outcomes follow the source pipeline's exception order (first rule
wins):

====  ==========================================  =============  ============
rule  condition                                   hourly         backfill
====  ==========================================  =============  ============
1-2   not one literal dict holding ``log``        bad            bad
3     ``log`` is not a string                     regex_failed   regex_failed
4     ``log`` starts with a "Not Found" prefix    bad            skipped
5     access pattern does not match               regex_failed   regex_failed
6     a cookie ``user_id`` is not an int          bad            bad
7     time is not ``%c``                          bad            bad
8     an int capture is empty                     bad            bad
9     HTTP method longer than 10                  regex_failed   rejected
10    otherwise                                   good           good
11    good, but a stored column cannot hold it    rejected       rejected
====  ==========================================  =============  ============

Rule 11 (bad inet / uuid, int out of range, NUL in text) made the source's whole
load fail; here such rows are routed to ``rejected_rows`` instead, and
``good_rows(..., strict=True)`` restores fail-the-run behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.access import AccessPattern, is_ip_list
from ..functions.envelope import with_envelope
from ..functions.fixed import (ACCESS_PATTERN_BACKFILL, ACCESS_PATTERN_HOURLY, BACKFILL, BAD,
                               COOKIE_COLUMNS, GOOD, HOURLY, INT_FIELDS, MAX_HTTP_METHOD_LEN,
                               NOT_FOUND_PREFIXES, RAW_COLUMNS, REGEX_FAILED, REJECTED, SKIPPED, UNDECIDED,
                               WALLET_TRUE)
from ..functions.text import has_nul

_PATTERNS = {HOURLY: AccessPattern(ACCESS_PATTERN_HOURLY), BACKFILL: AccessPattern(ACCESS_PATTERN_BACKFILL)}
_STORED_INTS = [f for f in INT_FIELDS if f != "response_time"]

_TEXT_COLUMNS = ("ip", "http_method", "uri", "referrer", "user_agent", "session_id",
                 "user_id_uuid", "ga_ga", "ga_gid")


def parse_lines(lines: DataFrame, mode: str = HOURLY, rule: str = "both") -> DataFrame:
    """Add ``outcome`` and the stored columns to rows that hold a ``line``; other columns are kept.

    ``mode`` is ``"hourly"`` or ``"backfill"``. ``rule="strict"`` stays native: lines that only
    Python's literal parser can decide come out as ``undecided``, for a second pass over just
    them with ``rule="literal"``.
    """
    if mode not in _PATTERNS:
        raise ValueError(f"mode must be {HOURLY!r} or {BACKFILL!r}")
    pattern = _PATTERNS[mode]
    keep = [c for c in lines.columns]

    env = with_envelope(lines, rule=rule)

    # one evaluation of the access pattern per line
    step1 = env.select(*keep, "undecided", "env_ok", "log_is_str",
                       F.coalesce(F.col("log").startswith(NOT_FOUND_PREFIXES[0])
                                  | F.col("log").startswith(NOT_FOUND_PREFIXES[1]),
                                  F.lit(False)).alias("not_found"),
                       pattern.packed(F.coalesce(F.col("log"), F.lit(""))).alias("_packed"))
    step2 = step1.select(*keep, "undecided", "env_ok", "log_is_str", "not_found",
                         AccessPattern.matched(F.col("_packed")).alias("matched"),
                         pattern.parts(F.col("_packed")).alias("_parts"))

    cap = {n: pattern.field(F.col("_parts"), n) for n in pattern.names}
    matched = F.col("matched")
    if pattern.ip_list:
        matched = matched & F.coalesce(is_ip_list(cap["ip"]), F.lit(False))
    # the captured address is stripped once; the cookies' items are looked up natively
    step3 = step2.select(
        *keep, "undecided", "env_ok", "log_is_str", "not_found", matched.alias("matched"),
        *[cap[n].alias("_c_" + n) for n in pattern.names],
        (coerce.first_forwarded_ip(cap["ip"]) if mode == HOURLY else cap["ip"]).alias("_ip_text"),
        coerce.cookie_pairs(cap["cookies"]).alias("_cookies"),
    )

    def c(name: str) -> Column:
        return F.col("_c_" + name)

    empty_int = F.lit(False)
    for n in INT_FIELDS:
        empty_int = empty_int | (c(n) == F.lit(""))
    cookie_cols = {col: coerce.cookie_value(F.col("_cookies"), key) for key, col in COOKIE_COLUMNS}
    typed = step3.select(
        *keep, "undecided", "env_ok", "log_is_str", "not_found", "matched",
        coerce.cookie_int_invalid(F.col("_cookies"), "user_id").alias("_bad_user_id"),
        empty_int.alias("_empty_int"),
        *[coerce.digits_value(c(n)).alias(n) for n in _STORED_INTS],
        coerce.inet_text(F.col("_ip_text")).alias("ip"),
        coerce.parse_ctime(c("time_received")).alias("time_received"),
        c("http_method").alias("http_method"),
        c("uri").alias("uri"),
        c("referrer").alias("referrer"),
        c("user_agent").alias("user_agent"),
        (c("has_wallet") == F.lit(WALLET_TRUE)).alias("has_wallet"),
        cookie_cols["session_id"].alias("session_id"),
        coerce.py_int_value(cookie_cols["user_id"]).alias("user_id"),
        cookie_cols["user_id"].alias("_user_id_text"),
        coerce.uuid_text(cookie_cols["user_id_uuid"]).alias("user_id_uuid"),
        cookie_cols["user_id_uuid"].alias("_uuid_text"),
        cookie_cols["ga_ga"].alias("ga_ga"),
        cookie_cols["ga_gid"].alias("ga_gid"),
    )

    long_method = F.length(F.col("http_method")) > MAX_HTTP_METHOD_LEN
    unstorable = (
        F.col("ip").isNull()
        | (F.col("user_id").isNull() & F.col("_user_id_text").isNotNull())
        | (F.col("user_id_uuid").isNull() & F.col("_uuid_text").isNotNull())
    )
    for n in _STORED_INTS:
        unstorable = unstorable | F.col(n).isNull()
    for n in _TEXT_COLUMNS:
        unstorable = unstorable | F.coalesce(has_nul(F.col(n)), F.lit(False))
    if mode == BACKFILL:
        unstorable = unstorable | long_method

    outcome = (
        F.when(F.col("undecided"), F.lit(UNDECIDED))
        .when(~F.col("env_ok"), F.lit(BAD))
        .when(~F.col("log_is_str"), F.lit(REGEX_FAILED))
        .when(F.col("not_found"), F.lit(BAD if mode == HOURLY else SKIPPED))
        .when(~F.col("matched"), F.lit(REGEX_FAILED))
        .when(F.col("_bad_user_id"), F.lit(BAD))
        .when(F.col("time_received").isNull(), F.lit(BAD))
        .when(F.col("_empty_int"), F.lit(BAD))
    )
    if mode == HOURLY:
        outcome = outcome.when(long_method, F.lit(REGEX_FAILED))
    outcome = outcome.when(unstorable, F.lit(REJECTED)).otherwise(F.lit(GOOD))

    return _fence(typed.select(*keep, outcome.alias("outcome"), *RAW_COLUMNS))


def _fence(df: DataFrame) -> DataFrame:
    """Pass rows through a one-row-per-row generator.

    Predicates above a projection are rewritten by the optimizer in terms of
    the projection's expressions and pushed below it. For the parse that would
    copy the access-pattern match (and everything derived from it) into every
    predicate on ``outcome`` or a parsed column, once per reference. A
    generator's output cannot be substituted, so filters stay above it and the
    pattern is evaluated once per line.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def good_rows(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """PRS15: rows to store, in table column order.

    ``strict=True`` raises when any parsed row cannot be stored, as the source
    pipeline's load did (this runs one extra, early-stopping job).
    """
    if strict:
        bad = parsed.filter(F.col("outcome") == REJECTED).select("filename", "line_number").limit(1).collect()
        if bad:
            raise ValueError(f"unstorable row at {bad[0]['filename']}:{bad[0]['line_number']}")
    return parsed.filter(F.col("outcome") == GOOD).select(*RAW_COLUMNS)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """Rows that parsed but would not fit the table (rule 11)."""
    return parsed.filter(F.col("outcome") == REJECTED).select("filename", "line_number", "line")
