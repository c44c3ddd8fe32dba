"""AGG1, AGG2, AGG5, JOI2, PRJ3-5: daily visitors and their previous visit.

For day ``d``:

* ``daily_pageviews``  - page views of ``d`` grouped by (uuid, user_id): count
  and "any view with a wallet";
* ``last_past_visit``  - latest visit date per (uuid, user_id) on or before
  ``d - 1``. The source's run of execution date ``E`` stamps ``d = E - 1`` and
  takes visits up to and including ``E - 2``, the day before ``d``;
* ``visitor_previous_visit`` - the first left-joined to the second on the uuid
  alone (a uuid seen with several user ids multiplies rows; a NULL uuid never
  matches), with a sentinel date for "never".

Both aggregates are partial/final hash aggregates: each map task collapses its
rows per key before the shuffle, so a hot key (e.g. a NULL uuid holding a third
of all views) costs one row per task, not one per view. Before the join, rows
without a uuid get a key of their own each (they match nothing and so meet nowhere),
and uuids that hold many of the day's rows, found by a top-k sketch, are joined
apart, salted by user id, so none gathers in one task.

``history`` is a table of visit days (user_id_uuid, user_id, ymd) that replaces the scan
of all earlier page views: one row per visitor and day, or fewer. Taken from
:class:`pagetrail.sinks.visitor_state.VisitorState` it is bucketed by uuid, and neither
its aggregate nor the join moves it.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import NEVER_VISITED


def _day_of(ts_col: str = "time_received"):
    return F.to_date(F.col(ts_col))


# Partition column of an event-partitioned page log (always the date of time_received).
PARTITION_DATE = "event_date"


def _on_day(page_log: DataFrame, cond_on_date) -> DataFrame:
    """Filter by a condition on the event date; also on the partition column when present (pruning)."""
    out = page_log.filter(cond_on_date(_day_of()))
    if PARTITION_DATE in page_log.columns:
        out = out.filter(cond_on_date(F.col(PARTITION_DATE)))
    return out


def daily_pageviews(page_log: DataFrame, day: date) -> DataFrame:
    """AGG1: (user_id_uuid, user_id, has_wallet, pageviews) for one day."""
    return (_on_day(page_log, lambda d: d == F.lit(day))
            .groupBy("user_id_uuid", "user_id")
            .agg(F.bool_or(F.col("has_wallet")).alias("has_wallet"),
                 F.count(F.lit(1)).alias("pageviews")))


def last_past_visit(page_log: DataFrame, day: date, history: DataFrame | None = None) -> DataFrame:
    """AGG2: (user_id_uuid, user_id, ymd) latest visit date on or before ``day - 1``.

    ``history`` may be a table of (user_id_uuid, user_id, ymd) visit days, e.g.
    earlier outputs of :func:`visitor_previous_visit`; it then replaces the raw scan.
    """
    cutoff = day - timedelta(days=1)
    if history is not None:
        visits = history.select("user_id_uuid", "user_id", F.col("ymd").alias("_d"))
    else:
        visits = _on_day(page_log, lambda d: d <= F.lit(cutoff)).select("user_id_uuid", "user_id",
                                                                      _day_of().alias("_d"))
    return (visits.filter(F.col("_d") <= F.lit(cutoff))
            .groupBy("user_id_uuid", "user_id")
            .agg(F.max("_d").alias("ymd")))


#: A uuid with this share of a day's (uuid, user id) rows or more is joined apart.
HOT_SHARE = 0.02
#: Tasks over which the rows of such a uuid are spread.
SALTS = 16


def hot_uuids(daily: DataFrame) -> list[str]:
    """The uuids that hold ``HOT_SHARE`` of the rows or more: fifty at most.

    The top-k sketch is a small partial aggregate, so no row moves to find them. A uuid named by its error
    only takes the longer way; the result is the same.
    """
    keys = daily.where(F.col("user_id_uuid").isNotNull()).select("user_id_uuid")
    found = keys.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(user_id_uuid, {int(2 / HOT_SHARE)}, 10000)").alias("top")).first()
    if not found["n"]:
        return []
    return sorted(t["item"] for t in found["top"] if t["count"] >= max(2, HOT_SHARE * found["n"]))


def _joined(daily: DataFrame, past: DataFrame, join_keys, extra=None) -> DataFrame:
    """``daily`` left-joined to ``past`` (``_p_`` keys) on the keys; a uuid-less row has a key that nothing matches."""
    alone = F.concat(F.lit("\0"), F.coalesce(F.col("user_id").cast("string"), F.lit("")))
    left = daily.withColumn("_key", F.coalesce("user_id_uuid", alone))
    cond = F.col("_key") == F.col("_p_user_id_uuid")
    for k in join_keys:
        if k != "user_id_uuid":
            cond = cond & (F.col(k) == F.col("_p_" + k))
    return left.join(past, on=cond if extra is None else cond & extra, how="left")


def _with_past(daily: DataFrame, past: DataFrame, join_keys, extra=None) -> DataFrame:
    """:func:`_joined`, the hot uuids apart and salted by user id."""
    hot = hot_uuids(daily)
    if not hot:
        return _joined(daily, past, join_keys, extra)
    is_hot = F.coalesce(F.col("user_id_uuid").isin(hot), F.lit(False))
    cold = _joined(daily.where(~is_hot), past.where(~F.col("_p_user_id_uuid").isin(hot)), join_keys, extra)
    salted = past.where(F.col("_p_user_id_uuid").isin(hot)).withColumn("_p_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("user_id"), F.lit(SALTS)).cast("int")
    apart = F.col("_salt") == F.col("_p_salt")
    warm = _joined(daily.where(is_hot).withColumn("_salt", salt), salted, join_keys, apart if extra is None else apart & extra)
    return cold.unionByName(warm.drop("_salt", "_p_salt"))


def _past_keys(past: DataFrame, join_keys, *more) -> DataFrame:
    keys = list(dict.fromkeys(("user_id_uuid", *join_keys)))
    return past.select(*[F.col(k).alias("_p_" + k) for k in keys], *more)


def visitor_previous_visit(page_log: DataFrame, day: date, join_keys=("user_id_uuid",),
                           history: DataFrame | None = None) -> DataFrame:
    """AGG5: (user_id_uuid, user_id, ymd, has_wallet, pageviews, last_visit) for ``day``.

    ``join_keys=("user_id_uuid", "user_id")`` gives the strict form without the
    row multiplication of the source's uuid-only join.
    """
    daily = daily_pageviews(page_log, day)
    # the history is aggregated before it meets the day: a partial aggregate stands below every
    # exchange of page views, and the join then sees one row per visitor
    past = last_past_visit(page_log, day, history).where(F.col("user_id_uuid").isNotNull())
    joined = _with_past(daily, _past_keys(past, join_keys, F.col("ymd").alias("_past")), join_keys)
    return joined.select(
        "user_id_uuid", "user_id", F.lit(day).alias("ymd"), "has_wallet", "pageviews",
        F.coalesce(F.col("_past"), F.lit(NEVER_VISITED).cast("date")).alias("last_visit"),
    )


def visitor_previous_visits(page_log: DataFrame, days: list[date], join_keys=("user_id_uuid",),
                            history: DataFrame | None = None) -> DataFrame:
    """:func:`visitor_previous_visit` of several days in one pass over the page log and its history.

    The past is one row per visitor, with the visit days that the days can ask for: the latest before all
    of them, and those between. Each day picks its own after the join, in which a visitor counts from the
    day after the first of them (so several days multiply neither the history nor the join).
    """
    wanted = sorted(set(days))
    daily = (_on_day(page_log, lambda d: d.isin([F.lit(x) for x in wanted]))
             .groupBy("user_id_uuid", "user_id", _day_of().alias("ymd"))
             .agg(F.bool_or(F.col("has_wallet")).alias("has_wallet"), F.count(F.lit(1)).alias("pageviews")))
    last, first = wanted[-1] - timedelta(days=1), wanted[0] - timedelta(days=1)
    if history is not None:
        visits = history.select("user_id_uuid", "user_id", F.col("ymd").alias("_d")).filter(F.col("_d") <= F.lit(last))
    else:
        visits = _on_day(page_log, lambda d: d <= F.lit(last)).select("user_id_uuid", "user_id", _day_of().alias("_d"))
    own = (visits.where(F.col("user_id_uuid").isNotNull()).groupBy("user_id_uuid", "user_id")
           .agg(F.max(F.when(F.col("_d") <= F.lit(first), F.col("_d"))).alias("_before"),
                F.collect_set(F.when(F.col("_d") > F.lit(first), F.col("_d"))).alias("_between")))  # a day of the run each
    seen = F.array_compact(F.concat(F.array("_before"), "_between"))
    past = _past_keys(own, join_keys, seen.alias("_seen"), F.array_min(seen).alias("_from"))
    joined = _with_past(daily, past, join_keys, F.col("_from") < F.col("ymd"))
    return joined.select(
        "user_id_uuid", "user_id", "ymd", "has_wallet", "pageviews",
        F.coalesce(F.array_max(F.filter("_seen", lambda d: d < F.col("ymd"))), F.lit(NEVER_VISITED).cast("date")).alias("last_visit"),
    )
