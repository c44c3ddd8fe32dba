"""SRC5, FIL4-5, JOI1, AGG3: derive the page log from the raw log for a window.

The exclusion of blacklisted user agents is SQL ``NOT IN (subquery)``, whose
NULL rules differ from a plain anti join:

* a NULL anywhere in a non-empty list removes every row;
* a NULL probe (agent) is removed unless the list is empty;
* an empty list keeps everything, NULL agents included.

Spark plans ``NOT IN`` as a null-aware anti join that is always broadcast
(a hash join when small, a nested-loop join otherwise), so its cost grows with
the list with no fallback. Here it is spelt out instead: two uncorrelated
scalar subqueries (list size, NULLs in the list) are evaluated once as literals,
and the membership test is an ordinary equi anti join on the non-NULL agents,
for which the planner chooses broadcast only under its size threshold
(``spark.sql.autoBroadcastJoinThreshold``, checked again at run time by AQE) and
a shuffle sort-merge anti join beyond it.

For lists beyond broadcasting, ``large_list`` hashes the list to a bitmap of fixed size
(``FILTER_WORDS`` longs, 1 MB): rows whose value has no bit there are surely not listed
and stay where they are, only possible hits are shuffled to the anti join. The rows are
read once for either part, with the same pushed filters and columns. A list that fills
the bitmap sends more rows to the join; the result stays the same.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import NOTIFICATION_URI_PATTERN, PAGE_LOG_COLUMNS
from .windows import in_window


#: 64-bit words of the bitmap of a large list.
FILTER_WORDS = 1 << 17


def _maybe_listed(listed: DataFrame, column: str) -> Column:
    """False for values that are surely not in ``listed``'s column of that name, null for null values."""
    place = F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(64 * FILTER_WORDS))
    word, bit = F.floor(place / 64).cast("int").alias("word"), (place % 64).cast("int").alias("bit")
    empty = listed.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = listed.select(word, bit).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).unionByName(empty)
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bitmap = words.select(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"]).scalar()  # FILTER_WORDS longs
    return F.when(F.col(column).isNotNull(), F.getbit(F.get(bitmap, word), bit) == 1)


def not_in_list(rows: DataFrame, column: str, excluded: DataFrame, excluded_col: str | None = None, large_list: bool = False) -> DataFrame:
    """Rows whose ``column`` is ``NOT IN`` the ``excluded`` single-column list (SQL semantics)."""
    excluded_col = excluded_col or excluded.columns[0]
    values = excluded.select(F.col(excluded_col).alias("_v"))
    n_all = values.select(F.count(F.lit(1))).scalar()
    n_null = values.filter(F.col("_v").isNull()).select(F.count(F.lit(1))).scalar()
    listed = values.filter(F.col("_v").isNotNull()).withColumnRenamed("_v", column)
    members = listed.distinct()
    if large_list:
        maybe = _maybe_listed(listed, column)
        possible = rows.filter(maybe).join(members.hint("shuffle_merge"), on=column, how="left_anti").select(*rows.columns)
        kept = rows.filter(maybe.isNull() | ~maybe).unionByName(possible)
    else:
        kept = rows.join(members, on=column, how="left_anti")
    return kept.filter((n_all == 0) | (F.col(column).isNotNull() & (n_null == 0)))


def user_page_log(raw: DataFrame, blacklist: DataFrame, start: datetime, end: datetime, large_list: bool = False) -> DataFrame:
    """Page views in ``[start, end)``: no ``/notification/`` URIs, no blacklisted agents."""
    window_rows = raw.filter(in_window(F.col("time_received"), start, end))
    pages = window_rows.filter(~F.col("uri").rlike(NOTIFICATION_URI_PATTERN))
    return not_in_list(pages.select(*PAGE_LOG_COLUMNS), "user_agent", blacklist, "user_agent", large_list) \
        .select(*PAGE_LOG_COLUMNS)
