"""FIL4, FIL6-7, PRJ1: bounty views taken from ping requests' referrers.

Map-only: scan with the pushed time range, two row filters, one projection.
The bounty id is the leftmost ``/bounty/<digits>`` of the referrer, cast with
ANSI semantics, so an id beyond the INT range fails the job exactly as the
source's ``::int`` failed its statement.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import BOUNTY_ID_PATTERN, BOUNTY_REFERRER_PATTERN, PING_URI, VIEW_LOG_COLUMNS
from .windows import in_window


def bounty_views(page_log: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    rows = page_log
    if start is not None:
        rows = rows.filter(in_window(F.col("time_received"), start, end))
    rows = rows.filter((F.col("uri") == PING_URI) & F.col("referrer").rlike(BOUNTY_REFERRER_PATTERN))
    bounty_id = F.regexp_extract(F.col("referrer"), BOUNTY_ID_PATTERN, 1).cast("int").alias("bounty_id")
    return rows.select(*[bounty_id if c == "bounty_id" else F.col(c) for c in VIEW_LOG_COLUMNS])
