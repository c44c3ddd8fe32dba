"""AGG2, AGG5, INC3: who visited on which day, kept so that a day joins its past without moving it.

``visitor_state`` holds one row per visitor (uuid, user id) and day, partitioned by ``kind`` and
``ymd`` and bucketed by uuid: every day's files hold uuid bucket 0, 1, ... A scan of any set of
days has the same bucket of all of them in one task, so the latest visit per visitor and its
join with a day's visitors need no exchange on this side, and a (late, corrected, backdated)
day replaces its own partition and nothing else. Partitions of kind ``upto`` hold each
visitor's latest visit up to their day: a run starts from the newest one before its day
and adds the days since, so what is read does not grow with the years. Replacing a
day drops those it has made wrong.

Visitors without a uuid are not kept: the join on the uuid never finds them.
"""

from __future__ import annotations

import re
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import _file_system, _partitions, delete

TABLE, DAY, UPTO = "visitor_state", "day", "upto"
BUCKETS = 64


class VisitorState:
    """The table under ``warehouse``; ``buckets`` must stay as it was when the table was first written."""

    def __init__(self, spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets, self._entries = spark, f"{warehouse}/{TABLE}", buckets, []

    def _stored(self, kind: str) -> list[date]:
        found = _partitions(self.spark, self.root, [{f"kind={kind}"}, None])
        return sorted(date.fromisoformat(d.rsplit("ymd=", 1)[1]) for d in found)

    def _scan(self, parts: list[tuple[str, date]]) -> DataFrame:
        """The given partitions as one bucketed scan of (user_id_uuid, user_id, visited).

        Spark knows buckets by a catalog entry only; one of its own name is made over the folder
        (no row is copied or read for it).
        """
        table = f"pt_state_{uuid.uuid4().hex}"
        place = re.sub(r"(['\\])", r"\\\1", self.root)
        self.spark.sql(f"CREATE TABLE {table} (user_id_uuid STRING, user_id INT, visited DATE, kind STRING, ymd DATE) USING parquet "
                       f"PARTITIONED BY (kind, ymd) CLUSTERED BY (user_id_uuid) SORTED BY (user_id_uuid) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{place}'")
        self._entries.append(table)
        if parts:
            named = " ".join(f"PARTITION (kind = '{k}', ymd = DATE '{d}') LOCATION '{place}/kind={k}/ymd={d}'" for k, d in parts)
            self.spark.sql(f"ALTER TABLE {table} ADD {named}")
        return self.spark.table(table).select("user_id_uuid", "user_id", "visited")

    def _write(self, kind: str, days: list[date], rows: DataFrame) -> None:
        """Replace the partitions of the days by (user_id_uuid, user_id, visited, ymd) rows: one job, then renames."""
        rows = (rows.where(F.col("user_id_uuid").isNotNull()).select("user_id_uuid", "user_id", "visited", "ymd")
                .repartition(self.buckets, "user_id_uuid").sortWithinPartitions("ymd", "user_id_uuid"))
        entry, hidden = f"pt_state_{uuid.uuid4().hex}", f"{self.root}/_new-{uuid.uuid4().hex}"
        (rows.write.format("parquet").mode("overwrite").option("path", hidden).partitionBy("ymd")
         .bucketBy(self.buckets, "user_id_uuid").sortBy("user_id_uuid").saveAsTable(entry))
        self.spark.sql(f"DROP TABLE {entry}")  # an entry over a given folder: the files stay
        fs, at = _file_system(self.spark, self.root)
        Path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(Path(f"{self.root}/kind={kind}"))
        for day in days:
            target = f"{self.root}/kind={kind}/ymd={day}"
            delete(self.spark, target)
            if fs.exists(Path(f"{hidden}/ymd={day}")):
                fs.rename(Path(f"{hidden}/ymd={day}"), Path(target))
            else:
                fs.mkdirs(Path(target))  # a day without visitors is known, too
        delete(self.spark, hidden)

    def days(self) -> list[date]:
        return self._stored(DAY)

    def day(self, days: list[date]) -> DataFrame:
        """(user_id_uuid, user_id, visited) of the visitors of some days."""
        known = set(self.days())
        return self._scan([(DAY, d) for d in days if d in known])

    def drop_days(self, days: list[date]) -> None:
        """Forget days that have changed, and the sums over them."""
        for d in days:
            delete(self.spark, f"{self.root}/kind={DAY}/ymd={d}")
        for d in self._stored(UPTO):
            if days and d >= min(days):
                delete(self.spark, f"{self.root}/kind={UPTO}/ymd={d}")

    def put_days(self, days: list[date], visitors: DataFrame) -> None:
        """Replace the visitors (user_id_uuid, user_id, visited) of the days, which are all that ``visitors`` holds."""
        if days:
            self.drop_days(days)
            self._write(DAY, days, visitors.select("user_id_uuid", "user_id", "visited").distinct().withColumn("ymd", F.col("visited")))

    def put_upto(self, day: date) -> None:
        """Keep every visitor's latest visit up to ``day``, for later days to start from."""
        latest = self.visits(day).groupBy("user_id_uuid", "user_id").agg(F.max("visited").alias("visited"))
        self._write(UPTO, [day], latest.withColumn("ymd", F.lit(day)))

    def visits(self, through: date, since: date | None = None) -> DataFrame:
        """(user_id_uuid, user_id, visited) through a day: each visitor's latest visit at least, and with
        ``since`` every visit from that day on and each visitor's latest one before it."""
        before = since - timedelta(days=1) if since else through
        start = max((d for d in self._stored(UPTO) if d <= before), default=None)
        days = [(DAY, d) for d in self.days() if d <= through and (start is None or d > start)]
        return self._scan(days + ([(UPTO, start)] if start else []))

    def close(self) -> None:
        """Forget the catalog entries (no file is touched)."""
        for table in self._entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._entries = []
