"""INC1, INC6: which loads of the raw log are whole, and which event hours they touched.

* ``raw_commits/load=L`` lists the files (with their ingest hours) that load ``L`` of the
  stream brought. It is written beside and renamed into place after all of the load's rows,
  so a load is whole exactly if its folder exists. A stream's loads are numbered in order and
  written one after another, so what is committed is all up to its last one.
* ``raw_changes/change=C`` holds the event hours whose raw rows change ``C`` brought, replaced
  or removed. It is renamed into place before the rows are written and once more after, so a
  consumer never misses an hour: the first covers a run that dies in between.
* ``derived_changes/consumer=N/mark=M`` holds the changes that consumer ``N`` has worked off;
  those not listed there are its feed. (A stored time as high-water mark would lose changes
  of writers whose clocks differ; a list of names does not.)
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import truncate_hour
from .tables import BATCH_LOAD, _file_system, delete, exists, read_known

COMMITS, CHANGES, DERIVED = "raw_commits", "raw_changes", "derived_changes"


def _publish(rows: DataFrame, folder: str, name: str) -> None:
    """Write ``rows`` as one file under ``folder/name``, visible at once when complete; a repeat replaces it."""
    spark = rows.sparkSession
    hidden = f"{folder}/_{name}-{uuid.uuid4().hex}"
    rows.repartition(1).write.parquet(hidden)
    delete(spark, f"{folder}/{name}")
    fs, at = _file_system(spark, hidden)
    if not fs.rename(at, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
        raise OSError(f"could not publish {folder}/{name}")


def _names(spark: SparkSession, folder: str, key: str) -> list[str]:
    fs, at = _file_system(spark, folder)
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{key}="))


def commit(files: DataFrame, warehouse: str, load: str) -> None:
    """Make load ``load`` visible; ``files`` is (filename, ingest_hour)."""
    _publish(files.select("filename", "ingest_hour"), f"{warehouse}/{COMMITS}", f"load={load}")


def is_committed(spark: SparkSession, warehouse: str, load: str) -> bool:
    return exists(spark, f"{warehouse}/{COMMITS}/load={load}")


def committed_files(spark: SparkSession, warehouse: str) -> DataFrame:
    """(filename, ingest_hour, load) of every committed load."""
    return read_known(spark, f"{warehouse}/{COMMITS}", "filename STRING, ingest_hour TIMESTAMP_NTZ, load STRING")


def last_loads(spark: SparkSession, warehouse: str) -> dict[str, str]:
    """The last committed load of every stream, from the folders' names."""
    out: dict[str, str] = {}
    for load in _names(spark, f"{warehouse}/{COMMITS}", "load"):
        out[load.split("-")[0]] = load
    return out


def committed(spark: SparkSession, warehouse: str) -> Column:
    """Predicate on the partition column ``load``: the batch load, and each stream up to its last commit."""
    load = F.col("load")
    known = load == F.lit(BATCH_LOAD)
    for stream, last in last_loads(spark, warehouse).items():
        known = known | (load.startswith(f"{stream}-") & (load <= F.lit(last)))
    return known


# ---------------------------------------------------------------------------
# change feed


def event_hours(rows: DataFrame) -> DataFrame:
    """(event_hour) of rows with a ``time_received``: a row per hour."""
    return rows.select(truncate_hour(F.col("time_received")).alias("event_hour")).distinct()


def record_change(hours: DataFrame, warehouse: str, name: str) -> None:
    """Publish the event hours of a change under a name of its own."""
    _publish(hours.select("event_hour").distinct(), f"{warehouse}/{CHANGES}", f"change={re.sub(r'[^A-Za-z0-9-]', '-', name)}-{uuid.uuid4().hex[:8]}")


def pending(spark: SparkSession, warehouse: str, consumer: str) -> list[str]:
    """Names of the changes the consumer has not worked off."""
    done: set[str] = set()
    folder = f"{warehouse}/{DERIVED}/consumer={consumer}"
    if _names(spark, folder, "mark"):
        marks = read_known(spark, folder, "change STRING, mark STRING")
        done = {r["change"] for r in marks.select("change").distinct().collect()}  # a name per load
    return [n for n in _names(spark, f"{warehouse}/{CHANGES}", "change") if n not in done]


def changed_hours(spark: SparkSession, warehouse: str, changes: list[str]) -> list:
    """The event hours that the changes touched, in order (an hour each, whatever the rows)."""
    if not changes:
        return []
    rows = read_known(spark, f"{warehouse}/{CHANGES}", "event_hour TIMESTAMP_NTZ, change STRING")
    hours = rows.where(F.col("change").isin(changes)).select("event_hour").distinct()
    return sorted(r["event_hour"] for r in hours.collect())


def mark_done(spark: SparkSession, warehouse: str, consumer: str, changes: list[str]) -> None:
    """Note that the consumer's outputs contain the changes (after they are written)."""
    rows = spark.createDataFrame([(c,) for c in changes], "change string")
    _publish(rows, f"{warehouse}/{DERIVED}/consumer={consumer}", f"mark={uuid.uuid4().hex}")
