"""SRC9, INC1: newly arrived log files into the raw log, exactly once.

The source waited for ``*.log`` keys under the hour's prefix and then parsed
them. Here a Structured Streaming file source discovers new files (it keeps a
log of files already seen in the checkpoint), ``Trigger.AvailableNow`` processes
everything present and stops. Each micro-batch is a *load* of the warehouse's own tables
(``raw_logs``, ``rejected_lines``, ``raw_regex_failure_lines``, ``files_processed``):

1. its text is read once, parsed and staged (:mod:`pagetrail.plans.staging`); files that the
   batch job of their hour has loaded meanwhile are left out;
2. the event hours it touches go to the change feed;
3. its rows replace exactly the partitions of the same load, so a micro-batch that is
   replayed after a failure overwrites its own partial output;
4. the load is committed: its files and their ingest hours are published in one rename.

Readers take a load only once it is committed, and a micro-batch replayed after its commit
(the stream's own checkpoint was lost or late) finds it and does nothing. A file stream never
delivers files without bytes or with only a byte-order mark; after the stream has caught up, those
not yet in the commit log are a load of their own (one bad line each, no rows).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import HOURLY
from ..plans.staging import ParsedFiles
from ..sinks import commits, tables
from ..sources.logfiles import SOURCE_LAYOUT, _normal_path, all_files, empty_files, path_hour, placed_lines, split_columns


def load_parsed(spark: SparkSession, parsed: ParsedFiles, warehouse: str, load: str, layout: str = SOURCE_LAYOUT) -> None:
    """Write the parsed files as load ``load`` and commit it; repeating it gives the same tables."""
    processed = tables.read_known(spark, f"{warehouse}/files_processed", "filename STRING, ingest_date DATE, ingest_hour INT, load STRING")
    parsed.without(processed.where(F.col("load") == tables.BATCH_LOAD))
    files = parsed.files(layout)
    hours = [r["ingest_hour"] for r in files.select("ingest_hour").distinct().collect()]  # one per hour, not per file
    if None in hours:
        raise ValueError(f"a file lies outside the layout {layout}")
    filed = lambda df: df.withColumn("_ingest_hour", path_hour(F.col("filename"), layout))
    good = filed(parsed.good(with_file=True)).drop("filename")
    touched = commits.event_hours(good)
    commits.record_change(touched, warehouse, f"{load}-intent")
    tables.write_raw_hours(good, f"{warehouse}/raw_logs", hours, "_ingest_hour", load)
    for rows, name in ((parsed.rejected(), "rejected_lines"), (parsed.samples(), "raw_regex_failure_lines"),
                       (parsed.quality(), "files_processed")):
        tables.write_loads(filed(rows), f"{warehouse}/{name}", hours, "_ingest_hour", load)
    commits.commit(files, warehouse, load)
    commits.record_change(touched, warehouse, load)


def ingest_available(spark: SparkSession, root: str, warehouse: str, checkpoint: str, layout: str = SOURCE_LAYOUT,
                     glob: str | None = None, mode: str = HOURLY, max_files_per_trigger: int | None = None) -> None:
    """Load every not-yet-seen file under ``root`` into the warehouse's raw log and quality tables.

    ``checkpoint`` is the stream's own folder: it holds what has been seen, and names the stream's loads.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder of its own")
    if glob is None:
        glob = "*.log" if layout == SOURCE_LAYOUT else "*.txt"
    reader = (spark.readStream.format("text").option("lineSep", "\n")
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def stream_name() -> str:
        about = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])
        return about["id"].replace("-", "")[:12]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream_name()}-{batch_id:012d}"
        if commits.is_committed(spark, warehouse, load):
            return
        parsed = ParsedFiles(spark, placed_lines(batch), spark.createDataFrame([], "filename string"), mode)
        load_parsed(spark, parsed, warehouse, load, layout)
        parsed.drop()

    query = (split_columns(reader.load(root)).writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    _load_empty(spark, root, warehouse, stream_name(), layout, glob, mode)


def _load_empty(spark: SparkSession, root: str, warehouse: str, stream: str, layout: str, glob: str, mode: str) -> None:
    """The files without lines that no load has brought, as one more load after the stream's last."""
    known = commits.committed_files(spark, warehouse).select("filename")
    # as a rule every file listed has been loaded, and none need be opened to learn which are empty
    path = lambda files: files.select(_normal_path(F.col("filename")).alias("filename"))
    if not path(all_files(spark, root, glob)).join(path(known), "filename", "left_anti").limit(1).count():
        return
    new = empty_files(spark, root, layout, glob).join(known, "filename", "left_anti")
    if not new.limit(1).count():
        return
    last = commits.last_loads(spark, warehouse).get(stream, f"{stream}-{0:012d}")
    number, _, empty = last.split("-")[1].partition("e")
    nothing = spark.createDataFrame([], "filename string, split bigint, seq bigint, size bigint, line string")
    parsed = ParsedFiles(spark, nothing, new, mode)
    load_parsed(spark, parsed, warehouse, f"{stream}-{number}e{int(empty or 0) + 1:06d}", layout)
    parsed.drop()
