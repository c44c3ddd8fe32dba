"""SRC1-4: read time-partitioned log files as (filename, line_number, line).

Layout: ``root/<hour path>/*.log`` with the hour path ``YYYY/MM/DD/HH`` by
default. The result follows the source pipeline's ``text.split("\\n")``: lines
are numbered from 1 per file, and a file that ends with a newline (or is
empty) has one more, empty, last line.

Spark's line reader with ``lineSep="\\n"`` reads every file in splits of
``maxPartitionBytes``, whatever its size, so a file holding a third of all lines
is spread over many tasks. A line's number is the number of lines in earlier
splits of its file plus its position in its own split; per-split counts are a
small aggregate (one row per split) joined back to the lines. Whether a file ends
with a newline follows from its size: the bytes of its lines plus one separator
each equal the file size exactly then.

File scans skip zero-length files; those are found from the scan's file listing
and contribute their single empty line. A file of nothing but a byte-order mark
has no line for the reader; it contributes that mark as its single line.

Strict UTF-8 (SRC4): undecodable bytes fail the run, as they did in the source
(a file is valid exactly when each of its lines is, since ``\\n`` is never part of
another character); ``strict_utf8=False`` keeps such lines as they are.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Directory layouts, filled with strftime-style fields of the hour.
SOURCE_LAYOUT = "{Y}/{m}/{d}/{H}"
# what ``write_log_files`` produces (Spark's partition-directory naming)
SPARK_LAYOUT = "hour={Y}-{m}-{d}-{H}"


def _hour_dir(layout: str, ts: datetime | date, hour: bool) -> str:
    fields = {"Y": f"{ts.year:04d}", "m": f"{ts.month:02d}", "d": f"{ts.day:02d}",
              "H": f"{ts.hour:02d}" if hour and isinstance(ts, datetime) else "*"}
    return layout.format(**fields)  # a day reads every hour under it via the "*" glob


def read_log_lines(spark: SparkSession, root: str, hour: datetime | None = None, day: date | None = None,
                   layout: str = SOURCE_LAYOUT, glob: str | None = None, strict_utf8: bool = True) -> DataFrame:
    """(filename, line_number, line) for every line of the files of one hour, one day, or all.

    ``glob`` filters file names (default ``*.log`` for the source layout,
    ``*.txt`` for files written by :func:`write_log_files`).
    """
    if glob is None:
        glob = "*.log" if layout == SOURCE_LAYOUT else "*.txt"
    if hour is not None:
        path = f"{root}/{_hour_dir(layout, hour, True)}"
    elif day is not None:
        path = f"{root}/{_hour_dir(layout, day, False)}"
    else:
        path = root
    try:
        listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                   .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        # no folder for this hour or day: no files, no lines
        return spark.createDataFrame([], "filename string, line_number int, line string")
    text = (spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path))
    lines, seen = number_split_lines(split_columns(text))
    if strict_utf8:
        lines = lines.withColumn("line", F.when(F.is_valid_utf8(F.col("line")), F.col("line"))
                                 .otherwise(F.raise_error(F.concat(F.lit("invalid UTF-8 in "), F.col("filename")))))
    marks = (listing.select(_normal_path(F.col("path")).alias("_file"))
             .join(seen.select(_normal_path(F.col("filename")).alias("_file")), "_file", "left_anti")
             .select(F.col("_file").alias("filename"), F.lit(1).alias("line_number"), F.lit("\ufeff").alias("line")))
    return lines.unionByName(marks).unionByName(_empty_files(spark, text, listing))


def scan_log_lines(spark: SparkSession, root: str, hour: datetime | None = None, day: date | None = None,
                   layout: str = SOURCE_LAYOUT, glob: str | None = None,
                   strict_utf8: bool = True) -> tuple[DataFrame, DataFrame] | None:
    """One map-only scan: ((filename, split, seq, size, line), (filename) of every file listed); None without a folder.

    A line's place is its split and ``seq``, whose order within the split is the lines' order: absolute
    numbers follow from the splits' line counts (:mod:`pagetrail.plans.staging`). Zero-length files and
    files of only a byte-order mark are listed but have no row.
    """
    if glob is None:
        glob = "*.log" if layout == SOURCE_LAYOUT else "*.txt"
    path = root if hour is None and day is None else f"{root}/{_hour_dir(layout, hour or day, hour is not None)}"
    try:
        text = (spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", glob)
                .option("recursiveFileLookup", "true").load(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return placed_lines(split_columns(text), strict_utf8), listed_files(spark, text)


def placed_lines(rows: DataFrame, strict_utf8: bool = True) -> DataFrame:
    """(filename, split, seq, size, line) of :func:`split_columns` rows (of a scan or a micro-batch)."""
    rows = rows.select("filename", F.col("_split").alias("split"), F.monotonically_increasing_id().alias("seq"),
                                      F.col("_size").alias("size"), "line")
    if not strict_utf8:
        return rows
    return rows.withColumn("line", F.when(F.is_valid_utf8(F.col("line")), F.col("line"))
                           .otherwise(F.raise_error(F.concat(F.lit("invalid UTF-8 in "), F.col("filename")))))


def listed_files(spark: SparkSession, text: DataFrame) -> DataFrame:
    """(filename) of every file a file scan listed, also those without bytes, which it does not read.

    Spark's own file index holds these names on the driver already; they go back as one small table.
    """
    return (spark.createDataFrame([(p,) for p in text.inputFiles()], "filename string")
            .select(_plain_path(F.col("filename")).alias("filename")))


def path_hour(filename, layout: str = SOURCE_LAYOUT):
    """TIMESTAMP_NTZ of the hour a file is filed under, read from its path by ``layout``."""
    pattern = (layout.replace("{Y}", r"(\d{4})").replace("{m}", r"(\d{2})").replace("{d}", r"(\d{2})")
               .replace("{H}", r"(\d{2})")) + "/"
    parts = [F.regexp_extract(filename, pattern, i).cast("int") for i in range(1, 5)]
    return F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0))


def _normal_path(col):
    return F.regexp_replace(col, "^file:///", "file:/")


def _plain_path(col):
    """A file path as it is on disk, from the URI form in which scans give it (``%20`` for a space)."""
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def _empty_files(spark: SparkSession, text: DataFrame, listing: DataFrame) -> DataFrame:
    """One empty line 1 for each zero-length file.

    File scans skip zero-length files, so they are the files of the scan's
    listing (names only, as planned by Spark) that a metadata-only scan of the
    same path does not return.
    """
    listed = spark.createDataFrame([(p,) for p in text.inputFiles()], "filename string") \
        .select(_normal_path(_plain_path(F.col("filename"))).alias("filename"))
    nonempty = listing.select(_normal_path(F.col("path")).alias("filename"))
    return (listed.join(nonempty, "filename", "left_anti")
            .select("filename", F.lit(1).alias("line_number"), F.lit("").alias("line")))


def split_columns(text: DataFrame) -> DataFrame:
    """(filename, _split, _size, line) of a line-reader scan, from its file metadata."""
    return text.select(
        _plain_path(F.col("_metadata.file_path")).alias("filename"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("value").alias("line"),
    )


def number_split_lines(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number (filename, _split, _size, line) rows as whole-file ``split("\\n")`` would.

    Returns (numbered lines incl. the empty tail piece, names of the files seen).
    """
    # rows of one split are read in order by one task: their ids are consecutive
    rows = rows.select("filename", "_split", "_size", F.monotonically_increasing_id().alias("_seq"), "line")
    per_split = rows.groupBy("filename", "_split").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_seq").alias("_first"),
        F.sum(F.octet_length("line") + 1).alias("_bytes"),
        F.max("_size").alias("_size"),
    )
    in_file = Window.partitionBy("filename")
    earlier = in_file.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = per_split.select(
        "filename", "_split", "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(in_file).alias("_lines"),
        F.sum("_bytes").over(in_file).alias("_file_bytes"),
        "_size",
    )
    # The line reader drops a UTF-8 byte-order mark (3 bytes) at the start of a
    # file, which Python's decode keeps. Lines plus one separator each add up to
    # the file size when it ends with "\n" (one more byte when it does not);
    # 3 bytes less in either case reveal a dropped mark, which is put back.
    bom = F.col("_file_bytes") - F.col("_size")
    splits = splits.withColumn("_bom", bom.isin(-3, -2)).withColumn("_ends_nl", bom.isin(0, -3))
    numbered = (rows.join(splits.select("filename", "_split", "_first", "_before", "_bom"), ["filename", "_split"])
                .select("filename",
                        (F.col("_before") + F.col("_seq") - F.col("_first") + 1).cast("int").alias("line_number"),
                        "line", "_bom"))
    numbered = numbered.select(
        "filename", "line_number",
        F.when(F.col("_bom") & (F.col("line_number") == 1), F.concat(F.lit("\ufeff"), F.col("line")))
        .otherwise(F.col("line")).alias("line"))
    tails = (splits.filter((F.col("_split") == 0) & F.col("_ends_nl"))
             .select("filename", (F.col("_lines") + 1).cast("int").alias("line_number"), F.lit("").alias("line")))
    return numbered.unionByName(tails), splits.filter(F.col("_split") == 0).select("filename")


def all_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(filename) of every file under ``root``, also those without bytes: one listing, no file is opened."""
    return listed_files(spark, spark.read.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root))


def empty_files(spark: SparkSession, root: str, layout: str = SOURCE_LAYOUT, glob: str | None = None) -> DataFrame:
    """(filename) of the files without a line under ``root``: of no bytes, or of only a byte-order mark."""
    if glob is None:
        glob = "*.log" if layout == SOURCE_LAYOUT else "*.txt"
    read = lambda form: (spark.read.format(form).option("pathGlobFilter", glob)
                         .option("recursiveFileLookup", "true").load(root))
    listed = listed_files(spark, read("text")).withColumn("_file", _normal_path(F.col("filename")))
    found = read("binaryFile")
    with_bytes = found.select(_normal_path(F.col("path")).alias("_file"))
    only_mark = (found.where("length = 3").where(F.col("content") == F.expr("X'EFBBBF'"))
                 .select(_normal_path(F.col("path")).alias("_file")))
    none = listed.join(with_bytes, "_file", "left_anti")
    return none.unionByName(listed.join(only_mark, "_file", "left_semi")).select("filename")


def write_log_files(spark: SparkSession, lines: DataFrame, root: str | None = None, mode: str = "overwrite") -> str:
    """Write (filename, line_number, line) rows as one text file per ``filename``.

    Files go under ``root`` (default: a fresh folder in the shared checkpoint
    folder) in :data:`SPARK_LAYOUT`, grouped by the hour in the file name
    ``logs/YYYY/MM/DD/HH/<name>.log``. A file's lines are gathered in one row;
    this is bounded because a log file is (a few MB of lines). The text writer
    ends every file with a newline, so each file reads back with one extra,
    empty last line. ``mode="append"`` adds files beside those already there.
    """
    root = root or scratch_path(spark, "logfiles")
    path_re = r"(\d{4})/(\d{2})/(\d{2})/(\d{2})/([^/]+)$"
    files = (lines.groupBy("filename")
             .agg(F.sort_array(F.collect_list(F.struct("line_number", "line"))).alias("_ls"))
             .select(
                 F.regexp_replace(F.regexp_extract("filename", path_re, 0), path_re, "$1-$2-$3-$4").alias("hour"),
                 F.regexp_extract("filename", path_re, 5).alias("file"),
                 F.array_join(F.transform("_ls", lambda x: x.getField("line")), "\n").alias("value")))
    (files.repartition("hour", "file")
     .write.mode(mode).partitionBy("hour", "file").text(root))
    return root
