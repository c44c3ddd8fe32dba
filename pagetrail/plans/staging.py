"""SRC1-4, PRS1-15 over files in one text scan: parse first, number afterwards.

The scan is map-only: every line is parsed where it is read and written, with its
place (file, split, order within the split), to shared storage. Lines that only
Python's literal parser can decide are written as they are; a second pass over just
those lines sends them, and no others, through Arrow. Nothing else reads the text.

What needs the whole file comes from the splits' counts, one row per split:

* absolute line numbers, resolved only for the rows that carry them (``rejected``,
  ``samples``): lines in earlier splits plus the place in the own split;
* the empty last piece of a file that ends with a newline: its lines plus one separator
  each then add up to the file's size (it is one more line, and bad);
* a byte-order mark, which the line reader drops: the sum is 3 bytes short. With its
  mark the first line is no literal, so it is bad whatever else it holds;
* files that were listed but have no line: an empty file, or one of only a mark, has
  one piece, which is bad.

Good rows never meet a shuffle or join (files with a mark excepted: then their first
lines are taken out by an anti join).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed import BAD, GOOD, HOURLY, RAW_COLUMNS, REGEX_FAILED, REJECTED, UNDECIDED
from ..operators import parse
from ..session import scratch_path
from ..sinks.tables import delete
from ..sources.logfiles import SOURCE_LAYOUT, _normal_path, path_hour, scan_log_lines

_EMPTY = ("filename string, split bigint, seq bigint, size bigint, line string")


class ParsedFiles:
    """The parsed lines of some files on shared storage; see the module's text."""

    def __init__(self, spark: SparkSession, placed: DataFrame, listed: DataFrame, mode: str = HOURLY) -> None:
        self.spark, self.listed, self.mode = spark, listed, mode
        self.folder = scratch_path(spark, "parsed")
        keep_line = F.when(F.col("outcome").isin(REGEX_FAILED, REJECTED, UNDECIDED), F.col("line"))
        sized = placed.withColumn("bytes", F.octet_length("line") + 1)
        parsed = parse.parse_lines(sized, mode, rule="strict").withColumn("line", keep_line)
        parsed.write.parquet(f"{self.folder}/strict")
        strict = spark.read.schema(parsed.schema).parquet(f"{self.folder}/strict")
        left = strict.where(F.col("outcome") == UNDECIDED).select(*sized.columns)
        literal = parse.parse_lines(left, mode, rule="literal").withColumn("line", keep_line)
        literal.write.parquet(f"{self.folder}/literal")
        self.rows = strict.where(F.col("outcome") != UNDECIDED).unionByName(
            spark.read.schema(literal.schema).parquet(f"{self.folder}/literal"))
        self._count_splits().write.parquet(f"{self.folder}/splits")
        self.splits = spark.read.parquet(f"{self.folder}/splits")
        self._quality: DataFrame | None = None
        self._marked = self.splits.where("marked").limit(1).count() > 0

    def _count_splits(self) -> DataFrame:
        """One row per split: lines before it, its first ``seq``, and what the whole file's counts say."""
        per_split = self.rows.groupBy("filename", "split").agg(
            F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"),
            F.count_if(F.col("outcome") == BAD).alias("bad"), F.count_if(F.col("outcome") == REGEX_FAILED).alias("failed"),
            F.min_by("outcome", "seq").alias("first_outcome"))
        in_file = Window.partitionBy("filename")
        before = in_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
        over = F.sum("bytes").over(in_file) - F.col("size")
        return per_split.select("filename", "split", "n", "first", "bad", "failed", "first_outcome",
                                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                                over.isin(0, -3).alias("ends_nl"), over.isin(-2, -3).alias("marked"))

    def _without_marked(self, rows: DataFrame) -> DataFrame:
        """Rows other than the first lines of files with a byte-order mark, which are bad."""
        if not self._marked:
            return rows
        firsts = self.splits.where("marked and split = 0").select("filename", "split", F.col("first").alias("seq"))
        return rows.join(firsts, ["filename", "split", "seq"], "left_anti")

    def _numbered(self, outcome: str) -> DataFrame:
        rows = self._without_marked(self.rows.where(F.col("outcome") == outcome).select("filename", "split", "seq", "line"))
        return (rows.join(self.splits.select("filename", "split", "first", "before"), ["filename", "split"])
                .select("filename", (F.col("before") + F.col("seq") - F.col("first") + 1).cast("int").alias("line_number"), "line"))

    def good(self, strict: bool = False, with_file: bool = False) -> DataFrame:
        """Rows to store; ``strict`` raises when a line parsed but can't be stored."""
        if strict:
            bad = self.rejected().limit(1).collect()
            if bad:
                raise ValueError(f"unstorable row at {bad[0]['filename']}:{bad[0]['line_number']}")
        rows = self._without_marked(self.rows.where(F.col("outcome") == GOOD))
        return rows.select(*RAW_COLUMNS, *(["filename"] if with_file else []))

    def rejected(self) -> DataFrame:
        """(filename, line_number, line) of lines that parsed but can't be stored."""
        return self._numbered(REJECTED)

    def samples(self) -> DataFrame:
        """(filename, line_number, bad_line) of lines that failed the pattern; the backfill keeps none."""
        rows = self._numbered(REGEX_FAILED).withColumnRenamed("line", "bad_line")
        return rows if self.mode == HOURLY else rows.where(F.lit(False))

    def quality(self) -> DataFrame:
        """(filename, file_line_count, file_bad_lines, file_regex_failed) of every listed file."""
        if self._quality is None:
            self._count_files().write.parquet(f"{self.folder}/quality")
            self._quality = self.spark.read.parquet(f"{self.folder}/quality")
        return self._quality

    def _count_files(self) -> DataFrame:
        head = F.col("split") == 0
        tail = F.max(F.col("ends_nl").cast("int"))
        first_bad = F.max((head & F.col("marked") & (F.col("first_outcome") != BAD)).cast("int"))
        first_failed = F.max((head & F.col("marked") & (F.col("first_outcome") == REGEX_FAILED)).cast("int"))
        read = self.splits.groupBy("filename").agg(
            (F.sum("n") + tail).alias("file_line_count"), (F.sum("bad") + tail + first_bad).alias("file_bad_lines"),
            (F.sum("failed") - first_failed).alias("file_regex_failed"))
        lineless = (self.listed.withColumn("_file", _normal_path(F.col("filename")))
                    .join(read.select(_normal_path(F.col("filename")).alias("_file")), "_file", "left_anti")
                    .select("filename", *[F.lit(n).cast("bigint").alias(c) for n, c in
                                                    ((1, "file_line_count"), (1, "file_bad_lines"), (0, "file_regex_failed"))]))
        return read.unionByName(lineless)

    def files(self, layout: str = SOURCE_LAYOUT) -> DataFrame:
        """(filename, ingest_hour) of every file with lines, or listed without."""
        names = self.quality().select("filename")
        return names.select("filename", path_hour(F.col("filename"), layout).alias("ingest_hour"))

    def without(self, files: DataFrame) -> None:
        """Leave out the given (filename) files; a join only if there are any among these."""
        found = self.splits.join(files.select("filename").distinct(), "filename", "left_semi").select("filename").distinct()
        found.write.parquet(f"{self.folder}/left-out")
        found = self.spark.read.parquet(f"{self.folder}/left-out")
        if found.limit(1).count():
            if self._quality is not None:
                raise ValueError("files are left out before they are counted")
            self.rows, self.splits = (x.join(found, "filename", "left_anti") for x in (self.rows, self.splits))

    def drop(self) -> None:
        """Remove the staged files, once everything derived from them is written."""
        delete(self.spark, self.folder)


def parse_files(spark: SparkSession, root: str, hour: datetime | None = None, day: date | None = None, mode: str = HOURLY,
                layout: str = SOURCE_LAYOUT, glob: str | None = None, strict_utf8: bool = True) -> ParsedFiles:
    """Parse the files of one hour, one day, or all under ``root``, reading their text once."""
    found = scan_log_lines(spark, root, hour, day, layout, glob, strict_utf8)
    if found is None:
        found = spark.createDataFrame([], _EMPTY), spark.createDataFrame([], "filename string")
    return ParsedFiles(spark, *found, mode)
