"""AGG4 / SNK2 / SNK3: per-file data-quality counts and failure samples.

``file_quality`` is a single hash aggregate keyed by file name. Spark's partial
aggregation collapses each task's rows to one row per file before the shuffle,
so a file that holds a third of all lines still sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import BAD, REGEX_FAILED


def file_quality(parsed: DataFrame) -> DataFrame:
    """(filename, file_line_count, file_bad_lines, file_regex_failed) per file."""
    return parsed.groupBy("filename").agg(
        F.count(F.lit(1)).alias("file_line_count"),
        F.count_if(F.col("outcome") == BAD).alias("file_bad_lines"),
        F.count_if(F.col("outcome") == REGEX_FAILED).alias("file_regex_failed"),
    )


def failure_samples(parsed: DataFrame) -> DataFrame:
    """(filename, line_number, bad_line) of every line that failed the pattern."""
    return (parsed.filter(F.col("outcome") == REGEX_FAILED)
            .select("filename", "line_number", F.col("line").alias("bad_line")))
