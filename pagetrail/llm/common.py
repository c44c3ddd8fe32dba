"""Shared pieces of the training-data operators: scratch tables and documents as columns.

Intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir``,
which every executor shares, so a lost executor costs at most a re-read.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table under ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a temporary folder of its own; on a
    cluster it must be set, as no other folder is known to be shared.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir() or getattr(spark, "_llm_scratch", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark._llm_scratch = tempfile.mkdtemp(prefix="llm-scratch-")
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: cuts lineage, computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Shared:
    """A broadcast value of a class of this package, which executors may not be able to import."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self._pickled = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        return cloudpickle.loads(self._pickled.value)


def lean(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over Arrow batches that gives memory back when its task ends.

    Python workers are kept for later tasks, and would keep what this one had needed.
    """

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run
