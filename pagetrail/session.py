"""Session settings and the shared scratch location.

Settings the library relies on: UTC session time zone (log times are zone-less
and compared as such), ANSI mode (casts that overflow fail, as PostgreSQL's
did), adaptive execution with partition coalescing and skew-join splitting.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# JVM option applied only when the deployment has not set its own: the parse builds large
# generated methods, which HotSpot leaves interpreted (over 8 KB of bytecode) unless told otherwise.
JIT_OPTION = "-XX:-DontCompileHugeMethods"


def get_session(master: str | None = None, app_name: str = "pagetrail", **conf) -> SparkSession:
    """Build (or reuse) a session with the library's settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULT_CONF, **conf}
    for key in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        settings.setdefault(key, JIT_OPTION)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when a local session has none (tests) is a private folder created
    and registered; on a cluster it must be set, so lineage cuts and derived files
    always land in the folder every executor can reach.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this client: the configured folder or a private one
        return spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="pagetrail-ckpt-")
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
        elif not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="pagetrail-ckpt-"))
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
