"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs rely on. On a cluster the submitter's own settings win; these are only
# defaults for sessions started through `session()`.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints that nothing refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Whole XML documents go to Python in record batches of at most this size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
    # Up to so many values of a list are looked up in statistics and Bloom filters one by one.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Filings are many small files: open more of them per task.
    "spark.sql.files.openCostInBytes": str(1 << 20),
}


def session(app: str = "shredloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or get) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shredloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a path with all below it, if it is there."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
