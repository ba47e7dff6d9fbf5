"""Spark session helpers.

The library never creates its own cluster settings beyond what a test or a
local run needs: on a real cluster the session comes from ``spark-submit`` and
everything here only fills values that are unset.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE stays on so shuffle partition counts,
# skewed joins and small-side broadcasts are re-planned from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "immolens") -> SparkSession:
    """A local session for tests, notebooks and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("IMMOLENS_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ansi.enabled", "true")
        # local runs keep catalog tables out of the working folder
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="immolens-warehouse-"))
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir``, else from the context's checkpoint
    directory. Where neither is set, a local master (one machine, so a local
    folder is shared) gets a new folder; on a cluster this raises, as
    executors would each write to their own disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    current = tempfile.mkdtemp(prefix="immolens-ckpt-")
    context.setCheckpointDir(current)
    return current


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/immolens-{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever file system its path names."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str):
    """A new folder's path under the shared checkpoint folder, for the length
    of a ``with`` block: it is deleted at the end, also after an error."""
    path = scratch_folder(spark, name)
    try:
        yield path
    finally:
        remove_folder(spark, path)
