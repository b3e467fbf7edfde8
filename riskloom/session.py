"""Session defaults shared by the tests, the bench and ad-hoc use."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "riskloom") -> SparkSession:
    """A session with AQE on and the time zone pinned to UTC."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    """One temporary folder a process, gone with it."""
    folder = tempfile.mkdtemp(prefix="riskloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share, spark.checkpoint.dir; a temporary folder only where that is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = _local_folder()
    elif "://" not in found:  # below the default file system, which readers beside Spark don't know
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
        found = found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file://") else found
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"
