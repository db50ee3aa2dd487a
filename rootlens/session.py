"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Fixed for every run: dates are cut in UTC, divisions use try_divide under ANSI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(app: str = "rootlens", cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster supplies its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ROOTLENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**BASE_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors reach.

    Only a session whose driver is its sole executor may leave it unset; its
    temporary folder is then as shared as any.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        return tempfile.gettempdir()
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the shared one, deleted when the application ends."""
    path = f"{shared_dir(spark)}/rootlens-{uuid.uuid4()}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return path


def reach_package(spark: SparkSession) -> None:
    """Let Python workers on the driver's machine import this package from where it is.

    On a cluster the package is shipped with the job; there the path is not there
    and does no harm."""
    root = str(Path(__file__).resolve().parents[1])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)
