"""Tables that are replaced at once: a folder for each version, and a pointer readers follow.

A new version is written beside the current one. Only when it is complete does a small
file, itself replaced by a rename, name it as current. A write that fails, or a job that is
killed, leaves the old version readable; frames that read the version before go on
reading it, as that is kept until the next commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

#: Hidden from Spark's readers, like all names that begin so.
POINTER = "_current"


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """(file system, path) of Hadoop for a path or URI."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def versions_of(spark: SparkSession, folder: str) -> list[str]:
    """The committed versions that are kept, the current one first; none if there is no pointer."""
    system, target = _path(spark, f"{folder}/{POINTER}")
    if not system.exists(target):
        return []
    stream = system.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.split()


def current(spark: SparkSession, folder: str) -> str | None:
    """The folder of the current version."""
    kept = versions_of(spark, folder)
    return f"{folder}/{kept[0]}" if kept else None


def write(df: DataFrame, folder: str, partition_by: str | None = None, kind: str = "parquet") -> str:
    """Write a version that no reader sees yet; its name. What a failed write leaves is removed."""
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write.format(kind)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.save(f"{folder}/{version}")
    except Exception:
        remove(df.sparkSession, f"{folder}/{version}")
        raise
    return version


def remove(spark: SparkSession, folder: str) -> None:
    system, target = _path(spark, folder)
    system.delete(target, True)


def commit(spark: SparkSession, folder: str, version: str) -> str:
    """Make ``version`` current in one rename; keep the one before, remove the one before that."""
    kept = [version, *versions_of(spark, folder)]
    jvm = spark.sparkContext._jvm
    system, draft = _path(spark, f"{folder}/{POINTER}-{version}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray("\n".join(kept[:2]).encode()))
    finally:
        stream.close()
    _, target = _path(spark, f"{folder}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = getattr(jvm.org.apache.hadoop.fs.Options, "Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs.Options, "Rename"), 1)
    options[0] = overwrite
    context.rename(draft, target, options)
    for old in kept[2:]:
        remove(spark, f"{folder}/{old}")
    return f"{folder}/{version}"


def commit_all(spark: SparkSession, written: Mapping[str, str]) -> dict[str, str]:
    """Commit versions of several folders, all of which have been written by now."""
    return {folder: commit(spark, folder, version) for folder, version in written.items()}
