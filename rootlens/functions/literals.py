"""Small fixed frames: one row per entry of a list known to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def one_row(spark: SparkSession, *columns: Column) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(*columns)


def rows_of(spark: SparkSession, entries: Sequence[Column]) -> DataFrame:
    """One row per struct column."""
    return one_row(spark, F.inline(F.array(*entries)))


def each(name: str, values: Sequence[str]) -> Column:
    """A generator that repeats a row for every value."""
    return F.explode(F.array(*[F.lit(v) for v in values])).alias(name)
