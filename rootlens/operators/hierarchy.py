"""Which dimension columns of an unknown table are finer than others.

A column determines another when each of its values stands beside one value of the other
only. Then the finer one is the detail of the coarser, and a change can be drilled into.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHAPE = "detail string, segment string, detail_values bigint, segment_values bigint"


def dependencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(detail, segment, detail_values, segment_values) of the column pairs where every value of
    ``detail`` has one value of ``segment``, which has fewer values but more than one.

    One pass: each task sends on the distinct pairs of values it has seen, of columns with few
    values. NULL is a value like others; columns with equally many values name the same thing."""
    pairs = list(combinations(range(len(columns)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], SHAPE)
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    both = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), values[i].alias("a"), values[j].alias("b")) for i, j in pairs])
    )
    counted = (
        df.select(both.alias("p"))
        .select("p.*")
        .distinct()
        .groupBy("i", "j")
        .agg(
            F.count("*").alias("pairs"),
            F.count_distinct(F.struct("a")).alias("a_values"),
            F.count_distinct(F.struct("b")).alias("b_values"),
        )
    )
    names = F.array(*[F.lit(c) for c in columns])
    ways = [
        counted.select(
            names[F.col(fine)].alias("detail"),
            names[F.col(coarse)].alias("segment"),
            F.col(f"{x}_values").alias("detail_values"),
            F.col(f"{y}_values").alias("segment_values"),
            "pairs",
        )
        for fine, coarse, x, y in (("i", "j", "a", "b"), ("j", "i", "b", "a"))
    ]
    determined = (F.col("pairs") == F.col("detail_values")) & (F.col("segment_values") > 1)
    finer = F.col("detail_values") > F.col("segment_values")
    return ways[0].unionByName(ways[1]).filter(determined & finer).drop("pairs")


def details_of(found: DataFrame) -> dict[str, str]:
    """The detail of each column that has one: of several the finest, ties by name. A row a pair of columns."""
    rows = sorted(found.collect(), key=lambda r: (r["detail_values"], r["detail"]))
    return {r["segment"]: r["detail"] for r in rows}
