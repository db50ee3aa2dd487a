"""Daily fact and breakdown tables for an onboarded table, and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.functions.literals import each
from rootlens.functions.scalars import DATE_FORMATS, lenient_timestamp, safe_name, safe_names
from rootlens.operators.classification import Roles
from rootlens.operators.profiling import is_temporal
from rootlens.spec import DatasetSpec, DimensionSpec

ROW_COUNT = "row_count"
# Totals agree within one cent plus a millionth.
ABSOLUTE_TOLERANCE = 0.01
RELATIVE_TOLERANCE = 1e-6


def dated_rows(
    df: DataFrame, date_column: str, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Adds metric_date; NULL where the date does not parse."""
    column = F.col(f"`{date_column}`")
    if not is_temporal(df.schema[date_column].dataType):
        column = lenient_timestamp(column.cast("string"), formats)
    return df.withColumn("metric_date", F.to_date(column))


def rejected_rows(dated: DataFrame, date_column: str) -> DataFrame:
    """The rows the tables leave out, with the reason."""
    text = F.trim(F.col(f"`{date_column}`").cast("string"))
    empty = F.coalesce(text == "", F.lit(True))
    reason = F.when(empty, "no date").otherwise(F.concat(F.lit("unreadable date: "), F.left(text, F.lit(60))))
    return dated.filter("metric_date IS NULL").drop("metric_date").withColumn("reject_reason", reason)


def unparsed_rows(dated: DataFrame) -> DataFrame:
    """How many rows the tables leave out."""
    return dated.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("metric_date").isNull()).alias("dropped_rows"),
    )


def _metric_value(df: DataFrame, name: str, scale: int | None) -> Column:
    """Flags as 0/1, NaN as NULL; with ``scale``, floats as exact decimals."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        return column.cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = F.when(~F.isnan(column), column.cast("double"))
        return number if scale is None else number.cast(T.DecimalType(28, scale))
    return column


def _prepared(df: DataFrame, roles: Roles, scale: int | None) -> DataFrame:
    metrics = [_metric_value(df, m, scale).alias(safe) for m, safe in metric_names(roles).items()]
    dims = [F.col(f"`{d}`").cast("string").alias(f"dim {d}") for d in roles.dimensions]
    return df.filter("metric_date IS NOT NULL").select("metric_date", *metrics, *dims)


def metric_names(roles: Roles) -> dict[str, str]:
    """Original to safe metric names; ``row_count`` is always the counted one."""
    names = safe_names(roles.metrics)
    return {raw: safe for raw, safe in names.items() if safe != ROW_COUNT}


def _sums(metrics: Sequence[str]) -> list[Column]:
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in metrics]
    return [*sums, F.count("*").alias(ROW_COUNT)]


def daily_fact(dated: DataFrame, roles: Roles, scale: int | None = None) -> DataFrame:
    """Sum per metric and a row count per day; a daily table passes through."""
    metrics = list(metric_names(roles).values())
    rows = _prepared(dated, roles, scale).select("metric_date", *metrics)
    if roles.grain == "daily":
        return rows.withColumn(ROW_COUNT, F.lit(1).cast("bigint"))
    return rows.groupBy("metric_date").agg(*_sums(metrics))


def dimension_rollup(
    dated: DataFrame,
    roles: Roles,
    scale: int | None = None,
    null_segment: str | None = None,
    details: Mapping[str, str] | None = None,
) -> DataFrame:
    """(metric_date, dimension, segment, metrics..., row_count) from one scan.

    With ``details`` (see hierarchy.details_of) the rows are those of a segment's details, in a
    column ``detail``; a dimension without one is its own detail.

    Rows are summed map-side per (day, dimension, segment), so neither a busy
    day nor a dominant segment is shuffled row by row. A NULL segment is left
    out, which the reconciliation then reports, unless ``null_segment`` names it.
    """
    metrics = list(metric_names(roles).values())
    label = F.lit(null_segment).cast("string")
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(d).alias("dimension"),
                    F.coalesce(F.col(f"`dim {d}`"), label).alias("segment"),
                    *([] if details is None else [F.coalesce(F.col(f"`dim {details.get(d, d)}`"), label).alias("detail")]),
                )
                for d in roles.dimensions
            ]
        )
    )
    return (
        _prepared(dated, roles, scale)
        .select("metric_date", *metrics, each.alias("d"))
        .filter("d.segment IS NOT NULL")
        .groupBy("metric_date", "d.dimension", "d.segment", *([] if details is None else ["d.detail"]))
        .agg(*_sums(metrics))
    )


def dataset_spec(roles: Roles, details: Mapping[str, str] | None = None) -> DatasetSpec:
    """Segment and detail coincide but for the columns that ``details`` names a finer one for.

    A dimension keeps its original spelling, its table and column are safe names.
    """
    metrics = tuple(metric_names(roles).values())
    safe_names(roles.dimensions)
    dims = tuple(
        DimensionSpec(d, f"metric_by_{safe_name(d)}", safe_name(d), safe_name((details or {}).get(d, d)))
        for d in roles.dimensions
    )
    names = (*metrics, ROW_COUNT)
    return DatasetSpec("fact_daily_metrics", names, dims, frozenset(names))


def dimension_tables(rollup: DataFrame, spec: DatasetSpec) -> dict[str, DataFrame]:
    """One table per dimension, each a filter on the shared rollup."""

    def labels(dim: DimensionSpec) -> list[Column]:
        segment = F.col("segment").alias(dim.segment_col)
        finer = dim.detail_col != dim.segment_col
        return [segment, F.col("detail").alias(dim.detail_col)] if finer else [segment]

    return {
        dim.table: rollup.filter(F.col("dimension") == dim.name).select("metric_date", *labels(dim), *spec.metrics)
        for dim in spec.dimensions
    }


def generate_tables(dated: DataFrame, roles: Roles, scale: int | None = None) -> dict[str, DataFrame]:
    spec = dataset_spec(roles)
    fact = daily_fact(dated, roles, scale)
    if not roles.dimensions:
        return {spec.fact_table: fact}
    return {spec.fact_table: fact, **dimension_tables(dimension_rollup(dated, roles, scale), spec)}


# -- reconciliation -------------------------------------------------------------------


def date_totals(table: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per-date totals in long form: (metric_date, keys..., metric, total)."""
    summed = table.groupBy("metric_date", *keys).agg(
        *[F.sum(m).cast("double").alias(m) for m in metrics]
    )
    return summed.unpivot(["metric_date", *keys], list(metrics), "metric", "total")


def reconcile(
    fact: DataFrame, rollup: DataFrame, dimensions: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Fact total next to each dimension's total per date and metric.

    Compared by key, so a date missing on either side is a mismatch of its own.
    """
    expected = (
        date_totals(fact, metrics)
        .withColumnRenamed("total", "fact_total")
        .select("*", each("dimension", dimensions))
    )
    actual = date_totals(rollup, metrics, ["dimension"]).withColumnRenamed("total", "dimension_total")
    f, d = F.col("fact_total"), F.col("dimension_total")
    close = F.abs(f - d) <= ABSOLUTE_TOLERANCE + RELATIVE_TOLERANCE * F.abs(d)
    return expected.join(actual, ["metric_date", "dimension", "metric"], "full").withColumn(
        "matches", F.coalesce(close, F.lit(False))
    )


def reconciliation_errors(reconciled: DataFrame) -> DataFrame:
    """One message per dimension that disagrees somewhere."""
    return (
        reconciled.filter(~F.col("matches"))
        .groupBy("dimension")
        .agg(F.count("*").alias("mismatches"), F.min("metric_date").alias("first_date"))
        .withColumn(
            "error",
            F.concat(
                "dimension", F.lit(": per-date totals don't reconcile with fact_daily_metrics")
            ),
        )
    )
