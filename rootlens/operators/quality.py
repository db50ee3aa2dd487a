"""Data-quality checks: one result row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootlens.operators.marts import REGIONS

MAX_GAP_DAYS = 30


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, unique, accepted_values, positive, continuous
    table: str
    column: str
    values: tuple[str, ...] = ()
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# Order statuses that may occur.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
# Columns that must be unique / present, per table.
UNIQUE = {
    "stg_orders": ["order_id"],
    "stg_customers": ["customer_id"],
    "stg_products": ["product_id"],
    "fact_daily_metrics": ["metric_date"],
    "dim_geography": ["state_code"],
    "dim_product": ["product_category"],
    "dim_payment": ["payment_type"],
}
NOT_NULL = {
    "stg_orders": ["order_id", "customer_id", "order_date"],
    "stg_order_items": ["order_id", "product_id", "price"],
    "stg_customers": ["customer_id", "customer_state"],
    "stg_products": ["product_id"],
    "fact_daily_metrics": ["metric_date", "order_count", "total_revenue"],
    "dim_geography": ["state_code", "region"],
    "dim_product": ["product_category", "product_category_group"],
    "dim_payment": ["payment_type"],
    "metric_by_geography": ["metric_date", "state_code", "total_revenue"],
    "metric_by_product": ["metric_date", "product_category", "total_revenue"],
    "metric_by_payment": ["metric_date", "payment_type", "total_revenue"],
}
RETAIL_CHECKS = (
    *[Check("unique", t, c) for t, cols in UNIQUE.items() for c in cols],
    *[Check("not_null", t, c) for t, cols in NOT_NULL.items() for c in cols],
    Check("accepted_values", "stg_orders", "order_status", ORDER_STATUSES),
    Check("accepted_values", "dim_geography", "region", (*REGIONS, "Unknown")),
    Check("positive", "fact_daily_metrics", "total_revenue"),
    Check("continuous", "fact_daily_metrics", "metric_date", severity="warn"),
)


# -- failing rows ---------------------------------------------------------------


def duplicates(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def unaccepted(table: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        table.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def negative_revenue(fact: DataFrame) -> DataFrame:
    return fact.filter("total_revenue < 0").select("metric_date", "total_revenue")


def date_gaps(fact: DataFrame, more_than: int = MAX_GAP_DAYS) -> DataFrame:
    """Dates that follow a gap. The window runs over one row per calendar day."""
    before = F.lag("metric_date").over(Window.orderBy("metric_date"))
    return (
        fact.select("metric_date", before.alias("prev_date"))
        .withColumn("gap_days", F.datediff("metric_date", "prev_date"))
        .filter(F.col("gap_days") > more_than)
    )


# -- counted failures -------------------------------------------------------------


def null_counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) for all columns from a single scan."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "failures")


def _labelled(failures: DataFrame, check: Check) -> DataFrame:
    return failures.select(
        F.lit(check.kind).alias("kind"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        "failures",
    )


def _failing_rows(check: Check, table: DataFrame) -> DataFrame:
    if check.kind == "unique":
        return duplicates(table, check.column)
    if check.kind == "accepted_values":
        return unaccepted(table, check.column, check.values)
    if check.kind == "positive":
        return table.filter(F.col(check.column) < 0)
    if check.kind == "continuous":
        return date_gaps(table)
    raise ValueError(f"unknown check kind {check.kind}")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = RETAIL_CHECKS) -> DataFrame:
    """(check, kind, table, column, severity, failures, status)."""
    results = []
    by_table: dict[tuple[str, str], list[Check]] = {}
    for check in checks:
        if check.kind == "not_null":
            by_table.setdefault((check.table, check.severity), []).append(check)
        else:
            failing = _failing_rows(check, tables[check.table])
            results.append(_labelled(failing.agg(F.count("*").alias("failures")), check))
    for (table, severity), group in by_table.items():
        counts = null_counts(tables[table], [c.column for c in group])
        results.append(
            counts.select(
                F.lit("not_null").alias("kind"),
                F.lit(table).alias("table"),
                "column",
                F.lit(severity).alias("severity"),
                "failures",
            )
        )
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return (
        reduce(DataFrame.unionByName, results)
        .withColumn("check", F.concat_ws("_", "kind", "table", "column"))
        .withColumn("status", status)
        .select("check", "kind", "table", "column", "severity", "failures", "status")
    )
