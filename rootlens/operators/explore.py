"""Tables behind the dashboards and lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.functions.scalars import metric_title, percent, signed_text, strict_date
from rootlens.operators import decomposition as dec
from rootlens.operators import detection as det
from rootlens.operators import narrative as nar
from rootlens.spec import DEFAULT_LOOKBACK, DEFAULT_THRESHOLD, DatasetSpec

KPI_METRICS = ("total_revenue", "order_count", "avg_order_value")
MONEY_KPIS = ("total_revenue", "avg_order_value")


def ordered_by_date(table: DataFrame) -> DataFrame:
    return table.orderBy("metric_date")


def selectable_dates(fact: DataFrame, before: str | dt.date | None = None) -> DataFrame:
    """Dates newest first; with ``before``, only those a date may be compared to."""
    dates = dec.metric_dates(fact)
    if before is not None:
        dates = dates.filter(F.col("metric_date") < F.lit(strict_date(before)))
    return dates.orderBy(F.desc("metric_date"))


def trend(fact: DataFrame, metric: str) -> DataFrame:
    return fact.select("metric_date", metric).orderBy("metric_date")


def metric_changes(fact: DataFrame, pairs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Current, previous, change and unrounded change % of every metric and pair."""
    sides = dec.pair_sides(pairs.select("current_date", "previous_date"))
    compared = dec.compare(det.long_metrics(fact, metrics), sides, dec.PAIR, ["metric_date"], ["metric"])
    change = F.col("current_value") - F.col("previous_value")
    return compared.withColumn("change", change).withColumn(
        "change_pct", F.coalesce(percent(F.col("change"), F.col("previous_value")), F.lit(0.0))
    )


def kpi_cards(fact: DataFrame, pairs: DataFrame) -> DataFrame:
    """Label, shown value and signed delta per KPI and pair."""
    value = F.col("current_value")
    shown = F.when(
        F.col("metric").isin(*MONEY_KPIS), F.concat(F.lit("$"), F.format_number(value, 2))
    ).otherwise(F.format_number(value.cast("bigint"), 0))
    return metric_changes(fact, pairs, KPI_METRICS).select(
        *dec.PAIR,
        metric_title(F.col("metric")).alias("label"),
        shown.alias("value"),
        F.concat(signed_text(F.col("change_pct")), F.lit("%")).alias("delta"),
    )


def bar_width(contribution: Column) -> Column:
    return F.least(F.abs(contribution), F.lit(100.0))


def waterfall(compared: DataFrame) -> DataFrame:
    """Per segment: previous, current, change and unrounded share of the change.

    The change of each segment's group is carried by a decomposition's ``compared``;
    for other rows it is added. Order by contribution ascending for the chart, descending for the table.
    """
    if "group_change" not in compared.columns:
        values = [F.sum(c).alias(c) for c in ("current_value", "previous_value")]
        compared = dec.with_group_change(compared, compared.groupBy(*dec.GROUP).agg(*values), dec.GROUP)
    changed = compared.withColumn("change", F.col("current_value") - F.col("previous_value"))
    return changed.select(
        *dec.PAIR,
        "dimension",
        "segment",
        "previous_value",
        "current_value",
        "change",
        F.coalesce(percent(F.col("change"), F.col("group_change")), F.lit(0.0)).alias("contribution"),
    )


# -- lookups by date pair, by default the newest one --------------------------------


def _pairs(fact: DataFrame, current, previous) -> DataFrame:
    if current and previous:
        return dec.given_pair(fact, current, previous)
    return dec.latest_pair(fact)


def daily_metrics(fact: DataFrame, metrics: Sequence[str], days: int = DEFAULT_LOOKBACK) -> DataFrame:
    return det.latest_days(fact.select("metric_date", *metrics), days)


def anomalies(
    fact: DataFrame, metric: str = "total_revenue", threshold: float = DEFAULT_THRESHOLD
) -> det.Detection:
    return det.run_detection(fact, [metric], threshold=threshold)


def decomposition(
    tables: Mapping[str, DataFrame],
    spec: DatasetSpec,
    current: str | None = None,
    previous: str | None = None,
    metric: str = "total_revenue",
) -> dec.Decomposition:
    return dec.decompose(tables, spec, [metric], _pairs(tables[spec.fact_table], current, previous))


def narrative(
    tables: Mapping[str, DataFrame],
    spec: DatasetSpec,
    generated_at: str,
    current: str | None = None,
    previous: str | None = None,
    metric: str = "total_revenue",
) -> DataFrame:
    d = decomposition(tables, spec, current, previous, metric)
    return nar.narratives(d.totals, d.top, dec.top_driver(d.top), generated_at)
