"""Split a metric's change between two dates by dimension and segment.

Works on any set of date pairs at once. A fact row is sent to each pair it
takes part in (as the current or the previous side) and both sides are summed
conditionally, which gives the full outer comparison in one shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.functions.literals import one_row
from rootlens.functions.scalars import half_even, percent_or_zero, strict_date, without_nan
from rootlens.operators.skew import salted_lookup_join
from rootlens.spec import DatasetSpec

PAIR = ["metric", "current_date", "previous_date"]
GROUP = [*PAIR, "dimension", "dim_order"]
TOP_CONTRIBUTORS = 5
#: What a NULL segment is called.
NO_SEGMENT = "(none)"

# Writes a frame under a name and returns it read back, e.g. sinks.store_under(base).
Store = Callable[[str, DataFrame], DataFrame]


# -- date pairs -----------------------------------------------------------------


def metric_dates(fact: DataFrame) -> DataFrame:
    return fact.select("metric_date").distinct()


def consecutive_pairs(dates: DataFrame) -> DataFrame:
    """Each available date with the available date before it.

    The window has no partition key: it runs over distinct calendar days, of
    which there are a few thousand, never over data rows.
    """
    earlier = F.lag("metric_date").over(Window.orderBy("metric_date"))
    return (
        metric_dates(dates)
        .select(F.col("metric_date").alias("current_date"), earlier.alias("previous_date"))
        .filter("previous_date IS NOT NULL")
    )


def latest_pair(fact: DataFrame, target: str | dt.date | None = None) -> DataFrame:
    """The two newest dates not after ``target``; empty when there are fewer."""
    dates = metric_dates(fact)
    if target is not None:
        dates = dates.filter(F.col("metric_date") <= F.lit(strict_date(target)))
    return (
        dates.orderBy(F.desc("metric_date"))
        .limit(2)
        .agg(
            F.max("metric_date").alias("current_date"),
            F.min("metric_date").alias("previous_date"),
            F.count("*").alias("_n"),
        )
        .filter("_n = 2")
        .drop("_n")
    )


def pairs_as_of(fact: DataFrame, targets: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """For every target_date of ``targets`` the pair that latest_pair finds: the newest date not
    after it and the one before that; a target with fewer than two such dates has no row.

    Dates and targets are sorted together once and each target takes the last date before it, so
    no target is compared with all dates. With ``series`` dates and targets are those
    of each series; without, the window runs over distinct calendar days only. Targets may repeat."""
    keys = list(series)
    wanted = targets.select(*keys, F.col("target_date").cast("date").alias("at")).dropna().distinct()
    dates = fact.select(*keys, F.col("metric_date").alias("at")).dropna().distinct()
    earlier = F.lag("at").over(Window.partitionBy(*keys).orderBy("at"))
    events = dates.withColumn("pair", F.struct(F.col("at").alias("current_date"), earlier.alias("previous_date")))
    none = F.lit(None).cast(events.schema["pair"].dataType)
    # a date sorts before a target of the same day
    both = events.withColumn("asks", F.lit(0)).unionByName(wanted.select(*keys, "at", none.alias("pair"), F.lit(1).alias("asks")))
    seen = Window.partitionBy(*keys).orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("pair", F.last("pair", ignorenulls=True).over(seen)).filter("asks = 1")
    found = carried.filter("pair.previous_date IS NOT NULL").select(*keys, F.col("at").alias("target_date"), "pair.*")
    return targets.withColumn("target_date", F.col("target_date").cast("date")).join(found, [*keys, "target_date"])


def comparison_dates(fact: DataFrame, target: str | dt.date | None = None) -> tuple[dt.date, dt.date]:
    """``latest_pair`` as Python dates, for callers that need the values."""
    row = latest_pair(fact, target).first()
    if row is None:
        raise ValueError("two dates are needed for a comparison")
    return row["current_date"], row["previous_date"]


def given_pair(fact: DataFrame, current: str | dt.date, previous: str | dt.date) -> DataFrame:
    return one_row(
        fact.sparkSession,
        F.lit(strict_date(current)).alias("current_date"),
        F.lit(strict_date(previous)).alias("previous_date"),
    )


def pair_sides(pairs: DataFrame) -> DataFrame:
    """Two rows per pair: the date to read and whether it is the current one."""
    side = F.explode(
        F.array(
            F.struct(F.col("current_date").alias("metric_date"), F.lit(True).alias("is_current")),
            F.struct(F.col("previous_date").alias("metric_date"), F.lit(False).alias("is_current")),
        )
    )
    return pairs.select("*", side.alias("s")).select(*pairs.columns, "s.*")


# -- breakdown tables in long form -------------------------------------------------


def _value_type(tables: Mapping[str, DataFrame], used: Sequence[tuple[str, str]]) -> T.DataType:
    """Exact decimals unless some metric is stored as floating point."""
    types = [tables[table].schema[metric].dataType for table, metric in used]
    if any(isinstance(t, (T.DoubleType, T.FloatType)) for t in types):
        return T.DoubleType()
    scales = [t.scale for t in types if isinstance(t, T.DecimalType)]
    return T.DecimalType(28, max(scales, default=0))


@dataclass(frozen=True)
class Slices:
    """``rows``: (metric_date, dimension, dim_order, segment, detail, metric, value).
    ``status``: one row per (dimension, metric) saying whether it could be read."""

    rows: DataFrame
    status: DataFrame


def dimension_slices(
    tables: Mapping[str, DataFrame], spec: DatasetSpec, metrics: Sequence[str]
) -> Slices:
    """Stack every breakdown table that carries the metrics.

    A table without a metric yields an error row, not a failure. A NULL segment
    or detail is kept under the label NO_SEGMENT, so a dimension's totals are whole.
    """
    readable, report = [], []
    for dim in spec.dimensions:
        columns = tables[dim.table].columns
        for metric in metrics:
            found = metric in columns
            readable += [(dim, metric)] if found else []
            error = None if found else f"column {metric} does not exist in {dim.table}"
            report.append((dim.name, metric, "ok" if found else "error", error))
    session = tables[spec.fact_table].sparkSession
    status = session.createDataFrame(
        [(*entry, entry[1] in spec.additive) for entry in report],
        "dimension string, metric string, status string, error string, additive boolean",
    )
    if not readable:
        nothing = (
            "metric_date date, dimension string, dim_order int, segment string, detail string, "
            "metric string, value double"
        )
        return Slices(session.createDataFrame([], nothing), status)
    value_type = _value_type(tables, [(dim.table, metric) for dim, metric in readable])

    def typed(metric: str):
        value = F.col(metric)
        clean = without_nan(value) if isinstance(value_type, T.DoubleType) else value.cast(value_type)
        return clean.alias(metric)

    parts = []
    for order, dim in enumerate(spec.dimensions):
        mine = [metric for d, metric in readable if d is dim]
        if not mine:
            continue
        wide = (
            tables[dim.table]
            .select(
                "metric_date",
                F.lit(dim.name).alias("dimension"),
                F.lit(order).alias("dim_order"),
                F.coalesce(F.col(dim.segment_col).cast("string"), F.lit(NO_SEGMENT)).alias("segment"),
                F.coalesce(F.col(dim.detail_col).cast("string"), F.lit(NO_SEGMENT)).alias("detail"),
                *[typed(metric) for metric in mine],
            )
        )
        ids = ["metric_date", "dimension", "dim_order", "segment", "detail"]
        parts.append(wide.unpivot(ids, mine, "metric", "value"))
    return Slices(reduce(DataFrame.unionByName, parts), status)


def segment_totals(rows: DataFrame) -> DataFrame:
    """Detail rolled up to segment, per date."""
    return rows.groupBy("metric_date", "metric", "dimension", "dim_order", "segment").agg(
        F.sum("value").alias("value")
    )


# -- comparison and contribution -------------------------------------------------------


def compare(
    rows: DataFrame, sides: DataFrame, by: Sequence[str], on: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """Current and previous value per ``by``; a missing side counts as 0.

    The rows of a day are spread over tasks by ``spread`` and the sides copied;
    any number of pairs may ask for the same day.
    """
    value, current = F.col("value"), F.col("is_current")
    zero = F.lit(0)
    return (
        salted_lookup_join(rows, sides, on, spread)
        .groupBy(*by)
        .agg(
            F.coalesce(F.sum(F.when(current, value)), zero).alias("current_value"),
            F.coalesce(F.sum(F.when(~current, value)), zero).alias("previous_value"),
        )
    )


DETAIL = ["dimension", "segment", "detail"]


def compare_groups(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both values per metric and dimension."""
    sides = pair_sides(pairs.select("current_date", "previous_date"))
    return compare(rows, sides, GROUP, ["metric_date"], DETAIL)


def with_group_change(compared: DataFrame, whole: DataFrame, group: Sequence[str]) -> DataFrame:
    """Every segment with the change of its whole group.

    A group may have very many segments: they are spread over tasks by name and
    the group's row is copied to each.
    """
    change = (F.col("current_value") - F.col("previous_value")).alias("group_change")
    return salted_lookup_join(compared, whole.select(*group, change), group, ["segment"])


def compare_segments(rows: DataFrame, pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Both values per segment; ``whole`` is the comparison per group."""
    sides = pair_sides(pairs.select("current_date", "previous_date"))
    compared = compare(rows, sides, [*GROUP, "segment"], ["metric_date"], DETAIL)
    return with_group_change(compared, whole, GROUP)


def contributions(compared: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Each row's change, its relative change and its share of the group's change."""
    change = F.col("change")
    changed = compared.withColumn("change", F.col("current_value") - F.col("previous_value"))
    if "group_change" not in compared.columns:
        totals = changed.groupBy(*group).agg(F.sum("change").alias("group_change"))
        changed = changed.join(totals, list(group))
    return (
        changed.withColumn("change_pct", percent_or_zero(change, F.col("previous_value")))
        .withColumn("contribution_pct", percent_or_zero(change, F.col("group_change")))
        .withColumn("abs_contribution", F.abs("contribution_pct"))
    )


def strongest(contributed: DataFrame, group: Sequence[str] = GROUP, k: int = TOP_CONTRIBUTORS):
    """The k largest shares per group. Spark trims every task's input to k rows
    per group before the shuffle, so the group size does not matter."""
    order = Window.partitionBy(*group).orderBy(
        F.desc("abs_contribution"), F.desc("current_value"), F.asc("segment")
    )
    return contributed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def dimension_totals(compared: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    change = F.col("_current") - F.col("_previous")
    return (
        compared.groupBy(*group)
        .agg(
            F.sum("current_value").alias("_current"),
            F.sum("previous_value").alias("_previous"),
            F.count("*").alias("segment_count"),
        )
        .select(
            *group,
            half_even(F.col("_current")).alias("total_current"),
            half_even(F.col("_previous")).alias("total_previous"),
            half_even(change).alias("total_change"),
            percent_or_zero(change, F.col("_previous")).alias("total_change_pct"),
            "segment_count",
        )
    )


def top_driver(top: DataFrame, pair: Sequence[str] = PAIR) -> DataFrame:
    """The single largest share over all dimensions; earlier dimensions win ties.

    A pair in which nothing contributes has no row.
    """
    best = F.min_by(
        F.struct(
            "dimension",
            "segment",
            "contribution_pct",
            "change",
            "change_pct",
            "abs_contribution",
        ),
        F.struct((-F.col("abs_contribution")).alias("a"), "dim_order", "rank"),
    )
    return (
        top.filter("abs_contribution > 0")
        .groupBy(*pair)
        .agg(best.alias("d"))
        .select(*pair, "d.*")
    )


@dataclass(frozen=True)
class Decomposition:
    slices: DataFrame
    pairs: DataFrame
    compared: DataFrame
    contributions: DataFrame
    top: DataFrame
    totals: DataFrame
    status: DataFrame


def decompose(
    tables: Mapping[str, DataFrame],
    spec: DatasetSpec,
    metrics: Sequence[str],
    pairs: DataFrame | None = None,
    store: Store | None = None,
) -> Decomposition:
    """Decompose ``metrics`` for ``pairs``, by default every consecutive pair.

    The contributions feed the ranking, the totals, the drill plan and the texts;
    with ``store`` they are computed once and read back by all of these.
    """
    sliced = dimension_slices(tables, spec, metrics)
    if pairs is None:
        pairs = consecutive_pairs(tables[spec.fact_table])
    compared = compare_segments(sliced.rows, pairs, compare_groups(sliced.rows, pairs))
    contributed = contributions(compared)
    if store is not None:
        contributed = store("contributions", contributed)
        compared = contributed.select(*compared.columns)
    return Decomposition(
        slices=sliced.rows,
        pairs=pairs,
        compared=compared,
        contributions=contributed.drop("group_change"),
        top=strongest(contributed.drop("group_change")),
        totals=dimension_totals(compared),
        status=sliced.status,
    )


# -- drill-down -----------------------------------------------------------------------


def drill_down(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Detail-grain contributions inside each (pair, dimension, segment) of ``targets``.

    The drilled segment is kept as ``parent``; ``segment`` holds the detail.
    """
    sides = pair_sides(targets.select(*GROUP, F.col("segment").alias("parent")))
    inside = rows.withColumnRenamed("segment", "parent").withColumnRenamed("detail", "segment")
    group = [*GROUP, "parent"]
    on = ["metric_date", "metric", "dimension", "dim_order", "parent"]
    spread = ["segment"]
    whole = compare(inside, sides, group, on, spread)
    compared = compare(inside, sides, [*group, "segment"], on, spread)
    return contributions(with_group_change(compared, whole, group), group).drop("group_change")


def drill_totals(targets: DataFrame, drilled: DataFrame) -> DataFrame:
    """Totals of every target; a target without detail rows shows zeros."""
    group = [*GROUP, "parent"]
    asked = targets.select(*GROUP, F.col("segment").alias("parent"))
    filled = asked.join(dimension_totals(drilled, group), group, "left")
    return filled.fillna(
        0,
        ["total_current", "total_previous", "total_change", "total_change_pct", "segment_count"],
    )
