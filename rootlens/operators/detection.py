"""Z-score detection over daily metrics, all metrics in one pass.

The windows are partitioned by metric and a metric has one row per calendar
day, so a window partition stays small however large the raw tables are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootlens.functions.literals import each, one_row
from rootlens.functions.scalars import half_even, percent, without_nan
from rootlens.spec import DEFAULT_LOOKBACK, DEFAULT_THRESHOLD


#: Digits of the scores of detect_as_of_each_day.
SCORE_DIGITS = 9


def latest_days(fact: DataFrame, lookback: int = DEFAULT_LOOKBACK) -> DataFrame:
    """The newest ``lookback`` rows; counts available days, not calendar days."""
    return fact.orderBy(F.desc("metric_date")).limit(lookback)


def long_metrics(fact: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(metric_date, metric, value) with one row per metric and day."""
    typed = fact.select("metric_date", *[without_nan(F.col(m)).alias(m) for m in metrics])
    return typed.unpivot("metric_date", list(metrics), "metric", "value")


def zscore(value: Column, window) -> Column:
    """Distance from the window mean in sample deviations; NULL for a flat series."""
    spread = F.stddev_samp(value).over(window)
    return F.try_divide(value - F.avg(value).over(window), spread)


def direction(score: Column, threshold: float) -> Column:
    return (
        F.when(score > threshold, "high").when(score < -threshold, "low").otherwise("normal")
    )


def detect_anomalies(
    values: DataFrame, threshold: float = DEFAULT_THRESHOLD, series: Sequence[str] = ("metric",)
) -> DataFrame:
    """Score every day of every series and compare it with the day before it."""
    whole = Window.partitionBy(*series)
    # value breaks ties where a pass-through dataset repeats a date
    in_time = whole.orderBy("metric_date", "value")
    value, score = F.col("value"), F.col("zscore")
    return (
        values.withColumn("zscore", zscore(value, whole))
        .withColumn("prev_value", F.lag("value").over(in_time))
        .withColumn("is_anomaly", F.coalesce(F.abs(score) > threshold, F.lit(False)))
        .withColumn("anomaly_direction", direction(score, threshold))
        .withColumn("change_value", value - F.col("prev_value"))
        .withColumn(
            "change_pct", half_even(percent(F.col("change_value"), F.col("prev_value")))
        )
    )


def anomalies_only(scored: DataFrame) -> DataFrame:
    return scored.filter("is_anomaly")


def prior_anomalies(scored: DataFrame, run_pairs: DataFrame) -> DataFrame:
    """Anomalies on other days than the one under study.

    ``run_pairs`` has one (metric, current_date, previous_date) row per metric.
    """
    other_day = F.col("metric_date") != F.col("current_date")
    return anomalies_only(scored).join(run_pairs, "metric").filter(other_day)


def latest_anomaly(scored: DataFrame, series: Sequence[str] = ("metric",)) -> DataFrame:
    """At most one row per series: its newest anomaly."""
    fields = F.struct(
        "metric_date",
        F.col("value").alias("metric_value"),
        half_even(F.col("zscore")).alias("zscore"),
        F.col("anomaly_direction").alias("direction"),
        "change_pct",
        "change_value",
    )
    newest = F.max_by(fields, F.struct("metric_date", "value"))
    return anomalies_only(scored).groupBy(*series).agg(newest.alias("a")).select(*series, "a.*")


def series_statistics(scored: DataFrame, series: Sequence[str] = ("metric",)) -> DataFrame:
    return scored.groupBy(*series).agg(
        F.count("*").alias("total_days_analyzed"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        half_even(F.avg("value")).alias("mean"),
        half_even(F.stddev_samp("value")).alias("std"),
        half_even(F.min("value")).alias("min"),
        half_even(F.max("value")).alias("max"),
    )


def detection_status(statistics: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per requested metric; a metric without data says so."""
    asked = one_row(statistics.sparkSession, each("metric", metrics))
    return asked.join(statistics, "metric", "left").select(
        "metric",
        F.when(F.col("total_days_analyzed") > 0, "completed").otherwise("no_data").alias("status"),
        F.coalesce("total_days_analyzed", F.lit(0)).alias("total_days_analyzed"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
        "mean",
        "std",
        "min",
        "max",
    )


@dataclass(frozen=True)
class Detection:
    scored: DataFrame
    anomalies: DataFrame
    latest: DataFrame
    statistics: DataFrame


def run_detection(
    fact: DataFrame,
    metrics: Sequence[str],
    lookback: int = DEFAULT_LOOKBACK,
    threshold: float = DEFAULT_THRESHOLD,
) -> Detection:
    """Limit to the newest days first, so ``prev_value`` never looks outside them."""
    scored = detect_anomalies(long_metrics(latest_days(fact, lookback), metrics), threshold)
    return Detection(
        scored=scored,
        anomalies=anomalies_only(scored),
        latest=latest_anomaly(scored),
        statistics=detection_status(series_statistics(scored), metrics),
    )


def detect_as_of_each_day(
    values: DataFrame,
    lookback: int = DEFAULT_LOOKBACK,
    threshold: float = DEFAULT_THRESHOLD,
    series: Sequence[str] = ("metric",),
) -> DataFrame:
    """What run_detection would have said on every day, with the days known then.

    A row a series and day: the day's own score, change and direction within the ``lookback``
    available days that end with it, and the statistics of those days, the number of
    anomalies among them, each judged by that window, and the newest anomalous one. Statistics
    are not rounded; scores are, so that one on the threshold is not decided by the last bit
    of a sum. A frame of rows carries at most ``lookback`` values of one series."""
    in_time = Window.partitionBy(*series).orderBy("metric_date", "value")
    window = in_time.rowsBetween(1 - lookback, 0)
    value, score = F.col("value"), F.col("zscore")

    def scored(of: Column) -> Column:
        return F.round(F.try_divide(of - F.col("_mean"), F.col("_std")), SCORE_DIGITS)

    def unusual(day: Column) -> Column:
        return F.coalesce(F.abs(scored(day["value"])) > threshold, F.lit(False))

    days = F.collect_list(F.struct("metric_date", "value")).over(window)
    earlier = F.lag("value").over(in_time) if lookback > 1 else F.lit(None).cast("double")
    return (
        values.withColumns(
            {
                "_mean": F.avg("value").over(window),
                "_std": F.stddev_samp("value").over(window),
                "_min": F.min("value").over(window),
                "_max": F.max("value").over(window),
                "_days": days,
                "prev_value": earlier,
            }
        )
        .withColumn("zscore", scored(value))
        .withColumn("_odd", F.filter("_days", unusual))
        .select(
            *series,
            "metric_date",
            "value",
            "zscore",
            "prev_value",
            (value - F.col("prev_value")).alias("change_value"),
            half_even(percent(value - F.col("prev_value"), F.col("prev_value"))).alias("change_pct"),
            F.coalesce(F.abs(score) > threshold, F.lit(False)).alias("is_anomaly"),
            direction(score, threshold).alias("anomaly_direction"),
            F.size("_days").cast("bigint").alias("total_days_analyzed"),
            F.size("_odd").cast("bigint").alias("anomaly_count"),
            F.try_element_at(F.col("_odd"), F.lit(-1))["metric_date"].alias("latest_anomaly_date"),
            F.col("_mean").alias("mean"),
            F.col("_std").alias("std"),
            F.col("_min").alias("min"),
            F.col("_max").alias("max"),
        )
    )
