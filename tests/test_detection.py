import datetime as dt

import pytest
from pyspark.sql import functions as F

from rootlens.operators import detection as det

START = dt.date(2024, 1, 1)


def series(spark, values, metric="total_revenue"):
    data = [(START + dt.timedelta(days=i), metric, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "metric_date date, metric string, value double")


def scored(spark, rows, values, threshold=2.0):
    frame = det.detect_anomalies(series(spark, values), threshold)
    return rows(frame, "metric_date")


def test_zscore_is_centred_and_flags_the_outlier(spark, rows):
    assert abs(scored(spark, rows, [10.0, 20.0, 30.0, 40.0, 50.0])[2]["zscore"]) < 1e-12
    assert scored(spark, rows, [0.0, 0.0, 0.0, 0.0, 10.0])[-1]["zscore"] > 1


def test_stable_series_has_no_anomaly(spark, rows):
    values = [100.0, 102, 98, 101, 99, 100, 103, 97, 101, 100]
    assert not any(r["is_anomaly"] for r in scored(spark, rows, [float(v) for v in values]))


def test_spike_and_drop(spark, rows):
    spike = scored(spark, rows, [100.0] * 9 + [500.0])
    assert [r["anomaly_direction"] for r in spike][-1] == "high"
    assert spike[-1]["is_anomaly"] and spike[-1]["change_pct"] == 400.0
    drop = scored(spark, rows, [100.0] * 4 + [10.0], 1.5)
    assert [r["anomaly_direction"] for r in drop if r["is_anomaly"]] == ["low"]


@pytest.mark.parametrize("values", [[5.0] * 6, [7.0]])
def test_flat_and_single_day_series_score_null(spark, rows, values):
    for row in scored(spark, rows, values):
        assert row["zscore"] is None
        assert row["is_anomaly"] is False and row["anomaly_direction"] == "normal"


def test_zero_previous_day_gives_no_percentage(spark, rows):
    assert scored(spark, rows, [0.0, 5.0])[1]["change_pct"] is None


def test_nan_never_counts_as_anomaly(spark, rows):
    fact = spark.createDataFrame(
        [(START + dt.timedelta(days=i), v) for i, v in enumerate([1.0, float("nan"), 2.0])],
        "metric_date date, total_revenue double",
    )
    found = det.detect_anomalies(det.long_metrics(fact, ["total_revenue"]), 0.1)
    assert rows(found, "metric_date")[1]["is_anomaly"] is False


def test_lookback_limits_before_looking_back(spark, rows):
    fact = series(spark, [1.0, 2.0, 3.0, 4.0]).select(
        "metric_date", F.col("value").alias("total_revenue")
    )
    found = rows(det.run_detection(fact, ["total_revenue"], lookback=2).scored, "metric_date")
    assert [r["value"] for r in found] == [3.0, 4.0]
    assert found[0]["prev_value"] is None


def test_run_reports_latest_anomaly_and_missing_data(spark, rows):
    values = [100.0] * 9 + [500.0] + [100.0] * 3
    fact = series(spark, values).select("metric_date", F.col("value").alias("total_revenue"))
    run = det.run_detection(fact, ["total_revenue"])
    assert rows(run.latest)[0]["metric_date"] == START + dt.timedelta(days=9)
    stats = rows(run.statistics)[0]
    assert (stats["status"], stats["total_days_analyzed"], stats["anomaly_count"]) == ("completed", 13, 1)
    empty = rows(det.run_detection(fact.filter("1 = 0"), ["total_revenue"]).statistics)[0]
    assert (empty["status"], empty["anomaly_count"], empty["mean"]) == ("no_data", 0, None)


def test_prior_anomalies_leave_out_the_current_day(spark, rows):
    scored_rows = det.detect_anomalies(series(spark, [100.0] * 20 + [500.0, 100.0, 520.0]))
    day = START + dt.timedelta(days=22)
    pairs = spark.createDataFrame(
        [("total_revenue", day, day - dt.timedelta(days=1))],
        "metric string, current_date date, previous_date date",
    )
    prior = rows(det.prior_anomalies(scored_rows, pairs))
    assert [r["metric_date"] for r in prior] == [START + dt.timedelta(days=20)]


@pytest.mark.parametrize("lookback", [1, 4, 30])
def test_each_day_is_judged_with_what_was_known_then(spark, rows, lookback):
    values = [100.0, 102, 98, 101, 900, 99, 100, None, 103, 97, 101, 500, 100, 100, 100, 100, 100]
    both = series(spark, values).unionByName(series(spark, values[:3], "orders"))
    found = rows(det.detect_as_of_each_day(both, lookback).filter("metric = 'total_revenue'"), "metric_date")
    fact = series(spark, values).withColumnRenamed("value", "total_revenue").drop("metric")
    for i in (0, 1, 4, 7, 11, 16):
        known = det.run_detection(fact.filter(F.col("metric_date") <= found[i]["metric_date"]), ["total_revenue"], lookback)
        last = rows(known.scored, "metric_date")[-1]
        whole = rows(known.statistics)[0]
        odd = [r["metric_date"] for r in rows(known.anomalies, "metric_date")]
        day = found[i]
        assert (day["prev_value"], day["is_anomaly"], day["anomaly_direction"]) == (last["prev_value"], last["is_anomaly"], last["anomaly_direction"])
        assert (day["zscore"] is None) == (last["zscore"] is None)
        assert day["zscore"] is None or day["zscore"] == pytest.approx(last["zscore"], abs=1e-8)
        assert (day["total_days_analyzed"], day["anomaly_count"]) == (whole["total_days_analyzed"], whole["anomaly_count"])
        assert day["latest_anomaly_date"] == (odd[-1] if odd else None)
        assert day["mean"] == pytest.approx(whole["mean"], abs=0.006) if whole["mean"] is not None else day["mean"] is None


def test_a_score_on_the_threshold_is_no_anomaly(spark, rows):
    # 1 one and 3 zeros score 1.5; the last bit of a sum must not lift it over that
    found = rows(det.detect_as_of_each_day(series(spark, [0.0, 0.0, 0.0, 1.0]), threshold=1.5), "metric_date")
    assert found[-1]["zscore"] == 1.5 and not found[-1]["is_anomaly"] and found[-1]["anomaly_count"] == 0


def test_detection_as_of_each_day_shuffles_once_and_keeps_frames_small(spark):
    plan = det.detect_as_of_each_day(series(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "RowFrame, -29" in plan
