import datetime as dt

import pytest

from rootlens.plans import daily_run as run
from rootlens.sources import sinks
from rootlens.spec import DatasetSpec, DimensionSpec

SPEC = DatasetSpec(
    "fact", ("sales", "buyers"), (DimensionSpec("geo", "by_geo", "region", "state"),), frozenset({"sales"})
)
START = dt.date(2024, 1, 1)
STAMP = "2024-02-01 08:00:00"


def tables(spark, values):
    days = [START + dt.timedelta(days=i) for i in range(len(values))]
    fact = [(d, float(v), 1) for d, v in zip(days, values)]
    geo = [(d, s, r, v * w) for d, v in zip(days, values) for s, r, w in (("SP", "South", 0.6), ("AM", "North", 0.4))]
    return {
        "fact": spark.createDataFrame(fact, "metric_date date, sales double, buyers int"),
        "by_geo": spark.createDataFrame(geo, "metric_date date, state string, region string, sales double"),
    }


SPIKE = [100] * 20 + [500, 100]


def test_run_with_anomaly(spark, rows, base):
    found = run.daily_run(tables(spark, SPIKE), SPEC, ["sales"], STAMP, run_investigation=True)
    report = rows(found.report)[0]
    assert (report["status"], report["anomaly_count"], report["alert_status"]) == ("completed", 1, "sent")
    assert report["current_date"] == START + dt.timedelta(days=21)
    assert report["summary"] == "Sales decreased 80.0% on 2024-01-22. Primary driver: South (geo) contributed 60.0% of the change."
    investigation = rows(found.investigation)[0]
    assert (investigation["status"], investigation["driver_segment"]) == ("completed", "South")
    assert investigation["grounding_failed"]
    run.publish(found, base)
    assert spark.read.parquet(f"{base}/alerts").count() == 1
    assert spark.read.parquet(f"{base}/run_metrics").count() == 3
    shown = rows(run.run_summary(found.report))[0]
    assert shown["period"] == "2024-01-21 → 2024-01-22" and shown["pipeline_status"] == "completed"


def test_latest_anomaly_target(spark, rows):
    found = run.daily_run(tables(spark, SPIKE), SPEC, ["sales"], STAMP, target="latest_anomaly")
    report = rows(found.report)[0]
    assert report["current_date"] == START + dt.timedelta(days=20)
    assert report["summary"].startswith("Sales increased 400.0%")


@pytest.mark.parametrize(
    "options, status, reason",
    [
        ({}, "skipped", "no_anomaly"),
        ({"force_alert": True, "dry_run": True}, "dry_run", None),
        ({"force_alert": True, "has_channel": False}, "skipped", "no_channel"),
    ],
)
def test_quiet_series(spark, rows, options, status, reason):
    calm = tables(spark, [100, 101, 99, 100, 102])
    found = run.daily_run(calm, SPEC, ["sales"], STAMP, run_investigation=True, **options)
    report = rows(found.report)[0]
    assert (report["alert_status"], report["alert_reason"]) == (status, reason)
    expected = "completed" if options else "skipped_no_anomaly"
    assert rows(found.investigation)[0]["status"] == expected


def test_failures_are_rows(spark, rows, base):
    one = rows(run.daily_run(tables(spark, [100]), SPEC, ["sales"], STAMP).report)[0]
    assert (one["status"], one["error"]) == ("failed", run.NO_DATES)
    none = rows(run.daily_run(tables(spark, []), SPEC, ["sales"], STAMP).report)[0]
    assert (none["status"], none["error"]) == ("failed", "no_data")
    both = {r["metric"]: r for r in rows(run.daily_run(tables(spark, SPIKE), SPEC, ["sales", "buyers"], STAMP).report)}
    assert both["sales"]["status"] == "completed"
    assert both["buyers"]["error"] == "no dimension carries this metric"


def test_metric_without_any_breakdown_still_reports(spark, rows):
    alone = run.daily_run(tables(spark, SPIKE), SPEC, ["buyers"], STAMP, run_investigation=True)
    assert rows(alone.report)[0]["error"] == "no dimension carries this metric"
    bare = DatasetSpec("fact", ("sales",), ())
    assert rows(run.daily_run(tables(spark, SPIKE), bare, ["sales"], STAMP).report)[0]["status"] == "failed"


@pytest.mark.parametrize("segment, failed", [("North", False), ("East", True)])
def test_statements_are_checked(spark, rows, segment, failed):
    pair = ("sales", START + dt.timedelta(days=21), START + dt.timedelta(days=20))
    keys = "metric string, current_date date, previous_date date, "
    citations = spark.createDataFrame(
        [(*pair, 0, "geo", segment, "decomposition", "led it")],
        keys + "position int, dimension string, segment string, source string, claim string",
    )
    notes = spark.createDataFrame([(*pair, None)], keys + "uncertainty_note string")
    found = run.daily_run(
        tables(spark, SPIKE), SPEC, ["sales"], STAMP,
        run_investigation=True, statements=run.Statements(citations, notes),
    )
    result = rows(found.investigation)[0]
    assert result["grounding_failed"] is failed
    start = "The primary driver was South" if failed else "Led it: **North** (Geo) contributed **40.0%**"
    assert result["investigation_summary"].startswith(start)


def test_stored_run_is_the_same(spark, rows, base):
    t = tables(spark, SPIKE)
    plain = rows(run.daily_run(t, SPEC, ["sales"], STAMP).report)
    stored = rows(run.daily_run(t, SPEC, ["sales"], STAMP, store=sinks.store_under(base)).report)
    assert plain == stored


def test_publishing_again_adds_nothing(spark, rows, base):
    t = tables(spark, SPIKE)
    found = run.daily_run(t, SPEC, ["sales"], STAMP, run_id="monday")
    for again in (found, found, run.daily_run(t, SPEC, ["sales"], STAMP, run_id="monday")):
        run.publish(again, base)
    assert spark.read.parquet(f"{base}/alerts").count() == 1
    run.publish(run.daily_run(t, SPEC, ["sales"], STAMP), base)
    assert spark.read.parquet(f"{base}/alerts").count() == 2
    assert spark.read.parquet(f"{base}/run_metrics").count() == 6


def test_the_run_record_tells_when_it_ran(spark, rows, base):
    found = run.daily_run(tables(spark, SPIKE), SPEC, ["sales", "buyers"], STAMP, run_id="x")
    record = rows(run.run_record(found, sinks.store_under(base)), "metric")
    assert [r["status"] for r in record] == ["failed", "completed"] and {r["run_id"] for r in record} == {"x"}
    for r in record:
        assert r["completed_at"] > r["started_at"] == found.started_at
        assert r["duration_seconds"] == pytest.approx((r["completed_at"] - r["started_at"]).total_seconds(), abs=1e-3)
    shown = rows(run.run_summary(run.run_record(found, sinks.store_under(base))))[0]
    assert {"started_at", "completed_at", "duration_seconds"} <= set(shown)
