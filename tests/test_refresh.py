import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from rootlens.operators import hierarchy as hy
from rootlens.operators import marts as mt
from rootlens.plans import onboarding as onb
from rootlens.plans import refresh as rf
from rootlens.sources import star

SF = "/root/testdata/sf0.001"


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("unit", ["day", "month"])
def test_a_refresh_equals_a_full_build_and_reads_its_periods_only(spark, base, unit):
    raw = star.read_raw(spark, SF)
    day = F.to_date("order_purchase_timestamp")
    # two days of a month and one of each of four others
    counts = raw["orders"].groupBy(day.alias("day")).agg(F.count("*").alias("n"), F.min("order_id").alias("first"))
    busy = counts.filter("n > 1").orderBy("day").limit(1).first()
    changed = busy["day"]
    use = (day == changed) | F.date_format(day, "yyyy-MM").isin("1996-03", "1997-05")
    orders = raw["orders"].filter(use)
    raw = {**raw, "orders": orders}
    late = (day == changed) & (F.col("order_id") > busy["first"])
    rf.build_daily({**raw, "orders": rf.orders_by_period(orders.filter(~late), base, unit)}, f"{base}/daily", unit)

    dropped = F.date_format(day, "yyyy-MM") == "1996-03"
    now = {**raw, "orders": rf.orders_by_period(orders, f"{base}/now", unit).filter(~F.col("period").startswith("1996-03"))}
    found = rf.changed_days(now["orders"], orders.filter(late))
    assert found == [changed]
    old = [r["day"] for r in orders.filter(dropped).select(day.alias("day")).distinct().collect()]
    assert old
    built = rf.refresh(now, [*found, *old], f"{base}/daily", unit)
    whole = mt.build_marts({**raw, "orders": orders.filter(~dropped)})
    for name in rf.DAILY:
        assert same(built[name], whole[name]), name
    text = plan(rf._only(now, ["1997-05"], unit)["orders"])
    assert "PartitionFilters" in text and "1997-05" in text.split("PartitionFilters")[1][:300]


def test_late_items_change_the_day_of_their_order(spark):
    at = [dt.datetime(2024, 1, 1 + i, 5) for i in range(3)]
    orders = spark.createDataFrame([("a", at[0]), ("b", at[1]), ("c", None)], "order_id string, order_purchase_timestamp timestamp_ntz")
    items = spark.createDataFrame([("b", 1), ("c", 1), ("x", 1), (None, 1)], "order_id string, order_item_id int")
    payments = spark.createDataFrame([("a",)], "order_id string")
    assert rf.changed_days(orders, items) == [dt.date(2024, 1, 2)]
    assert rf.changed_days(orders, items, payments) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def places(spark):
    rows = [("SP", "South", "x", "1"), ("RJ", "South", "y", "2"), ("AM", "North", "x", "1"), ("PA", "North", "y", "2"), (None, "North", "z", "3")]
    return spark.createDataFrame(rows * 3, "state string, region string, kind string, code string")


def test_finer_columns_are_found(spark, rows):
    found = rows(hy.dependencies(places(spark), ["state", "region", "kind", "code"]), "segment")
    assert [(r["detail"], r["segment"], r["detail_values"], r["segment_values"]) for r in found if r["segment"] == "region"] == [("state", "region", 5, 2)]
    assert {(r["detail"], r["segment"]) for r in found} == {("state", "region"), ("state", "kind"), ("state", "code")}
    assert hy.details_of(hy.dependencies(places(spark), ["region"])) == {}
    broken = places(spark).unionByName(spark.createDataFrame([("SP", "North", "x", "1")], places(spark).schema))
    assert "region" not in hy.details_of(hy.dependencies(broken, ["state", "region"]))


def test_an_onboarded_hierarchy_can_be_drilled(spark, rows, base):
    data = [(str(dt.date(2024, 1, 1 + i % 4)), "AB"[i % 2], "AB"[i % 2] + str(i % 8), float(i)) for i in range(400)]
    df = spark.createDataFrame(data, "day string, region string, state string, amount double")
    done = onb.onboard(df, "h", base, hierarchies=True)
    for known in (done, onb.load_dataset(spark, "h", base)):
        assert [(d.segment_col, d.detail_col) for d in known.spec.dimensions] == [("region", "state"), ("state", "state")]
        table = known.tables["metric_by_region"]
        assert table.columns == ["metric_date", "region", "state", "amount", "row_count"]
        assert table.agg(F.sum("amount")).first()[0] == sum(r[3] for r in data)
    assert [d.detail_col for d in onb.onboard(df, "h", base).spec.dimensions] == ["region", "state"]
