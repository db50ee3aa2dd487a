import datetime as dt

import pytest
from pyspark.sql import functions as F

from rootlens.operators import decomposition as dec
from rootlens.operators import explore
from rootlens.spec import DatasetSpec, DimensionSpec

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)
SPEC = DatasetSpec(
    "fact",
    ("sales",),
    (DimensionSpec("geo", "by_geo", "region", "state"), DimensionSpec("kind", "by_kind", "kind", "kind")),
    frozenset({"sales"}),
)


def compared(spark, *segments):
    data = [("m", D2, D1, "geo", 0, s, float(c), float(p)) for s, c, p in segments]
    return spark.createDataFrame(
        data,
        "metric string, current_date date, previous_date date, dimension string, dim_order int, "
        "segment string, current_value double, previous_value double",
    )


def tables(spark):
    geo = [
        (D1, "SP", "South", 100), (D1, "RJ", "South", 50), (D1, "AM", "North", 30),
        (D2, "SP", "South", 60), (D2, "AM", "North", 40), (D2, "PA", "North", 5),
        (D3, "SP", "South", 60), (D3, None, None, 9),
    ]
    kind = [(D1, "a", 180), (D2, "a", 100), (D2, "b", 5), (D3, "b", 69)]
    return {
        "fact": spark.createDataFrame([(D1, 180), (D2, 105), (D3, 69)], "metric_date date, sales bigint"),
        "by_geo": spark.createDataFrame(geo, "metric_date date, state string, region string, sales bigint"),
        "by_kind": spark.createDataFrame(kind, "metric_date date, kind string, sales bigint"),
    }


def test_contributions_sum_to_hundred(spark, rows):
    out = rows(dec.contributions(compared(spark, ("A", 150, 100), ("B", 250, 200))))
    assert sum(r["contribution_pct"] for r in out) == pytest.approx(100)


def test_offsetting_and_negative_changes(spark, rows):
    basic = dec.contributions(compared(spark, ("A", 100, 80), ("B", 200, 180), ("C", 300, 320)))
    assert {r["segment"]: r["contribution_pct"] for r in rows(basic)} == {"A": 100, "B": 100, "C": -100}
    falling = rows(dec.contributions(compared(spark, ("A", 50, 100), ("B", 100, 200))))
    assert all(r["change"] < 0 for r in falling)


def test_zero_base_and_zero_total(spark, rows):
    zero_base = rows(dec.contributions(compared(spark, ("A", 100, 0), ("B", 200, 100))), "segment")
    assert [r["change_pct"] for r in zero_base] == [0, 100]
    zero_total = rows(dec.contributions(compared(spark, ("A", 10, 0), ("B", 0, 10))))
    assert all(r["contribution_pct"] == 0 for r in zero_total)


def test_ties_rank_by_value_then_name(spark, rows):
    top = dec.strongest(dec.contributions(compared(spark, ("B", 10, 0), ("A", 10, 0), ("C", 20, 10))))
    assert [r["segment"] for r in rows(top, "rank")] == ["C", "A", "B"]


def test_only_five_contributors_but_all_segments_count(spark, rows):
    frame = compared(spark, *[(f"s{i}", 10 + i, 0) for i in range(8)])
    assert len(rows(dec.strongest(dec.contributions(frame)))) == 5
    assert rows(dec.dimension_totals(frame))[0]["segment_count"] == 8


def test_totals_match_the_rows(spark, rows):
    total = rows(dec.dimension_totals(compared(spark, ("A", 440, 500), ("B", 93, 100))))[0]
    assert (total["total_current"], total["total_change"], total["total_change_pct"]) == (533, -67, -11.17)


def test_one_sided_segments_count_as_zero_and_null_segments_are_named(spark, rows):
    found = dec.decompose(tables(spark), SPEC, ["sales"])
    geo = found.compared.filter("dimension = 'geo'")
    values = {
        (r["current_date"], r["segment"]): (int(r["current_value"]), int(r["previous_value"]))
        for r in rows(geo)
    }
    assert values == {
        (D2, "South"): (60, 150),
        (D2, "North"): (45, 30),
        (D3, "South"): (60, 60),
        (D3, "North"): (0, 45),
        (D3, "(none)"): (9, 0),
    }


def test_forty_series_take_the_same_plan(spark):
    def shape(n):
        t = tables(spark)
        names = [f"m{i}" for i in range(n)]
        wide = {k: df.select("*", *[F.col("sales").alias(m) for m in names]) if "sales" in df.columns else df for k, df in t.items()}
        text = dec.decompose(wide, SPEC, names).contributions._jdf.queryExecution().optimizedPlan().toString()
        return [w for w in text.split() if w in ("Join", "Aggregate", "Window", "Generate")]

    assert shape(2) == shape(40)


def test_all_pairs_equal_each_single_pair(spark, rows):
    t = tables(spark)
    order = ["current_date", "dimension", "segment"]
    everything = rows(dec.decompose(t, SPEC, ["sales"]).top, *order)
    singles = []
    for pair in (("2024-01-02", "2024-01-01"), ("2024-01-05", "2024-01-02")):
        single = dec.decompose(t, SPEC, ["sales"], dec.given_pair(t["fact"], *pair))
        singles += rows(single.top, *order)
    assert everything == singles


def test_stored_contributions_change_nothing(spark, rows, base):
    from rootlens.sources.sinks import store_under

    t = tables(spark)
    order = ["current_date", "dimension", "segment"]
    stored = dec.decompose(t, SPEC, ["sales"], store=store_under(base))
    plain = dec.decompose(t, SPEC, ["sales"])
    assert rows(stored.top, *order) == rows(plain.top, *order)
    assert rows(stored.totals, *order[:2]) == rows(plain.totals, *order[:2])


def test_missing_metric_is_a_status_row(spark, rows):
    t = tables(spark)
    t["by_kind"] = t["by_kind"].withColumnRenamed("sales", "other")
    found = dec.decompose(t, SPEC, ["sales"])
    status = {r["dimension"]: r["status"] for r in rows(found.status)}
    assert status == {"geo": "ok", "kind": "error"}
    assert {r["dimension"] for r in rows(found.totals)} == {"geo"}


def test_driver_prefers_the_earlier_dimension_and_needs_a_contribution(spark, rows):
    def ranked(dimension, order, segment, share):
        return ("m", D2, D1, dimension, order, segment, 1.0, share, abs(share), 0.0, 1)

    schema = (
        "metric string, current_date date, previous_date date, dimension string, dim_order int, segment string, "
        "change double, contribution_pct double, abs_contribution double, change_pct double, rank int"
    )
    tied = spark.createDataFrame([ranked("b", 1, "y", -60.0), ranked("a", 0, "x", 60.0)], schema)
    assert rows(dec.top_driver(tied))[0]["segment"] == "x"
    nothing = spark.createDataFrame([ranked("a", 0, "x", 0.0)], schema)
    assert rows(dec.top_driver(nothing)) == []


def test_pairs_skip_missing_days_and_respect_the_target(spark):
    fact = tables(spark)["fact"]
    assert dec.comparison_dates(fact) == (D3, D2)
    assert dec.comparison_dates(fact, "2024-01-04") == (D2, D1)
    with pytest.raises(ValueError, match="two dates are needed"):
        dec.comparison_dates(fact, "2024-01-01")
    with pytest.raises(ValueError):
        dec.latest_pair(fact, "01/02/2024")


def test_drill_down_keeps_quoted_segments_and_zero_fills(spark, rows):
    t = tables(spark)
    t["by_geo"] = t["by_geo"].withColumn("region", F.replace("region", F.lit("South"), F.lit("So'uth")))
    found = dec.decompose(t, SPEC, ["sales"], dec.given_pair(t["fact"], D2, D1))
    keys = found.top.filter("segment = 'So''uth'").select(*dec.GROUP, "segment")
    absent = keys.withColumn("segment", F.lit("Nowhere"))
    targets = keys.union(absent)
    inside = dec.drill_down(found.slices, targets)
    assert {r["segment"]: int(r["change"]) for r in rows(inside)} == {"SP": -40, "RJ": -50}
    totals = rows(dec.drill_totals(targets, inside), "parent")
    assert [(r["parent"], r["total_change"], r["segment_count"]) for r in totals] == [
        ("Nowhere", 0, 0),
        ("So'uth", -90, 2),
    ]


def test_kpis_and_waterfall(spark, rows):
    fact = spark.createDataFrame(
        [(D1, 1000.0, 4, 250.0), (D2, 1250.5, 3, 416.83)],
        "metric_date date, total_revenue double, order_count int, avg_order_value double",
    )
    cards = {r["label"]: (r["value"], r["delta"]) for r in rows(explore.kpi_cards(fact, dec.latest_pair(fact)))}
    assert cards["Total Revenue"] == ("$1,250.50", "+25.0%")
    assert cards["Order Count"] == ("3", "-25.0%")
    falls = rows(explore.waterfall(compared(spark, ("A", 3, 0), ("B", 0, 1))), "segment")
    assert [r["contribution"] for r in falls] == [150.0, -50.0]


def test_pairs_as_of_many_targets_equal_single_lookups(spark, rows):
    fact = spark.createDataFrame([(D1,), (D2,), (D2,), (D3,), (None,)], "metric_date date")
    targets = [D1 - dt.timedelta(days=1), D1, D2, D2, dt.date(2024, 1, 4), D3, dt.date(2030, 1, 1), None]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "n int, target_date date")
    found = {r["n"]: (r["current_date"], r["previous_date"]) for r in rows(dec.pairs_as_of(fact, asked))}
    wanted = {}
    for i, t in enumerate(targets):
        pair = [] if t is None else rows(dec.latest_pair(fact.dropna(), t))
        if pair:
            wanted[i] = (pair[0]["current_date"], pair[0]["previous_date"])
    assert found == wanted and len(found) == 5


def test_pairs_as_of_keep_series_apart(spark, rows):
    fact = spark.createDataFrame([("a", D1), ("a", D3), ("b", D2)], "shop string, metric_date date")
    asked = spark.createDataFrame([("a", D3), ("a", D2), ("b", D3), ("c", D3)], "shop string, target_date date")
    assert rows(dec.pairs_as_of(fact, asked, ["shop"])) == [
        {"shop": "a", "target_date": D3, "current_date": D3, "previous_date": D1}
    ]


def test_targets_are_not_compared_with_all_dates(spark):
    fact = spark.createDataFrame([(D1,), (D2,)], "metric_date date")
    asked = spark.range(50).selectExpr("date_add(date'2024-01-01', int(id)) AS target_date")
    plan = dec.pairs_as_of(fact, asked)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
