"""Properties of the plans and of the numbers that must survive any refactoring."""

import re

import pytest

from rootlens.operators import decomposition as dec
from rootlens.operators import marts as mt
from rootlens.operators import rollup as ru
from rootlens.operators.classification import Roles
from rootlens.sources import star
from rootlens.sources.sinks import store_under
from rootlens.spec import RETAIL

SF = "/root/testdata/sf0.001"
TABLES = [RETAIL.fact_table, *[d.table for d in RETAIL.dimensions]]


@pytest.fixture(scope="module")
def shuffled(spark):
    """No broadcast by size, as with tables too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLES)
def test_marts_stay_in_the_engine_and_join_by_key(shuffled, name):
    text = plan(mt.build_marts(star.read_raw(shuffled, SF))[name])
    assert not re.search("NestedLoop|Cartesian|Python|Arrow|SinglePartition", text)


def test_fact_reads_three_line_columns_and_shuffles_four_times(shuffled):
    text = plan(mt.build_marts(star.read_raw(shuffled, SF))["fact_daily_metrics"])
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>" in text
    # items by order, orders by order, (day, customer), day
    assert text.count("Exchange hashpartitioning") == 4


def test_lines_are_summed_before_they_are_shuffled(shuffled):
    text = plan(mt.build_marts(star.read_raw(shuffled, SF))["fact_daily_metrics"]).splitlines()
    scan = next(i for i, line in enumerate(text) if "l_extendedprice" in line and "FileScan" in line)
    exchange = max(i for i, line in enumerate(text[:scan]) if "Exchange" in line)
    assert any("partial_sum" in line for line in text[exchange:scan])


def test_the_product_lookup_scans_lines_once_and_broadcasts_nothing(shuffled):
    text = plan(mt.build_marts(star.read_raw(shuffled, SF))["metric_by_product"])
    assert "BroadcastExchange" not in text
    assert text.count("l_extendedprice:double") == 1 and "_salt" in text


def test_top_five_is_limited_before_the_shuffle(spark, base):
    tables = mt.build_marts(star.read_raw(spark, SF), store_under(base))
    text = plan(dec.decompose(tables, RETAIL, ["total_revenue"]).top)
    assert text.count("WindowGroupLimit") == 2
    assert not re.search("NestedLoop|Cartesian", text)


def test_segments_are_not_joined_by_group(shuffled, base):
    tables = mt.build_marts(star.read_raw(shuffled, SF), store_under(base))
    text = plan(dec.decompose(tables, RETAIL, ["total_revenue"]).contributions)
    # the change of a group reaches its segments by a salted join, never by the group alone
    joins = re.findall(r"SortMergeJoin \[(.*?)\]", text)
    assert joins and all("_salt" in keys for keys in joins)


def test_rollup_of_all_dimensions_scans_once(spark):
    roles = Roles("ts", "other", ("value",), ("event_type", "props"))
    dated = ru.dated_rows(star.read_table(spark, SF, "events"), "ts")
    text = plan(ru.dimension_rollup(dated, roles))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_every_breakdown_adds_up_to_the_fact_table(spark, base):
    tables = mt.build_marts(star.read_raw(spark, SF), store_under(base))
    rows = dec.dimension_slices(tables, RETAIL, ["total_revenue"]).rows
    wide = rows.withColumnRenamed("value", "total_revenue")
    names = [d.name for d in RETAIL.dimensions]
    checked = ru.reconcile(tables[RETAIL.fact_table], wide, names, ["total_revenue"])
    assert checked.count() == 3 * tables[RETAIL.fact_table].count()
    assert checked.filter("NOT matches").isEmpty()


def test_contributions_of_every_pair_sum_to_hundred(spark, base):
    tables = mt.build_marts(star.read_raw(spark, SF), store_under(base))
    found = dec.decompose(tables, RETAIL, ["total_revenue"])
    sums = found.contributions.groupBy(*dec.GROUP).agg({"contribution_pct": "sum", "change": "sum", "*": "count"})
    off = sums.filter("`sum(change)` <> 0 AND abs(`sum(contribution_pct)` - 100) > 0.005 * `count(1)` + 1e-6")
    assert sums.count() > 0 and off.isEmpty()
