"""A cross-section of the registered queries against their SQL; run
tests/oracle_check.py for all of them."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from rootlens.plans import catalog

SF = "/root/testdata/sf0.001"
PICKED = (
    "a02_fact_daily_metrics a03_metric_by_geography a04_metric_by_product a05_metric_by_payment "
    "a06_primary_row a13_dimension_rollup d01_detect_anomalies d05_all_pairs_top d06_drill_down "
    "d11_citation_errors j03_product_star l03_top_driver n01_narratives o01_profile o12_cycle q06_quality_suite"
).split()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", PICKED)
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_every_query_has_a_check():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
