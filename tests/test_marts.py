import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rootlens.operators import marts as mt
from rootlens.operators import quality as qa
from rootlens.operators import skew
from rootlens.sources.csv_tables import RAW_TABLES
from rootlens.sources.sinks import store_under

DAY = dt.datetime(2024, 1, 6, 23, 30)  # a Saturday


def frame(spark, name, *rows):
    schema = ", ".join(
        f"{c} {'string' if k.startswith('varchar') else 'timestamp_ntz' if k == 'timestamp' else k}"
        for c, k in RAW_TABLES[name]
    )
    names = [c for c, _ in RAW_TABLES[name]]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schema)


def order(key, customer="c1", status="delivered", ts=DAY, **more):
    return {"order_id": key, "customer_id": customer, "order_status": status, "order_purchase_timestamp": ts, **more}


def item(key, n, product, price, freight="0.00"):
    return {
        "order_id": key, "order_item_id": n, "product_id": product,
        "price": Decimal(price), "freight_value": Decimal(freight),
    }


@pytest.fixture(scope="module")
def raw(spark):
    return {
        "orders": frame(
            spark, "orders",
            order("o1", order_delivered_customer_date=dt.datetime(2024, 1, 7, 0, 10)),
            order("o2", customer="c2"),
            order("o3", status="canceled"),
            order("o4", status=None),
            order("o5", ts=None),
            order("o6"),
            order("o7", ts=dt.datetime(2024, 1, 8)),
        ),
        "order_items": frame(
            spark, "order_items",
            item("o1", 1, "p1", "10.00", "1.50"), item("o1", 2, "p2", "20.00"), item("o1", 3, "p3", "5.00"),
            item("o2", 1, "p3", "7.25"), item("o3", 1, "p1", "99.00"), item("o4", 1, "p1", "99.00"),
            item("o5", 1, "p1", "99.00"), item("o7", 1, "missing", "3.00"),
        ),
        "customers": frame(
            spark, "customers",
            {"customer_id": "c1", "customer_state": "SP"}, {"customer_id": "c2", "customer_state": "XX"},
            {"customer_id": "c3", "customer_state": None},
        ),
        "products": frame(
            spark, "products",
            {"product_id": "p1", "product_category_name": "telefonia"},
            {"product_id": "p2", "product_category_name": "telefonia"},
            {"product_id": "p3", "product_category_name": None},
        ),
        "sellers": frame(spark, "sellers"),
        "payments": frame(
            spark, "payments",
            {"order_id": "o1", "payment_sequential": 1, "payment_type": "credit_card"},
            {"order_id": "o1", "payment_sequential": 2, "payment_type": "voucher"},
            {"order_id": "o2", "payment_sequential": 2, "payment_type": "boleto"},
            {"order_id": "o7", "payment_sequential": 1, "payment_type": "cash"},
        ),
        "category_translation": frame(
            spark, "category_translation",
            {"product_category_name": "telefonia", "product_category_name_english": "telephony"},
        ),
    }


@pytest.fixture(scope="module")
def built(raw):
    return mt.build_marts(raw)


def numbers(rows):
    return [{k: float(v) if isinstance(v, Decimal) else v for k, v in r.items()} for r in rows]


def test_staging(built, rows):
    staged = rows(built["stg_orders"], "order_id")
    assert [r["order_id"] for r in staged] == ["o1", "o2", "o3", "o4", "o6", "o7"]
    first = staged[0]
    assert (first["order_date"], first["order_day_of_week"], first["delivery_days"]) == (dt.date(2024, 1, 6), 6, 1)
    categories = {r["product_id"]: r["product_category"] for r in rows(built["stg_products"])}
    assert categories == {"p1": "telephony", "p2": "telephony", "p3": "unknown"}


def test_fact_leaves_out_cancelled_unknown_and_empty_orders(built, rows):
    fact = numbers(rows(built["fact_daily_metrics"], "metric_date"))
    assert [r["order_count"] for r in fact] == [2, 1]
    assert fact[0]["customer_count"] == 2 and fact[0]["total_revenue"] == 43.75
    assert (fact[0]["avg_order_value"], fact[0]["min_order_value"], fact[0]["max_order_value"]) == (21.88, 7.25, 36.5)
    assert fact[0]["day_of_week"] == 6


def test_order_counts_once_per_category(built, rows):
    found = {r["product_category"]: r for r in numbers(rows(built["metric_by_product"]))}
    assert found["telephony"]["order_count"] == 1 and found["telephony"]["total_revenue"] == 31.5
    assert found["telephony"]["avg_item_value"] == 15.75
    assert found["unknown"]["order_count"] == 2
    assert found["telephony"]["product_category_group"] == "Electronics"


def test_geography_and_payment(built, rows):
    geo = {r["state_code"]: r for r in numbers(rows(built["metric_by_geography"].filter("metric_date = '2024-01-06'")))}
    assert geo["SP"]["region"] == "Southeast" and geo["XX"]["region"] == "Unknown"
    assert geo["SP"]["avg_item_value"] == 12.17
    pay = numbers(rows(built["metric_by_payment"], "payment_type"))
    assert [(r["payment_type"], r["payment_type_display"], r["total_revenue"]) for r in pay] == [
        ("cash", "Other", 3.0),
        ("credit_card", "Credit Card", 36.5),
    ]


def test_order_loaded_twice_counts_once_with_both_amounts(raw, rows):
    twice = {**raw, "orders": raw["orders"].unionByName(raw["orders"])}
    marts = mt.build_marts(twice)
    fact = numbers(rows(marts["fact_daily_metrics"], "metric_date"))[0]
    assert (fact["order_count"], fact["total_revenue"]) == (2, 87.5)
    pay = numbers(rows(marts["metric_by_payment"].filter("payment_type = 'credit_card'")))[0]
    assert (pay["order_count"], pay["total_revenue"], pay["avg_order_value"]) == (1, 73.0, 36.5)


def test_repeated_primary_payments_multiply_like_a_join(raw, rows):
    again = raw["payments"].filter("order_id = 'o1' AND payment_sequential = 1")
    marts = mt.build_marts({**raw, "payments": raw["payments"].unionByName(again)})
    pay = numbers(rows(marts["metric_by_payment"].filter("payment_type = 'credit_card'")))[0]
    assert (pay["order_count"], pay["total_revenue"], pay["avg_order_value"]) == (1, 73.0, 36.5)


def test_stored_build_equals_the_lazy_one(raw, built, rows, base):
    stored = mt.build_marts(raw, store_under(base))
    for name in ("fact_daily_metrics", "metric_by_geography", "metric_by_product", "metric_by_payment"):
        order_by = built[name].columns[:2]
        assert rows(stored[name], *order_by) == rows(built[name], *order_by)


@pytest.mark.parametrize("kind, total", [("decimal(10,2)", "0.87"), ("decimal(12,4)", "0.8700"), ("double", 0.87)])
def test_line_totals_are_exact_for_every_type(spark, kind, total):
    lines = spark.createDataFrame([("0.29",)] * 3 + [(None,)], "v string").select(F.col("v").cast(kind).alias("v"))
    found = lines.agg(mt.line_total(lines, "v")).first()[0]
    assert found == (pytest.approx(total) if kind == "double" else Decimal(total))
    assert lines.filter("v IS NULL").agg(mt.line_total(lines, "v")).first()[0] is None


def test_lowest_row_per_key(spark, rows):
    data = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, n int, v string")
    assert rows(mt.lowest_per_key(data, "k", ["n"]), "k") == [
        {"k": "a", "n": 1, "v": "y"},
        {"k": "b", "n": 3, "v": "z"},
    ]


def test_salted_join_equals_the_plain_join_with_many_hot_keys(spark, rows):
    facts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 300).otherwise(F.col("id") % 500).cast("long").alias("k"),
        F.col("id").alias("row"),
    )
    lookup = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("label"))
    for how in ("inner", "left"):
        salted = skew.salted_lookup_join(facts, lookup, "k", ["row"], how)
        plain = facts.join(lookup, "k", how)
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_orders_and_customers_loaded_twice_count_once(spark, rows):
    day = dt.date(2024, 1, 1)
    orders = spark.createDataFrame(
        [("o1", day, "c1", "delivered"), ("o1", day, "c1", "shipped"), ("o2", day, "c1", "delivered"), ("o3", day, "c2", "delivered"), ("o3", day, "c1", "delivered")],
        "order_id string, order_date date, customer_id string, order_status string",
    )
    items = spark.createDataFrame([("o1", 10), ("o2", 5), ("o3", 1)], "order_id string, v int").select(
        "order_id", F.col("v").cast("decimal(11,2)").alias("total_item_value")
    )
    customers = spark.createDataFrame([("c1", "SP"), ("c1", "SP"), ("c2", "RJ")], "customer_id string, customer_state string")
    revenue = mt.order_revenue(orders, items)
    days, shared = mt.customer_days(revenue), mt.shared_orders(revenue)
    fact = rows(mt.fact_daily_metrics(days))[0]
    assert (fact["order_count"], fact["customer_count"], float(fact["total_revenue"])) == (3, 2, 27.0)
    geography = spark.createDataFrame([("SP", "South"), ("RJ", "East")], "state_code string, region string")
    found = {r["state_code"]: r for r in rows(mt.metric_by_geography(days, shared, customers, geography))}
    assert found["SP"]["order_count"] == 3 and float(found["SP"]["total_revenue"]) == 52.0
    assert found["RJ"]["order_count"] == 1 and float(found["RJ"]["total_revenue"]) == 1.0


def test_an_order_of_two_customers_of_one_state_is_one_order_there(spark, rows):
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    orders = spark.createDataFrame(
        [
            ("o1", first, "c1", "delivered"),
            ("o1", first, "c2", "delivered"),
            ("o1", second, "c1", "delivered"),
            ("o2", first, "c1", "delivered"),
            ("o2", first, "c2", "shipped"),
            ("o2", first, "c3", "shipped"),
            ("o2", first, None, "shipped"),
            ("o3", first, "c2", "delivered"),
        ],
        "order_id string, order_date date, customer_id string, order_status string",
    )
    items = spark.createDataFrame([("o1", 10), ("o2", 5), ("o3", 1)], "order_id string, v int").select(
        "order_id", F.col("v").cast("decimal(11,2)").alias("total_item_value")
    )
    # c2 was loaded for two states, c3 twice for one
    customers = spark.createDataFrame(
        [("c1", "SP"), ("c2", "SP"), ("c2", "RJ"), ("c3", "RJ"), ("c3", "RJ")], "customer_id string, customer_state string"
    )
    geography = spark.createDataFrame([("SP", "South"), ("RJ", "East")], "state_code string, region string")
    revenue = mt.order_revenue(orders, items)
    built = mt.metric_by_geography(mt.customer_days(revenue), mt.shared_orders(revenue), customers, geography)
    found = {(r["metric_date"], r["state_code"]): r for r in rows(built)}
    lines = (
        orders.join(items, "order_id")
        .join(customers, "customer_id")
        .groupBy("order_date", "customer_state")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("total_item_value").alias("revenue"))
    )
    for r in rows(lines):
        mine = found.pop((r["order_date"], r["customer_state"]))
        assert (mine["order_count"], mine["total_revenue"]) == (r["orders"], r["revenue"])
    assert not found


def test_customers_are_never_built_as_a_broadcast(spark, base):
    # a file of many customers is small, and the optimiser does not count the salted copies
    def stored(name, df):
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    day = F.lit(dt.date(2024, 1, 1))
    orders = stored("orders", spark.range(3000).select(
        F.col("id").alias("order_id"), day.alias("order_date"), (F.col("id") % 1000).alias("customer_id"), F.lit("delivered").alias("order_status")
    ))
    items = stored("items", spark.range(3000).select(F.col("id").alias("order_id"), F.lit(1).cast("decimal(11,2)").alias("total_item_value")))
    customers = stored("customers", spark.range(1000).select(F.col("id").alias("customer_id"), F.lit("SP").alias("customer_state")))
    geography = spark.createDataFrame([("SP", "South")], "state_code string, region string")
    revenue = mt.order_revenue(orders, items)
    built = mt.metric_by_geography(mt.customer_days(revenue), mt.shared_orders(revenue), customers, geography)
    text = built._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in text.splitlines() if "Join [customer_id" in x]
    assert len(joins) == 2 and all("SortMergeJoin" in x for x in joins)
    assert [r["order_count"] for r in built.collect()] == [3000]


def test_quality_suite_has_37_checks_and_finds_faults(built, rows):
    found = {r["check"]: r for r in rows(qa.run_checks(built))}
    assert len(found) == 37
    assert found["unique_stg_orders_order_id"]["status"] == "pass"
    assert found["not_null_stg_customers_customer_state"]["failures"] == 1
    assert found["not_null_stg_customers_customer_state"]["status"] == "fail"


def test_single_checks(spark, rows):
    data = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "a", -1.0), (dt.date(2024, 3, 1), "a", 2.0), (dt.date(2024, 3, 2), None, None)],
        "metric_date date, v string, total_revenue double",
    )
    assert rows(qa.duplicates(data, "v")) == [{"v": "a", "n_records": 2}]
    assert rows(qa.unaccepted(data, "v", ["b"])) == [{"value_field": "a", "n_records": 2}]
    assert len(rows(qa.negative_revenue(data))) == 1
    assert rows(qa.date_gaps(data))[0]["gap_days"] == 60
    checks = [qa.Check("continuous", "t", "metric_date", severity="warn"), qa.Check("not_null", "t", "v", severity="warn")]
    assert {r["status"] for r in rows(qa.run_checks({"t": data}, checks))} == {"warn"}
