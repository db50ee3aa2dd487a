import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rootlens.operators import classification as cls
from rootlens.operators import profiling as prof
from rootlens.operators import rollup as ru
from rootlens.plans import onboarding as onb

PLANS = {"Starter": 29, "Growth": 99, "Enterprise": 299}


@pytest.fixture(scope="module")
def saas(spark):
    """A subscriptions table of 500 rows over 40 days."""
    rng = random.Random(42)
    days = [str(dt.date(2026, 1, 1) + dt.timedelta(days=i)) for i in range(40)]
    notes = ["upgrade", "billing", "churn", "renewed", "downgrade", "support"]
    data = []
    for i in range(500):
        plan = rng.choice(list(PLANS))
        data.append(
            (
                f"SUB{i}",
                rng.choice(days),
                f"CUST{rng.randrange(80)}",
                plan,
                rng.choice(["NA", "EMEA", "APAC"]),
                float(PLANS[plan] + rng.randint(-5, 5)),
                rng.randint(1, 49),
                None if rng.random() < 0.4 else rng.choice(notes),
            )
        )
    schema = (
        "subscription_id string, event_date string, customer_id string, plan_type string, "
        "region string, mrr_amount double, seats int, notes string"
    )
    return spark.createDataFrame(data, schema)


def profile(rows, df):
    return {r["name"]: r for r in rows(prof.profile_columns(df))}


def test_profile_rules(spark, rows):
    data = [(i, f"id{i}", float(i), "abc"[i % 3], None if i > 7 else "x", dt.datetime(2024, 1, 1 + i), i % 2 == 0) for i in range(20)]
    schema = "n int, key string, amount double, kind string, rare string, seen timestamp, flag boolean"
    found = profile(rows, spark.createDataFrame(data, schema))
    assert found["n"]["is_likely_id"] and found["key"]["is_likely_id"]
    assert not found["amount"]["is_likely_id"] and found["amount"]["is_numeric"]
    assert found["kind"]["cardinality_ratio"] == 0.15
    assert found["rare"]["null_rate"] == pytest.approx(0.6)
    assert found["seen"]["date_parse_rate"] == 1.0 and found["amount"]["date_parse_rate"] == 0.0
    assert found["flag"]["is_numeric"] and found["seen"]["day_cardinality"] == 20


def test_profile_of_special_values(spark, rows):
    data = [(0.0, "x" * 100), (-0.0, "x" * 99 + "y"), (float("nan"), "x" * 100), (None, None)]
    found = profile(rows, spark.createDataFrame(data, "v double, t string"))
    assert (found["v"]["cardinality"], found["v"]["null_rate"]) == (1, 0.5)
    assert found["t"]["cardinality"] == 2
    empty = profile(rows, spark.createDataFrame([], "a string, b int"))
    assert empty["a"]["cardinality_ratio"] == 0.0 and empty["b"]["null_rate"] == 0.0


def test_profile_counts_match_plain_counts(saas, rows):
    found = profile(rows, saas)
    plain = saas.agg(*[F.count_distinct(c).alias(c) for c in saas.columns]).first().asDict()
    assert {c: found[c]["cardinality"] for c in saas.columns} == plain


def test_samples_follow_the_given_order(spark, rows):
    data = spark.createDataFrame([(i, None if i == 2 else i * 10) for i in range(10, 0, -1)], "at int, v int")
    found = {r["name"]: r["sample_values"] for r in rows(prof.sample_values(data, ["at"]))}
    assert found["v"] == ["10", "30", "40", "50", "60"]


def test_date_rates_sampled_and_full(spark, rows):
    data = spark.createDataFrame(
        [(i, "2024-01-01" if i < 1000 else "soon") for i in range(2000)], "at int, d string"
    )
    sampled = {r["name"]: r["date_parse_rate"] for r in rows(prof.sampled_date_rates(data, ["at"]))}
    assert sampled == {"at": 0.0, "d": 1.0}
    assert profile(rows, data)["d"]["date_parse_rate"] == 0.5


def test_example_gets_the_expected_roles(saas, rows, spark):
    profiles = prof.profile_columns(saas)
    roles = cls.assign_roles(profiles)
    expected = {
        "event_date": "date", "mrr_amount": "metric", "seats": "metric", "plan_type": "dimension",
        "region": "dimension", "subscription_id": "rejected", "customer_id": "rejected", "notes": "rejected",
    }
    assert {r["column"]: r["role"] for r in rows(roles)} == expected
    wanted = spark.createDataFrame(list(expected.items()), "column string, role string")
    assert all(r["matches"] for r in rows(cls.role_matches(roles, wanted)))
    wrong = wanted.withColumn("role", F.when(F.col("column") == "seats", "rejected").otherwise(F.col("role")))
    counts = {r["role"]: (r["missing"], r["extra"]) for r in rows(cls.role_matches(roles, wrong))}
    assert counts["metric"] == (0, 1) and counts["rejected"] == (1, 0)
    header = rows(cls.classification_header(roles, profiles))[0]
    assert (header["date_column"], header["grain"], header["requires_human_review"]) == ("event_date", "other", False)
    assert len(rows(cls.review_report(roles, profiles))) == 8


PROFILES = [
    ("event_date", 0.008, 0.0, 0.998, False, False),
    ("mrr_amount", 0.9, 0.0, 0.0, True, False),
    ("region", 0.00006, 0.0, 0.0, False, False),
    ("customer_id", 0.164, 0.0, 0.0, False, False),
    ("notes", 0.012, 0.4, 0.1, False, False),
]


def validated(spark, rows, *roles):
    profiles = spark.createDataFrame(
        PROFILES,
        "name string, cardinality_ratio double, null_rate double, date_parse_rate double, is_numeric boolean, is_likely_id boolean",
    )
    proposed = spark.createDataFrame(list(roles), "column string, role string")
    return sorted(r["error"] for r in rows(cls.validate_roles(proposed, profiles)))


def test_role_validation(spark, rows):
    assert validated(spark, rows, ("event_date", "date"), ("mrr_amount", "metric"), ("region", "dimension")) == []
    assert validated(spark, rows, ("region", "rejected"), ("ghost", "rejected")) == []
    assert validated(
        spark, rows, ("notes", "date"), ("region", "metric"), ("customer_id", "dimension"), ("ghost", "metric")
    ) == [
        "'customer_id' proposed as a dimension but cardinality ratio 0.16 suggests an identifier, not a category",
        "'ghost' proposed as a metric but is not a real column",
        "'notes' proposed as date_column but only 10% parses as a date",
        "'region' proposed as a metric but is not numeric",
    ]


def test_overrides_move_columns_and_clear_the_date(saas, spark, rows):
    profiles = prof.profile_columns(saas)
    moves = spark.createDataFrame(
        [("event_date", "reject"), ("notes", " Dimension "), ("seats", "banana"), ("ghost", "metric")],
        "column string, new_role string",
    )
    moved = cls.apply_overrides(cls.assign_roles(profiles), moves)
    found = {r["column"]: (r["role"], r["reason"]) for r in rows(moved)}
    assert found["event_date"] == ("rejected", "Manually rejected by user")
    assert found["notes"] == ("dimension", "Manually assigned by user")
    assert found["seats"][0] == "metric" and "ghost" not in found
    header = cls.classification_header(moved, profiles)
    assert rows(header)[0]["date_column"] is None
    with pytest.raises(ValueError, match="no date column"):
        cls.collect_roles(cls.confirmed_roles(moved, header))


def fingerprint(spark, *pairs):
    frame = spark.createDataFrame(list(pairs), "name string, dtype string")
    return prof.schema_fingerprint(frame).first()["fingerprint"]


def test_fingerprint_ignores_order_and_sees_every_change(spark):
    base = fingerprint(spark, ("a", "int"), ("b", "string"))
    assert base == fingerprint(spark, ("b", "string"), ("a", "int"))
    others = [
        fingerprint(spark, ("a", "int"), ("c", "string")),
        fingerprint(spark, ("a", "double"), ("b", "string")),
        fingerprint(spark, ("a", "int"), ("b", "string"), ("c", "int")),
        fingerprint(spark, ("a", "int")),
    ]
    assert len({base, *others}) == 5


ROLES = cls.Roles("event_date", "other", ("mrr_amount", "seats"), ("plan_type",))


def sales(spark, *data):
    return spark.createDataFrame(list(data), "event_date string, plan_type string, mrr_amount double, seats int")


def test_daily_rollup_sums_counts_and_drops_bad_dates(spark, rows):
    df = sales(
        spark, ("2026-01-01", "Starter", 29.0, 1), ("1/1/2026", "Growth", 99.0, 5), ("2026-01-02", "Starter", None, 2),
        ("not a date", "Starter", 40.0, 9),
    )
    dated = ru.dated_rows(df, "event_date")
    fact = rows(ru.daily_fact(dated, ROLES), "metric_date")
    assert [(r["mrr_amount"], r["seats"], r["row_count"]) for r in fact] == [(128.0, 6, 2), (0.0, 2, 1)]
    assert rows(ru.unparsed_rows(dated)) == [{"n_rows": 4, "dropped_rows": 1}]
    split = {(str(r["metric_date"]), r["segment"]): r["mrr_amount"] for r in rows(ru.dimension_rollup(dated, ROLES))}
    assert split == {("2026-01-01", "Starter"): 29.0, ("2026-01-01", "Growth"): 99.0, ("2026-01-02", "Starter"): 0.0}


def test_daily_tables_pass_through(spark, rows):
    daily = cls.Roles("event_date", "daily", ("mrr_amount",), ("plan_type",))
    df = sales(spark, ("2026-01-01", "a", 1.0, 1), ("2026-01-01", "b", 2.0, 1))
    fact = rows(ru.daily_fact(ru.dated_rows(df, "event_date"), daily), "mrr_amount")
    assert [(r["mrr_amount"], r["row_count"]) for r in fact] == [(1.0, 1), (2.0, 1)]


def test_reconciliation_reports_nulls_wrong_values_and_missing_dates(spark, rows):
    clean = sales(spark, ("2026-01-01", "a", 29.0, 1), ("2026-01-01", "b", 99.0, 1))
    dirty = clean.unionByName(sales(spark, ("2026-01-02", None, 5.0, 1)))

    def failures(df, **options):
        dated = ru.dated_rows(df, "event_date")
        rollup = ru.dimension_rollup(dated, ROLES, **options)
        return rows(ru.reconciliation_errors(ru.reconcile(ru.daily_fact(dated, ROLES), rollup, ["plan_type"], ["mrr_amount"])))

    assert failures(clean) == []
    assert failures(dirty)[0]["error"].startswith("plan_type: per-date totals don't reconcile")
    assert failures(dirty, null_segment="(null)") == []
    dated = ru.dated_rows(clean, "event_date")
    rollup = ru.dimension_rollup(dated, ROLES)
    broken = rollup.withColumn("mrr_amount", F.lit(999.0))
    both = rollup.unionByName(broken.withColumn("dimension", F.lit("other")))
    found = ru.reconcile(ru.daily_fact(dated, ROLES), both, ["plan_type", "other"], ["mrr_amount"])
    assert [r["dimension"] for r in rows(ru.reconciliation_errors(found))] == ["other"]


def test_onboard_then_reuse_then_analyse(saas, spark, rows, base):
    renamed = saas.withColumnRenamed("plan_type", "Plan Type").withColumnRenamed("mrr_amount", "MRR Amount")
    first = onb.onboard(renamed, "saas", base)
    assert not first.reused and sorted(first.tables) == ["fact_daily_metrics", "metric_by_plan_type", "metric_by_region"]
    assert first.spec.metrics == ("mrr_amount", "seats", "row_count")
    assert [d.name for d in first.spec.dimensions] == ["Plan Type", "region"]
    assert rows(onb.dropped_rows(renamed, first)) == [{"n_rows": 500, "dropped_rows": 0}]
    second = onb.onboard(renamed, "saas", base)
    assert second.reused and second.spec == first.spec
    def edits(*rows):
        return spark.createDataFrame(rows, "column string, new_role string")

    third = onb.onboard(renamed, "saas", base, overrides=edits(("seats", "reject")))
    assert third.reused and third.spec.metrics == ("mrr_amount", "row_count")
    assert onb.onboard(renamed, "saas", base).spec == third.spec
    doubted = onb.onboard(renamed, "saas", base, overrides=edits(("customer_id", "dimension")))
    assert doubted.requires_human_review and "customer_id" in doubted.warnings[0]
    # edits that leave no date are refused and change nothing
    with pytest.raises(ValueError, match="no date column"):
        onb.onboard(renamed, "saas", base, overrides=edits(("event_date", "reject")))
    again = onb.load_dataset(spark, "saas", base)
    assert again.requires_human_review and again.spec == doubted.spec
    changed = onb.onboard(renamed.withColumn("seats", F.col("seats").cast("bigint")), "saas", base)
    assert not changed.reused

    done = onb.load_dataset(spark, "saas", base)
    run = onb.run_cycle(done, "mrr_amount", "2026-02-10 08:00:00", force_alert=True, run_investigation=True)
    report = rows(run.report)[0]
    assert report["status"] == "completed" and report["summary"].startswith("Mrr Amount ")
    counted = rows(onb.run_cycle(done, "row_count", "2026-02-10 08:00:00").report)[0]
    assert counted["status"] == "completed"
    assert rows(run.investigation)[0]["status"] == "completed"


def test_onboarding_stops_when_tables_disagree(saas, base):
    holed = saas.withColumn("region", F.when(F.col("seats") != 3, F.col("region")))
    with pytest.raises(onb.ReconciliationError, match="region"):
        onb.onboard(holed, "holed", base)


def test_a_daily_table_that_becomes_transactions(spark, rows, base):
    def days(n):
        data = [(dt.date(2024, 1, 1) + dt.timedelta(days=i % n), 2.5, "a") for i in range(100)]
        return spark.createDataFrame(data, "day date, amount double, kind string")

    first, second = onb.onboard(days(100), "d", base), onb.onboard(days(5), "d", base)
    assert (first.grain, second.grain, second.reused) == ("daily", "other", True)
    fact = rows(second.tables["fact_daily_metrics"], "metric_date")
    assert [(r["amount"], r["row_count"]) for r in fact] == [(50.0, 20)] * 5


def test_long_date_texts_are_still_dates(spark, rows):
    data = spark.createDataFrame([("2024-01-01 and then a note that is much longer than any date, " + "x" * 40,)] * 4, "d string")
    pattern = "yyyy-MM-dd' and then a note that is much longer than any date, " + "x" * 40 + "'"
    assert rows(prof.profile_columns(data, [pattern]))[0]["date_parse_rate"] == 1.0


def test_samples_of_many_columns_take_one_scan(spark, base):
    spark.range(9).selectExpr(*[f"id + {i} AS c{i}" for i in range(20)]).write.parquet(f"{base}/wide")
    wide = spark.read.parquet(f"{base}/wide")
    for df in (prof.sample_values(wide, ["c0"]), prof.sampled_date_rates(wide.selectExpr("c0", "string(c1) AS s", "string(c2) AS t"), ["c0"])):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_unknown_dataset(spark, base):
    with pytest.raises(FileNotFoundError):
        onb.load_dataset(spark, "nobody", base)


def test_joined_places_are_read_from_one_table(spark, monkeypatch, tmp_path):
    from rootlens.plans import catalog

    given = {
        "orders": ([(1, 7, dt.datetime(2024, 1, 1), 2.5, "F")], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderstatus string"),
        "customer": ([(7, 3, "TOYS")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(3, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "AMERICA")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    seen = []
    monkeypatch.setattr(catalog.onb, "onboard", lambda df, *a, **k: seen.append(df))
    catalog._onboarded_places(spark, str(tmp_path))
    text = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "Relation" in text
    assert seen[0].collect() == catalog._placed(spark, str(tmp_path)).collect()
