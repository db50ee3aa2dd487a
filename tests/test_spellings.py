import datetime as dt

import pytest
from pyspark.sql import functions as F

from rootlens.functions import scalars as sc
from rootlens.operators import profiling as prof
from rootlens.operators import spellings as sp
from rootlens.plans import onboarding as onb

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(40)]


def written(spark, form, days=DAYS, extra=()):
    rows = [(d.strftime(form) if d else None,) for d in days] + [(x,) for x in extra]
    return spark.createDataFrame(rows, "d string")


@pytest.mark.parametrize(
    "form, order, doubt",
    [("%d/%m/%Y", sp.DAY_FIRST, False), ("%m/%d/%Y", sp.MONTH_FIRST, False), ("%d.%m.%Y", sp.DAY_FIRST, False), ("%Y-%m-%d", sp.MONTH_FIRST, False)],
)
def test_the_order_that_reads_more_holds(spark, rows, form, order, doubt):
    found = rows(sp.date_orders(written(spark, form, extra=["n/a", None, ""])))
    assert [(r["filled"], r["date_order"], r["in_doubt"]) for r in found] == [(41, order, doubt)]


def test_doubt_where_no_day_is_above_twelve(spark, rows):
    low = [dt.date(2024, m, 3) for m in range(1, 13)]
    assert rows(sp.date_orders(written(spark, "%d/%m/%Y", low)))[0]["in_doubt"]
    same = [dt.date(2024, m, m) for m in range(1, 13)]
    assert not rows(sp.date_orders(written(spark, "%d/%m/%Y", same)))[0]["in_doubt"]
    assert rows(sp.date_orders(spark.createDataFrame([("x", 1)], "a string, n int"))) == []
    assert rows(sp.date_orders(spark.createDataFrame([(1,)], "n int"))) == []


def test_the_tally_counts_every_spelling(spark, rows):
    df = spark.createDataFrame([("2024-01-05",), ("1/5/2024",), ("25/12/2024",), ("5 Jan 2024",), ("no",), (None,)], "d string")
    found = {r["spelling"]: r["parsed"] for r in rows(sp.spelling_tally(df))}
    wanted = {"ISO 8601": 1, "M/d/yyyy": 1, "d/M/yyyy": 2, "d MMM yyyy": 1}
    assert {k: v for k, v in found.items() if v} == wanted


def test_shapes_match_what_formats_read(spark):
    moments = spark.createDataFrame([(dt.datetime(2024, 9, 30, 23, 59, 58),), (dt.datetime(1999, 1, 2, 3, 4, 5),)], "t timestamp")
    odd = spark.createDataFrame([(x,) for x in ("+12024/1/2", "1/2/12345", "-2024/1/2", "1 may 2024", "MAY 1, 2024", "2024/1/2 ")], "text string")
    forms = dict.fromkeys([*sc.DATE_FORMATS, *sc.DAY_FIRST_FORMATS])
    read = {f: F.try_to_timestamp(F.trim("text"), F.lit(f)).isNotNull() for f in forms}
    texts = moments.select(F.explode(F.array(*[F.date_format("t", f) for f in forms])).alias("text")).unionByName(odd)
    missed = [F.count_if(r & ~F.trim("text").rlike(sc.format_shape(f))).alias(f"`{f}`") for f, r in read.items()]
    assert set(texts.agg(*missed).first()) == {0}
    assert texts.filter(sc.may_be_date(F.col("text"), list(forms))).count() >= 2 * len(forms)


def test_formats_with_other_letters_have_no_shape():
    assert sc.format_shape("yyyy-MM-dd'T'HH:mm") is None and sc.format_shape("h:mm a") is None


def test_day_first_files_are_onboarded_and_rejects_reported(spark, rows, base):
    days = [(DAYS[i % 40].strftime("%d/%m/%Y"), float(i), "ab"[i % 2]) for i in range(400)]
    days += [("soon", 1.0, "a"), (None, 2.0, "b"), ("  ", 3.0, "b")]
    df = spark.createDataFrame(days, "bought string, amount double, kind string")
    done = onb.onboard(df, "d", base)
    fact = rows(done.tables["fact_daily_metrics"], "metric_date")
    assert [r["metric_date"] for r in fact] == DAYS and sum(r["row_count"] for r in fact) == 400
    assert done.dropped_rows == 3 and not done.requires_human_review
    reasons = sorted(r["reject_reason"] for r in rows(done.rejected))
    assert reasons == ["no date", "no date", "unreadable date: soon"]
    again = onb.onboard(df, "d", base)
    assert again.reused and again.dropped_rows == 3


def test_a_doubtful_date_column_asks_for_review(spark, base):
    days = [(f"{1 + i % 12}/{1 + i % 5}/2024", float(i), "ab"[i % 2]) for i in range(300)]
    done = onb.onboard(spark.createDataFrame(days, "bought string, amount double, kind string"), "d", base)
    assert done.requires_human_review and "cannot be told apart" in done.warnings[-1]


def wide(spark, n):
    return spark.range(n).select(
        "id",
        (F.col("id") % 1000).cast("string").alias("code"),
        (F.col("id") / 8).alias("amount"),
        F.col("id").cast("decimal(12,2)").alias("price"),
        F.expr("date_add(date'2020-01-01', int(id % 500))").alias("day"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 7)").alias("at"),
        F.when(F.col("id") % 4 > 0, F.expr("date_format(date_add(date'2020-01-01', int(id % 300)), 'M/d/yyyy')")).alias("seen"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.lit(None).cast("string").alias("nothing"),
    )


COUNTS = ("n_rows", "cardinality", "null_rate", "date_parse_rate", "day_cardinality")


def test_exact_profile_equals_count_distinct(spark, rows):
    df = wide(spark, 5000)
    found = {r["name"]: r for r in rows(prof.profile_columns(df))}
    for name in df.columns:
        assert found[name]["cardinality"] == df.agg(F.count_distinct(name)).first()[0], name
    assert [found[c]["day_cardinality"] for c in ("day", "seen", "at", "id")] == [500, 225, 1, 0]
    assert found["seen"]["null_rate"] == 0.25 and found["seen"]["date_parse_rate"] == 1.0


def test_sketches_are_close_and_merge(spark, rows):
    df = wide(spark, 60_000)
    exact = {r["name"]: r for r in rows(prof.profile_columns(df))}
    parts = [prof.column_sketches(df.filter(F.col("id") % 3 == i)) for i in range(3)]
    for sketched in (prof.profile_columns(df, sketches=True), prof.profile_columns(df, sketches=prof.merged_sketches(*parts))):
        for r in rows(sketched):
            e = exact[r["name"]]
            assert (r["n_rows"], r["null_rate"], r["date_parse_rate"]) == tuple(e[c] for c in ("n_rows", "null_rate", "date_parse_rate"))
            for c in ("cardinality", "day_cardinality"):
                assert abs(r[c] - e[c]) <= 0.05 * e[c], (r["name"], c)


def test_sketches_shuffle_no_values(spark):
    plan = prof.column_sketches(wide(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning" not in plan


def test_long_texts_travel_as_digests(spark):
    counted = prof.value_counts(spark.createDataFrame([("x" * 500, "1/2/2024")], "long string, day string"))
    found = {r["position"]: r for r in counted.collect()}
    assert found[0]["text"] is None and len(found[0]["digest"]) == 16
    assert found[1]["text"] == "1/2/2024" and found[1]["digest"] is None
