import datetime as dt

import pytest
from pyspark.sql import functions as F

from rootlens.operators import decomposition as dec
from rootlens.operators import investigation as inv

NOW, BEFORE = dt.date(2018, 9, 3), dt.date(2018, 8, 29)
PAIR = ("total_revenue", NOW, BEFORE)
KEYS = "metric string, current_date date, previous_date date, "

# The worked example, (dimension, order, segment, current, previous).
SEGMENTS = [
    ("geography", 0, "Southeast", 90, 450), ("geography", 0, "Northeast", 76, 380), ("geography", 0, "South", 34, 170),
    ("product", 1, "Electronics", 440, 500), ("product", 1, "Books", 93, 100),
    ("payment", 2, "Credit Card", 750, 1500), ("payment", 2, "Boleto", 350, 400), ("payment", 2, "Voucher", 200, 100),
]
DETAIL = [("Southeast", "SP", 80, 400), ("Southeast", "RJ", 10, 50), ("Northeast", "BA", 76, 380), ("South", "RS", 34, 170)]


@pytest.fixture(scope="module")
def example(spark):
    compared = spark.createDataFrame(
        [(*PAIR, d, o, s, float(c), float(p)) for d, o, s, c, p in SEGMENTS],
        KEYS + "dimension string, dim_order int, segment string, current_value double, previous_value double",
    )
    detail = [
        (day, "geography", 0, s, d, "total_revenue", float(v))
        for s, d, c, p in DETAIL
        for day, v in ((NOW, c), (BEFORE, p))
    ]
    slices = spark.createDataFrame(
        detail,
        "metric_date date, dimension string, dim_order int, segment string, detail string, metric string, value double",
    )
    top = dec.strongest(dec.contributions(compared))
    classified = inv.classify_ambiguity(top)
    drilled = dec.drill_down(slices, inv.plan_drill(classified))
    return {
        "top": top,
        "totals": dec.dimension_totals(compared),
        "classified": classified,
        "drilled": drilled,
        "evidence": inv.evidence_rows(top, drilled),
    }


def shares(spark, values):
    data = [
        (*PAIR, "d", 0, f"s{i}", float(v), abs(float(v)), i + 1) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        data,
        KEYS + "dimension string, dim_order int, segment string, contribution_pct double, abs_contribution double, rank int",
    )


@pytest.mark.parametrize(
    "values, reason",
    [
        ([80, 20], None),
        ([45, 38], "close_contributors"),
        ([107.1, 7.1, -14.3], "offsetting_segments"),
        ([-10, 90], "offsetting_segments"),
        ([107, 100], "offsetting_segments"),
        ([55, 40], "close_contributors"),
        ([100], None),
        ([100, 0], None),
    ],
)
def test_ambiguity_rule(spark, rows, values, reason):
    assert rows(inv.classify_ambiguity(shares(spark, values)))[0]["reason"] == reason


def test_no_contributors_no_verdict(spark, rows):
    assert rows(inv.classify_ambiguity(shares(spark, [1]).filter("1 = 0"))) == []


def test_example_is_classified_and_drilled(example, rows):
    reasons = {r["dimension"]: r["reason"] for r in rows(example["classified"])}
    assert reasons == {
        "geography": "close_contributors",
        "product": None,
        "payment": "offsetting_segments",
    }
    inner = {r["segment"]: r["contribution_pct"] for r in rows(example["drilled"])}
    assert inner == {"SP": 88.89, "RJ": 11.11}


def test_drill_plan_respects_rounds_and_history(example, rows):
    classified = example["classified"]
    assert [r["segment"] for r in rows(inv.plan_drill(classified))] == ["Southeast"]
    assert rows(inv.plan_drill(classified, iteration=2)) == []
    done = classified.filter("dimension = 'geography'").select(*dec.PAIR, "dimension")
    assert rows(inv.plan_drill(classified, done)) == []


@pytest.mark.parametrize("count, force, go", [(0, False, False), (0, True, True), (2, False, True)])
def test_gate(spark, rows, count, force, go):
    stats = spark.createDataFrame([("m", count)], "metric string, anomaly_count bigint")
    gate = rows(inv.investigation_gate(stats, force))[0]
    assert gate["proceed"] is go
    assert gate["status"] == (None if go else "skipped_no_anomaly")
    assert gate["next_step"] == ("decompose_all" if go else "finalize_skip")


def cite(spark, *citations):
    return spark.createDataFrame(
        [(*PAIR, i, d, s, src, "the MAIN driver") for i, (d, s, src) in enumerate(citations)],
        KEYS + "position int, dimension string, segment string, source string, claim string",
    )


def note(spark, text):
    return spark.createDataFrame([(*PAIR, text)], KEYS + "uncertainty_note string")


def errors(spark, rows, example, citations, text="moved apart"):
    frame = inv.citation_errors(
        cite(spark, *citations), example["evidence"], example["classified"], note(spark, text)
    )
    return [r["error"] for r in rows(frame, "position")]


def test_citations_must_match_source_dimension_and_segment(spark, rows, example):
    good = [("geography", "SP", "drill_down"), ("geography", "Southeast", "decomposition")]
    assert errors(spark, rows, example, good) == []
    bad = errors(
        spark,
        rows,
        example,
        [
            ("geography", "Atlantis", "decomposition"),
            ("geography", "SP", "decomposition"),
            ("payment", "Southeast", "decomposition"),
            ("payment", "SP", "drill_down"),
        ],
    )
    assert bad[0] == (
        "'Atlantis' is not a valid segment for 'geography' (source=decomposition); "
        "valid segments are: Northeast, South, Southeast"
    )
    assert len(bad) == 4 and bad[3].endswith("valid segments are: (none)")


@pytest.mark.parametrize("text", [None, ""])
def test_offsetting_dimension_needs_a_note(spark, rows, example, text):
    found = errors(spark, rows, example, [("geography", "SP", "drill_down")], text)
    assert len(found) == 1 and found[0].startswith("uncertainty_note is required")


def test_rendered_summary_takes_numbers_from_evidence(spark, rows, example):
    citations = cite(
        spark,
        ("geography", "SP", "drill_down"),
        ("geography", "Southeast", "decomposition"),
        ("payment", "Credit Card", "decomposition"),
    )
    text = rows(inv.render_summary(citations, example["evidence"], note(spark, "no clean driver")))[0]
    assert text["investigation_summary"] == (
        "The main driver: **SP** (Geography) contributed **88.89%** of the change ($400.00 -> $80.00).\n"
        "\nContributing factors:\n- the MAIN driver: Southeast (45.0%)\n- the MAIN driver: Credit Card (107.14%)\n"
        "\n\n\nwarning: no clean driver"
    )
    alone = inv.render_summary(cite(spark, ("geography", "SP", "drill_down")), example["evidence"], note(spark, None))
    assert rows(alone)[0]["investigation_summary"].endswith("($400.00 -> $80.00).")


def test_fallback_is_used_when_a_citation_fails(spark, rows, example):
    drivers = dec.top_driver(example["top"])
    fallback = inv.fallback_summary(drivers)
    expected = "The primary driver was Credit Card (payment), contributing 107.1% of the change (-50.0% change)."
    assert rows(fallback)[0]["investigation_summary"] == expected
    citations = cite(spark, ("geography", "Atlantis", "decomposition"))
    bad = inv.citation_errors(citations, example["evidence"], example["classified"], note(spark, "x"))
    rendered = inv.render_summary(citations, example["evidence"], note(spark, "x"))
    pairs = citations.select(*dec.PAIR)
    result = rows(inv.synthesize(rendered, bad, fallback, pairs))[0]
    assert result["grounding_failed"] and result["investigation_summary"] == expected
    kept = rows(inv.synthesize(fallback, bad.filter("1 = 0"), fallback, pairs))[0]
    assert not kept["grounding_failed"]


def test_evidence_sheet(spark, rows, example):
    day = dt.date(2018, 8, 15)
    history = spark.createDataFrame(
        [("total_revenue", NOW, day, "low", -22.0)],
        "metric string, current_date date, metric_date date, anomaly_direction string, change_pct double",
    )
    sheet = rows(
        inv.evidence_text(
            example["top"], example["totals"], example["classified"], example["drilled"], history
        )
    )[0]["evidence"].split("\n\n")
    assert sheet[0] == (
        "Geography -- ambiguous, reason: close_contributors\n"
        "  total_change: -800.0, total_change_pct: -80.0%\n"
        "    Southeast: change -360.0, contribution_pct 45.0%\n"
        "    Northeast: change -304.0, contribution_pct 38.0%\n"
        "    South: change -136.0, contribution_pct 17.0%\n"
        "  >>> geography was drilled down because it was ambiguous at the level above. "
        "Use THIS breakdown, not 'Southeast' above, to name the primary driver within geography:\n"
        "      SP (source='drill_down', dimension='geography'): change -320.0, contribution_pct 88.89%\n"
        "      RJ (source='drill_down', dimension='geography'): change -40.0, contribution_pct 11.11%"
    )
    assert sheet[1].startswith("Product\n") and len(sheet) == 4
    assert sheet[3].endswith("\n    2018-08-15: low, -22.0% change")


@pytest.mark.parametrize(
    "outcomes, expected",
    [
        (["grounded_first_attempt"] * 4, (1.0, 0.0)),
        (["grounded_first_attempt", "grounded_after_retry"], (0.5, 0.0)),
        (["grounded_first_attempt", "fallback_validation_failed", "fallback_exception"], (1 / 3, 2 / 3)),
        ([], (0.0, 0.0)),
    ],
)
def test_grounding_rates(spark, rows, outcomes, expected):
    trials = spark.createDataFrame(
        [(o, not o.startswith("fallback"), True) for o in outcomes],
        "outcome string, golden_match boolean, uncertainty_ok boolean",
    )
    rates = rows(inv.grounding_rates(trials))[0]
    assert (rates["grounding_pass_rate"], rates["fallback_rate"]) == pytest.approx(expected)
    assert rates["uncertainty_ok_rate"] == (1.0 if outcomes else 0.0)
    fallbacks = sum(o.startswith("fallback") for o in outcomes)
    matched = (len(outcomes) - fallbacks) / len(outcomes) if outcomes else 0.0
    assert rates["golden_match_rate"] == pytest.approx(matched)


def test_drilled_targets_without_rows_stay_visible(spark, rows, example):
    targets = inv.plan_drill(example["classified"]).withColumn("segment", F.lit("Nowhere"))
    totals = rows(dec.drill_totals(targets, example["drilled"]))
    assert totals[0]["total_current"] == 0 and totals[0]["segment_count"] == 0
