import datetime as dt

import pytest
from pyspark.sql import functions as F

from rootlens.operators import decomposition as dec
from rootlens.operators import narrative as nar

NOW, BEFORE = dt.date(2024, 1, 2), dt.date(2024, 1, 1)
STAMP = "2024-01-02 08:00:00"


def texts(spark, rows, *segments):
    compared = spark.createDataFrame(
        [("total_revenue", NOW, BEFORE, d, o, s, float(c), float(p)) for d, o, s, c, p in segments],
        "metric string, current_date date, previous_date date, dimension string, dim_order int, "
        "segment string, current_value double, previous_value double",
    )
    top = dec.strongest(dec.contributions(compared))
    frame = nar.narratives(dec.dimension_totals(compared), top, dec.top_driver(top), STAMP, "Acme")
    return frame, rows(frame)[0]


GROWTH = [("geography", 0, "Southeast", 520, 400), ("geography", 0, "South", 480, 400), ("payment", 1, "Card", 1000, 800)]


def test_all_formats(spark, rows):
    _, out = texts(spark, rows, *GROWTH[:2])
    assert out["summary"] == (
        "Total Revenue increased 25.0% on 2024-01-02. "
        "Primary driver: Southeast (geography) contributed 60.0% of the change."
    )
    assert out["email_subject"] == "Acme: Total Revenue increase 25.0% on 2024-01-02"
    assert out["full"] == (
        "📊 **Acme Alert: Total Revenue increase**\n\n**2024-01-02** vs **2024-01-01**\n\n"
        "Total Revenue increased **25.0%** ($800.00 → $1,000.00), a change of **$200.00**.\n\n"
        "**Primary Driver:**\nThe increase was primarily driven by **Geography** — specifically **Southeast**, "
        "which accounted for **60.0%** of the total change.\n\n**Breakdown by Dimension:**\n"
        "\n- **Geography**: Top contributor was **Southeast** (60.0% of change)\n"
        "\n\n---\n*Generated by Acme at 2024-01-02 08:00:00*"
    )
    assert out["slack"] == (
        ":chart_with_upwards_trend: *Acme Alert*\n\n*Total Revenue* increased *25.0%* on 2024-01-02\n\n"
        ":mag: *Root Cause:* Southeast (geography) drove 60.0% of the change\n\n"
        ":bar_chart: Breakdown:\n• Geography: Southeast (60.0%)"
    )


def test_breakdown_follows_dimension_order(spark, rows):
    _, out = texts(spark, rows, *reversed(GROWTH))
    assert out["slack"].endswith("• Geography: Southeast (60.0%)\n• Payment: Card (100.0%)")
    assert "Primary driver: Card (payment)" in out["summary"]


def test_no_change_has_no_driver_and_reads_as_decrease(spark, rows):
    _, out = texts(spark, rows, ("geography", 0, "South", 5, 5))
    assert out["summary"] == "Total Revenue decreased 0.0% on 2024-01-02. No single driver stands out."


def test_format_choice(spark, rows):
    frame, _ = texts(spark, rows, *GROWTH)
    assert "email_subject" in nar.pick_format(frame, "email").columns
    assert "full" not in nar.pick_format(frame, "summary").columns
    with pytest.raises(ValueError, match="Unknown format_type"):
        nar.pick_format(frame, "fax")


def test_alert_message_is_plain_and_subject_short(spark, rows):
    frame, _ = texts(spark, rows, *GROWTH)
    long = frame.withColumn("email_subject", F.repeat(F.lit("x"), 120))
    alert = rows(nar.alert_messages(long))[0]
    assert len(alert["subject"]) == 100 and "*" not in alert["message"]


@pytest.mark.parametrize(
    "count, force, dry, channel, status, reason",
    [
        (1, False, False, True, "sent", None),
        (0, False, False, True, "skipped", "no_anomaly"),
        (0, True, True, True, "dry_run", None),
        (2, False, False, False, "skipped", "no_channel"),
    ],
)
def test_alert_status(spark, count, force, dry, channel, status, reason):
    frame = spark.createDataFrame([(count,)], "n bigint")
    got = frame.select(
        nar.alert_status(F.col("n"), force, dry, channel), nar.skip_reason(F.col("n"), force, dry, channel)
    ).first()
    assert tuple(got) == (status, reason)
