"""Plain-language texts and alert rows from decomposition results.

One row per date pair. The per-dimension lines collected for a pair are as
many as the dataset has dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.functions.scalars import (
    half_even,
    heading_text,
    metric_title,
    money_text,
    number_text,
    plain_text,
    subject_text,
)
from rootlens.operators.decomposition import PAIR

BRAND = "Metric Watch"
FORMATS = {
    "full": "full",
    "slack": "slack",
    "email": "email_subject",
    "email_subject": "email_subject",
    "summary": "summary",
}


def headline_totals(totals: DataFrame) -> DataFrame:
    """Totals of each pair's first readable dimension."""
    fields = F.struct("total_current", "total_previous", "total_change", "total_change_pct")
    return totals.groupBy(*PAIR).agg(F.min_by(fields, "dim_order").alias("t")).select(*PAIR, "t.*")


def movement(change: Column) -> Column:
    """A change of exactly 0 reads as a decrease."""
    return F.when(change > 0, "increase").otherwise("decrease")


def dimension_lines(top: DataFrame) -> DataFrame:
    """The leading segment of every dimension, its share rounded to one decimal."""
    return top.filter("rank = 1").select(
        *PAIR,
        "dimension",
        "dim_order",
        F.col("segment").alias("top_segment"),
        half_even(F.col("contribution_pct"), 1).alias("top_contribution"),
    )


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def narratives(
    totals: DataFrame, top: DataFrame, drivers: DataFrame, generated_at: str, brand: str = BRAND
) -> DataFrame:
    """Columns full, slack, email_subject and summary for every pair.

    A pair without a driver (nothing contributed) gets texts that say so.
    """
    share = number_text(F.col("top_contribution"), 1)
    heading = heading_text(F.col("dimension"))
    segment = F.col("top_segment")
    # The wording and blank lines of the texts below.
    full_line = _text("\n- **", heading, "**: Top contributor was **", segment, "** (", share, "% of change)\n")
    slack_line = _text("• ", heading, ": ", segment, " (", share, "%)")
    lines = F.array_sort(
        F.collect_list(F.struct("dim_order", full_line.alias("full"), slack_line.alias("slack")))
    )
    by_pair = dimension_lines(top).groupBy(*PAIR).agg(lines.alias("lines"))

    word = F.col("direction")
    verb = _text(word, "d")
    name, change_pct = F.col("metric_name"), F.col("pct_text")
    today, before = F.col("current_date").cast("string"), F.col("previous_date").cast("string")
    has_driver = F.col("d.segment").isNotNull()
    driver, driver_dim = F.col("d.segment"), F.col("d.dimension")
    driver_share = number_text(F.abs("d.contribution_pct"), 2)
    driver_share_1 = number_text(F.abs(half_even(F.col("d.contribution_pct"), 1)), 1)
    nothing = F.lit("No single driver stands out.")

    full = _text(
        f"📊 **{brand} Alert: ", name, " ", word, "**\n\n**",
        today, "** vs **", before, "**\n\n",
        name, " ", verb, " **", change_pct, "%** ($",
        money_text(F.col("total_previous")), " → $", money_text(F.col("total_current")),
        "), a change of **$", money_text(F.col("total_change")), "**.\n\n**Primary Driver:**\n",
        F.when(
            has_driver,
            _text(
                "The ", word, " was primarily driven by **", heading_text(driver_dim),
                "** — specifically **", driver, "**, which accounted for **", driver_share,
                "%** of the total change.",
            ),
        ).otherwise(nothing),
        "\n\n**Breakdown by Dimension:**\n",
        F.array_join(F.transform("lines", lambda x: x["full"]), ""),
        f"\n\n---\n*Generated by {brand} at {generated_at}*",
    )
    slack = _text(
        ":chart_with_", F.when(word == "increase", "upwards").otherwise("downwards"),
        f"_trend: *{brand} Alert*\n\n*", name, "* ", verb, " *", change_pct, "%* on ", today,
        "\n\n:mag: *Root Cause:* ",
        F.when(
            has_driver, _text(driver, " (", driver_dim, ") drove ", driver_share, "% of the change")
        ).otherwise(nothing),
        "\n\n:bar_chart: Breakdown:\n", F.array_join(F.transform("lines", lambda x: x["slack"]), "\n"),
    )
    summary = _text(
        name, " ", verb, " ", change_pct, "% on ", today, ". ",
        F.when(
            has_driver,
            _text("Primary driver: ", driver, " (", driver_dim, ") contributed ", driver_share_1, "% of the change."),
        ).otherwise(nothing),
    )
    drivers = drivers.select(*PAIR, F.struct("segment", "dimension", "contribution_pct").alias("d"))
    return (
        headline_totals(totals)
        .withColumn("direction", movement(F.col("total_change")))
        .withColumn("metric_name", metric_title(F.col("metric")))
        .withColumn("pct_text", number_text(F.abs(half_even(F.col("total_change_pct"), 1)), 1))
        .join(by_pair, PAIR, "left")
        .join(drivers, PAIR, "left")
        .select(
            *PAIR,
            full.alias("full"),
            slack.alias("slack"),
            _text(f"{brand}: ", name, " ", word, " ", change_pct, "% on ", today).alias("email_subject"),
            summary.alias("summary"),
        )
    )


def pick_format(texts: DataFrame, format_type: str = "all") -> DataFrame:
    if format_type == "all":
        return texts
    if format_type not in FORMATS:
        raise ValueError(
            f"Unknown format_type '{format_type}'. Valid: all, full, slack, email, summary"
        )
    return texts.select(*PAIR, FORMATS[format_type])


def alert_messages(texts: DataFrame, brand: str = BRAND) -> DataFrame:
    """Subject of at most 100 characters and a body without markdown stars."""
    body = F.coalesce("full", "summary", F.lit("No details available"))
    return texts.select(
        *PAIR,
        subject_text(F.coalesce("email_subject", F.lit(f"{brand} Alert"))).alias("subject"),
        plain_text(body).alias("message"),
    )


def alert_status(anomaly_count: Column, force: bool, dry_run: bool, has_channel: bool) -> Column:
    """sent, dry_run or skipped; any anomalous day in the window raises the alert."""
    due = (anomaly_count > 0) | F.lit(force)
    if dry_run:
        outcome = "dry_run"
    else:
        outcome = "sent" if has_channel else "skipped"
    return F.when(due, outcome).otherwise("skipped")


def skip_reason(anomaly_count: Column, force: bool, dry_run: bool, has_channel: bool) -> Column:
    due = (anomaly_count > 0) | F.lit(force)
    missing = F.lit(None if dry_run or has_channel else "no_channel").cast("string")
    return F.when(due, missing).otherwise("no_anomaly")
