"""Ambiguity, drill planning, evidence, citation checks and the final summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.functions.scalars import (
    half_even,
    heading_text,
    money_text,
    number_text,
    signed_text,
    title_text,
)
from rootlens.operators.decomposition import GROUP, PAIR, strongest

# Points between the two largest shares that still count as close,
# and the most drill rounds.
CLOSE_POINTS = 15
MAX_ITERATIONS = 2
CITED = ["source", "dimension", "segment"]


def classify_ambiguity(top: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Why a dimension has no clear driver, or NULL when it has one.

    A leading share outside 0..100 means segments moved against each other; that
    is tested first, because closeness of the runner-up means nothing then.
    """
    rank = F.col("rank")
    lead = F.max(F.when(rank == 1, F.col("contribution_pct")))
    gap = F.abs(
        F.max(F.when(rank == 1, F.col("abs_contribution")))
        - F.max(F.when(rank == 2, F.col("abs_contribution")))
    )
    reason = F.when((F.col("lead") < 0) | (F.col("lead") > 100), "offsetting_segments").when(
        F.col("gap") <= CLOSE_POINTS, "close_contributors"
    )
    leader = F.max(F.when(rank == 1, F.col("segment"))).alias("segment")
    return (
        top.groupBy(*group)
        .agg(lead.alias("lead"), gap.alias("gap"), leader)
        .withColumn("reason", reason)
    )


def ambiguous_dimensions(classified: DataFrame) -> DataFrame:
    return classified.filter("reason IS NOT NULL")


def plan_drill(
    classified: DataFrame, drilled: DataFrame | None = None, iteration: int = 1
) -> DataFrame:
    """Segments to open next: leaders of close dimensions not yet drilled.

    Offsetting dimensions are never opened; finer detail cannot settle them.
    """
    pending = classified.filter(
        (F.col("reason") == "close_contributors") & F.lit(iteration < MAX_ITERATIONS)
    )
    if drilled is not None:
        pending = pending.join(drilled, [*PAIR, "dimension"], "left_anti")
    return pending.select(*GROUP, "segment")


def investigation_gate(statistics: DataFrame, force: bool = False) -> DataFrame:
    """Whether a metric's run goes on: it has an anomaly, or it is forced."""
    proceed = (F.col("anomaly_count") > 0) | F.lit(force)
    return statistics.select(
        "metric",
        "anomaly_count",
        proceed.alias("proceed"),
        F.when(proceed, "decompose_all").otherwise("finalize_skip").alias("next_step"),
        F.when(~proceed, "skipped_no_anomaly").alias("status"),
    )


# -- evidence ----------------------------------------------------------------------

_FIGURES = [
    "rank",
    "current_value",
    "previous_value",
    "change",
    "change_pct",
    "contribution_pct",
]


def evidence_rows(top: DataFrame, drilled: DataFrame | None = None) -> DataFrame:
    """What a statement may cite: leading segments and leading drilled details."""
    keep = [*PAIR, "source", "dimension", "dim_order", "segment", *_FIGURES]
    rows = top.withColumn("source", F.lit("decomposition")).select(*keep)
    if drilled is None:
        return rows
    inner = strongest(drilled, [*GROUP, "parent"]).withColumn("source", F.lit("drill_down"))
    return rows.unionByName(inner.select(*keep))


def evidence_text(
    top: DataFrame,
    totals: DataFrame,
    classified: DataFrame,
    drilled: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """One evidence sheet per pair: dimensions in order, then earlier anomalies.

    Lists hold at most five segments per dimension, and the dimensions of a spec,
    so the collected arrays are bounded; history is bounded by the lookback.
    """

    # The wording and indents of the sheet.
    def share(indent: str, label: Column) -> Column:
        return F.concat(
            F.lit(indent),
            label,
            F.lit(": change "),
            number_text(F.col("change"), 2),
            F.lit(", contribution_pct "),
            number_text(F.col("contribution_pct"), 2),
            F.lit("%"),
        )

    def ranked_lines(rows: DataFrame, line: Column, name: str) -> DataFrame:
        listed = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
        return rows.groupBy(*GROUP).agg(F.transform(listed, lambda x: x["line"]).alias(name))

    sheet = (
        totals.join(ranked_lines(top, share("    ", F.col("segment")), "lines"), GROUP)
        .join(classified.select(*GROUP, "reason", F.col("segment").alias("leader")), GROUP, "left")
    )
    if drilled is not None:
        label = F.concat(
            F.col("segment"),
            F.lit(" (source='drill_down', dimension='"),
            F.col("dimension"),
            F.lit("')"),
        )
        inner = strongest(drilled, [*GROUP, "parent"])
        sheet = sheet.join(ranked_lines(inner, share("      ", label), "drill_lines"), GROUP, "left")
    else:
        sheet = sheet.withColumn("drill_lines", F.lit(None).cast("array<string>"))

    header = F.concat(
        title_text(F.col("dimension")),
        F.coalesce(F.concat(F.lit(" -- ambiguous, reason: "), F.col("reason")), F.lit("")),
    )
    total_line = F.concat(
        F.lit("  total_change: "),
        number_text(F.col("total_change"), 2),
        F.lit(", total_change_pct: "),
        number_text(F.col("total_change_pct"), 2),
        F.lit("%"),
    )
    drill_header = F.format_string(
        "  >>> %s was drilled down because it was ambiguous at the level above. "
        "Use THIS breakdown, not '%s' above, to name the primary driver within %s:",
        F.col("dimension"),
        F.col("leader"),
        F.col("dimension"),
    )
    opened = F.when(
        F.col("drill_lines").isNotNull(), F.concat(F.array(drill_header), F.col("drill_lines"))
    ).otherwise(F.array().cast("array<string>"))
    section = F.array_join(F.concat(F.array(header, total_line), F.col("lines"), opened), "\n")
    sections = F.array_sort(F.collect_list(F.struct("dim_order", section.alias("text"))))
    sheets = sheet.groupBy(*PAIR).agg(
        F.array_join(F.transform(sections, lambda x: x["text"]), "\n\n").alias("evidence")
    )
    if history is None:
        return sheets
    line = F.concat(
        F.lit("    "),
        F.col("metric_date").cast("string"),
        F.lit(": "),
        F.col("anomaly_direction"),
        F.lit(", "),
        # the first day of a series, or one after a zero, has no relative change
        F.coalesce(F.concat(number_text(F.col("change_pct"), 2), F.lit("%")), F.lit("n/a")),
        F.lit(" change"),
    )
    past = F.array_sort(F.collect_list(F.struct("metric_date", line.alias("line"))))
    by_pair = history.groupBy("metric", "current_date").agg(
        F.array_join(F.transform(past, lambda x: x["line"]), "\n").alias("past")
    )
    intro = F.lit("\n\nPrior anomalies on this metric (for comparison only, not a cause):\n")
    return sheets.join(by_pair, ["metric", "current_date"], "left").select(
        *PAIR,
        F.concat(
            "evidence", F.coalesce(F.concat(intro, F.col("past")), F.lit(""))
        ).alias("evidence"),
    )


# -- citations ------------------------------------------------------------------------
# A citation row: PAIR, position (0 = primary), dimension, segment, source, claim.


def valid_citations(citations: DataFrame, evidence: DataFrame) -> DataFrame:
    return citations.join(evidence, [*PAIR, *CITED], "left_semi")


def invalid_citations(citations: DataFrame, evidence: DataFrame) -> DataFrame:
    return citations.join(evidence, [*PAIR, *CITED], "left_anti")


def citation_errors(
    citations: DataFrame, evidence: DataFrame, classified: DataFrame, notes: DataFrame
) -> DataFrame:
    """Everything wrong with each pair's statement: (PAIR, position, error).

    ``notes`` holds one (PAIR, uncertainty_note) per statement. A pair with an
    offsetting dimension needs a note. The segments listed in a message are at
    most five per source and dimension.
    """
    known = evidence.groupBy(*PAIR, "source", "dimension").agg(
        F.array_join(F.array_sort(F.collect_set("segment")), ", ").alias("valid")
    )
    # The wording of both messages.
    message = F.concat(
        F.lit("'"),
        F.col("segment"),
        F.lit("' is not a valid segment for '"),
        F.col("dimension"),
        F.lit("' (source="),
        F.col("source"),
        F.lit("); valid segments are: "),
        F.coalesce("valid", F.lit("(none)")),
    )
    unknown = (
        invalid_citations(citations, evidence)
        .join(known, [*PAIR, "source", "dimension"], "left")
        .select(*PAIR, "position", message.alias("error"))
    )
    offsetting = classified.filter("reason = 'offsetting_segments'").select(*PAIR).distinct()
    blank = F.coalesce(F.col("uncertainty_note"), F.lit("")) == ""
    missing = (
        notes.filter(blank)
        .join(offsetting, PAIR, "left_semi")
        .select(
            *PAIR,
            F.lit(None).cast("int").alias("position"),
            F.lit(
                "uncertainty_note is required because an offsetting_segments dimension "
                "is present in the evidence, but it was null"
            ).alias("error"),
        )
    )
    return unknown.unionByName(missing)


def cite_figures(citations: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each citation with the figures the evidence holds for it."""
    figures = evidence.select(
        *PAIR, *CITED, "current_value", "previous_value", "contribution_pct"
    )
    return citations.join(figures, [*PAIR, *CITED], "left")


def render_summary(citations: DataFrame, evidence: DataFrame, notes: DataFrame) -> DataFrame:
    """Statement text per pair. Numbers come from the evidence, never the citation."""
    # The wording and blank lines of the statement.
    share = number_text(F.abs("contribution_pct"), 2)
    opening = F.concat(
        F.upper(F.left("claim", F.lit(1))),
        F.lower(F.substr("claim", F.lit(2))),
        F.lit(": **"),
        F.col("segment"),
        F.lit("** ("),
        heading_text(F.col("dimension")),
        F.lit(") contributed **"),
        share,
        F.lit("%** of the change ($"),
        money_text(F.col("previous_value")),
        F.lit(" -> $"),
        money_text(F.col("current_value")),
        F.lit(")."),
    )
    factor = F.concat(
        F.lit("- "), F.col("claim"), F.lit(": "), F.col("segment"), F.lit(" ("), share, F.lit("%)")
    )
    first = F.col("position") == 0
    factors = F.array_sort(
        F.collect_list(F.when(~first, F.struct("position", F.col("factor").alias("line"))))
    )
    stated = (
        cite_figures(citations, evidence)
        .withColumn("opening", F.when(first, opening))
        .withColumn("factor", F.when(~first, factor))
        .groupBy(*PAIR)
        .agg(F.max("opening").alias("opening"), factors.alias("factors"))
    )
    some = F.size("factors") > 0
    listed = F.when(
        some,
        F.concat(
            F.lit("\n\nContributing factors:\n"),
            F.array_join(F.transform("factors", lambda x: x["line"]), "\n"),
        ),
    ).otherwise(F.lit(""))
    gap = F.when(some, F.lit("\n\n\n\n")).otherwise(F.lit("\n\n\n"))
    note = F.when(
        F.coalesce(F.col("uncertainty_note"), F.lit("")) != "",
        F.concat(gap, F.lit("warning: "), F.col("uncertainty_note")),
    ).otherwise(F.lit(""))
    return stated.join(notes, PAIR, "left").select(
        *PAIR, F.concat("opening", listed, note).alias("investigation_summary")
    )


def fallback_summary(drivers: DataFrame) -> DataFrame:
    """Statement built from the top driver alone."""
    # The wording of the sentence.
    text = F.concat(
        F.lit("The primary driver was "),
        F.col("segment"),
        F.lit(" ("),
        F.col("dimension"),
        F.lit("), contributing "),
        number_text(F.abs(half_even(F.col("contribution_pct"), 1)), 1),
        F.lit("% of the change ("),
        signed_text(F.col("change_pct")),
        F.lit("% change)."),
    )
    return drivers.select(*PAIR, text.alias("investigation_summary"))


def synthesize(
    rendered: DataFrame, errors: DataFrame, fallback: DataFrame, pairs: DataFrame
) -> DataFrame:
    """The rendered statement where every citation holds, else the fallback."""
    failed = errors.select(*PAIR).distinct().withColumn("grounding_failed", F.lit(True))
    spare = fallback.withColumnRenamed("investigation_summary", "spare")
    has_text = F.col("investigation_summary").isNotNull() & F.col("grounding_failed").isNull()
    return (
        pairs.join(rendered, PAIR, "left")
        .join(failed, PAIR, "left")
        .join(spare, PAIR, "left")
        .select(
            *PAIR,
            F.when(has_text, F.col("investigation_summary"))
            .otherwise(F.col("spare"))
            .alias("investigation_summary"),
            (~has_text).alias("grounding_failed"),
        )
    )


def grounding_rates(trials: DataFrame) -> DataFrame:
    """Shares over graded trials (outcome, golden_match, uncertainty_ok); 0 when empty."""

    def share(hit: Column) -> Column:
        return F.coalesce(F.avg(F.when(hit, 1.0).otherwise(0.0)), F.lit(0.0))

    outcome = F.col("outcome")
    return trials.agg(
        F.count("*").alias("trials"),
        share(outcome == "grounded_first_attempt").alias("grounding_pass_rate"),
        share(outcome.startswith("fallback")).alias("fallback_rate"),
        share(F.col("golden_match")).alias("golden_match_rate"),
        share(F.col("uncertainty_ok")).alias("uncertainty_ok_rate"),
    )
