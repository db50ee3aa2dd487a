"""The daily run: detect, decompose, narrate, investigate, alert.

All metrics of a dataset go through one lazy graph. Only sinks and the
caller's own actions execute it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootlens.functions.literals import each
from rootlens.operators import decomposition as dec
from rootlens.operators import detection as det
from rootlens.operators import investigation as inv
from rootlens.operators import narrative as nar
from rootlens.sources import sinks
from rootlens.spec import DEFAULT_LOOKBACK, DEFAULT_THRESHOLD, DatasetSpec

NO_DATES = "Two dates are needed for a comparison"
TEXTS = ["summary", "full", "slack", "email_subject"]


@dataclass(frozen=True)
class Investigation:
    classified: DataFrame
    drilled: DataFrame
    evidence: DataFrame
    drivers: DataFrame


def investigate(d: dec.Decomposition, store: dec.Store | None = None) -> Investigation:
    """Two fixed rounds: classify, open the close dimensions once, gather evidence.

    Verdicts and evidence are read by several checks; ``store`` computes them once.
    """
    keep = store or (lambda name, df: df)
    classified = keep("classified", inv.classify_ambiguity(d.top))
    drilled = dec.drill_down(d.slices, inv.plan_drill(classified))
    evidence = keep("evidence", inv.evidence_rows(d.top, drilled))
    return Investigation(classified, drilled, evidence, dec.top_driver(d.top))


def investigation_result(
    gate: DataFrame, pairs: DataFrame, texts: DataFrame, drivers: DataFrame, summaries: DataFrame
) -> DataFrame:
    """One record per metric and pair: status, all texts, driver with its figures, and summary.

    ``pairs`` carries PAIR; ``summaries`` holds investigation_summary and
    grounding_failed. A metric the gate stops keeps only its status.
    """
    go = F.col("proceed")
    driver = drivers.select(
        *dec.PAIR,
        F.col("dimension").alias("driver_dimension"),
        F.col("segment").alias("driver_segment"),
        F.col("contribution_pct").alias("driver_contribution_pct"),
        F.col("change").alias("driver_change"),
        F.col("change_pct").alias("driver_change_pct"),
    )
    joined = (
        pairs.join(gate.select("metric", "proceed"), "metric")
        .join(texts.select(*dec.PAIR, *TEXTS), dec.PAIR, "left")
        .join(driver, dec.PAIR, "left")
        .join(summaries, dec.PAIR, "left")
    )
    shown = [
        *TEXTS,
        "driver_dimension",
        "driver_segment",
        "driver_contribution_pct",
        "driver_change",
        "driver_change_pct",
        "investigation_summary",
        "grounding_failed",
    ]
    return joined.select(
        *dec.PAIR,
        F.when(go, "completed").otherwise("skipped_no_anomaly").alias("status"),
        *[F.when(go, F.col(c)).alias(c) for c in shown],
    )


@dataclass(frozen=True)
class Statements:
    """Explanations written elsewhere, to be checked: see operators/investigation.py.

    ``citations``: (PAIR, position, dimension, segment, source, claim);
    ``notes``: one (PAIR, uncertainty_note) per statement.
    """

    citations: DataFrame
    notes: DataFrame


def summarize(around: Investigation, pairs: DataFrame, statements: Statements | None) -> DataFrame:
    """Checked statements, or the fallback text where there is none that holds."""
    fallback = inv.fallback_summary(around.drivers)
    if statements is None:
        return fallback.withColumn("grounding_failed", F.lit(True))
    errors = inv.citation_errors(
        statements.citations, around.evidence, around.classified, statements.notes
    )
    rendered = inv.render_summary(statements.citations, around.evidence, statements.notes)
    return inv.synthesize(rendered, errors, fallback, pairs)


@dataclass(frozen=True)
class DailyRun:
    detection: det.Detection
    decomposition: dec.Decomposition
    texts: DataFrame
    alerts: DataFrame
    report: DataFrame
    investigation: DataFrame | None
    evidence: DataFrame | None
    run_id: str
    started_at: dt.datetime


def investigate_pair(
    tables: Mapping[str, DataFrame],
    spec: DatasetSpec,
    metric: str,
    current: str,
    previous: str,
    generated_at: str,
    threshold: float = DEFAULT_THRESHOLD,
    force: bool = True,
    statements: Statements | None = None,
) -> DataFrame:
    """An investigation asked for by a person: one metric and pair, by default whatever detection says."""
    fact = tables[spec.fact_table]
    found = det.run_detection(fact, [metric], threshold=threshold)
    pairs = dec.given_pair(fact, current, previous)
    d = dec.decompose(tables, spec, [metric], pairs)
    texts = nar.narratives(d.totals, d.top, dec.top_driver(d.top), generated_at)
    around = investigate(d)
    asked = pairs.select(F.lit(metric).alias("metric"), "current_date", "previous_date")
    summaries = summarize(around, asked, statements)
    gate = inv.investigation_gate(found.statistics, force)
    return investigation_result(gate, asked, texts, around.drivers, summaries)


def daily_run(
    tables: Mapping[str, DataFrame],
    spec: DatasetSpec,
    metrics: Sequence[str],
    generated_at: str,
    threshold: float = DEFAULT_THRESHOLD,
    lookback: int = DEFAULT_LOOKBACK,
    force_alert: bool = False,
    dry_run: bool = False,
    has_channel: bool = True,
    run_investigation: bool = False,
    statements: Statements | None = None,
    target: str | None = None,
    store: dec.Store | None = None,
    run_id: str | None = None,
) -> DailyRun:
    """Analyse the two newest dates of every metric.

    ``target="latest_anomaly"`` compares each metric's newest anomalous day with
    the day before it instead. A job that is started again passes the ``run_id``
    of its first try, so that what it publishes stands there once.
    """
    started = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    fact = tables[spec.fact_table]
    found = det.run_detection(fact, metrics, lookback, threshold)
    if target == "latest_anomaly":
        pairs = _anomaly_pairs(fact, found)
    else:
        pairs = dec.latest_pair(fact, target).select(each("metric", metrics), "*")
    days = pairs.select("current_date", "previous_date").distinct()
    d = dec.decompose(tables, spec, metrics, days, store)
    texts = nar.narratives(d.totals, d.top, dec.top_driver(d.top), generated_at)
    # a metric without a pair keeps its row, with NULL dates
    run_pairs = found.statistics.join(pairs, "metric", "left")
    report = _report(run_pairs, texts, force_alert, dry_run, has_channel)
    alerts = (
        nar.alert_messages(texts)
        .join(report.select(*dec.PAIR, "alert_status"), dec.PAIR)
        .filter("alert_status <> 'skipped'")
    )
    investigated = evidence = None
    if run_investigation:
        around = investigate(d, store)
        gate = inv.investigation_gate(found.statistics, force_alert)
        asked = run_pairs.filter("current_date IS NOT NULL").select(*dec.PAIR)
        summaries = summarize(around, asked, statements)
        investigated = investigation_result(gate, asked, texts, around.drivers, summaries)
        history = det.prior_anomalies(found.scored, asked)
        evidence = inv.evidence_text(d.top, d.totals, around.classified, around.drilled, history)
    return DailyRun(found, d, texts, alerts, report, investigated, evidence, run_id or uuid.uuid4().hex, started)


def _anomaly_pairs(fact: DataFrame, found: det.Detection) -> DataFrame:
    newest = found.latest.select("metric", F.col("metric_date").alias("current_date"))
    return newest.join(dec.consecutive_pairs(fact), "current_date").select(
        "metric", "current_date", "previous_date"
    )


def _report(
    run_pairs: DataFrame, texts: DataFrame, force: bool, dry_run: bool, has_channel: bool
) -> DataFrame:
    """One row per metric. A run that cannot finish says why instead of failing."""
    count = F.col("anomaly_count")
    problem = F.when(F.col("d_status") == "no_data", "no_data").when(
        F.col("current_date").isNull(), NO_DATES
    ).when(F.col("summary").isNull(), "no dimension carries this metric")
    fine = F.col("error").isNull()
    return (
        run_pairs.withColumnRenamed("status", "d_status")
        .join(texts.select(*dec.PAIR, "summary"), dec.PAIR, "left")
        .withColumn("error", problem)
        .select(
            *dec.PAIR,
            F.when(fine, "completed").otherwise("failed").alias("status"),
            "total_days_analyzed",
            "anomaly_count",
            "summary",
            F.when(fine, nar.alert_status(count, force, dry_run, has_channel))
            .otherwise("skipped")
            .alias("alert_status"),
            F.when(fine, nar.skip_reason(count, force, dry_run, has_channel))
            .otherwise(F.lit("failed"))
            .alias("alert_reason"),
            "error",
        )
    )


def run_summary(report: DataFrame) -> DataFrame:
    """What a caller is shown of a run; of a run_record with its duration too."""
    timed = [c for c in ("started_at", "completed_at", "duration_seconds") if c in report.columns]
    return report.select(
        "metric",
        F.col("status").alias("pipeline_status"),
        F.concat(
            F.coalesce(F.col("previous_date").cast("string"), F.lit("N/A")),
            F.lit(" → "),
            F.coalesce(F.col("current_date").cast("string"), F.lit("N/A")),
        ).alias("period"),
        "total_days_analyzed",
        "anomaly_count",
        "alert_status",
        F.coalesce("summary", F.lit("")).alias("summary"),
        *timed,
    )


def run_record(run: DailyRun, store: dec.Store) -> DataFrame:
    """The report once it is complete, with when the run began, ended, and how long it took.

    ``store`` writes the report, which is what completes a lazy run."""
    report = store("report", run.report)
    ended = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    stamps = {
        "run_id": F.lit(run.run_id),
        "started_at": F.lit(run.started_at),
        "completed_at": F.lit(ended),
        "duration_seconds": F.lit(round((ended - run.started_at).total_seconds(), 3)),
    }
    return report.withColumns(stamps)


def publish(run: DailyRun, base: str, dry_run: bool = False) -> None:
    """Add the alerts and the run's numbers once, however often it is tried; a dry run writes neither."""
    if dry_run:
        return
    sinks.append_alerts(run.alerts, base, run.run_id)
    sinks.append_run_metrics(run.report, base, run.run_id)
