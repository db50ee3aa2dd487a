"""From an unknown table to reconciled daily tables and a first analysis."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.functions.scalars import DATE_FORMATS
from rootlens.operators import classification as cls
from rootlens.operators import hierarchy as hy
from rootlens.operators import profiling as prof
from rootlens.operators import rollup as ru
from rootlens.operators import spellings as sp
from rootlens.plans.daily_run import DailyRun, daily_run
from rootlens.sources import sinks
from rootlens.sources.flat_file import read_flat_file
from rootlens.spec import DatasetSpec


class ReconciliationError(ValueError):
    """A generated dimension table disagrees with the fact table."""


@dataclass(frozen=True)
class Onboarded:
    """``grain`` is that of the rows now loaded; ``warnings`` are what the profile holds
    against the confirmed roles, and make ``requires_human_review`` true. ``rejected`` are
    the ``dropped_rows`` rows that no table holds, with the reason; both are None for
    a dataset that is only loaded."""

    dataset_id: str
    spec: DatasetSpec
    roles: DataFrame
    tables: dict[str, DataFrame]
    reused: bool
    grain: str
    requires_human_review: bool
    warnings: tuple[str, ...]
    rejected: DataFrame | None = None
    dropped_rows: int | None = None


def _confirm(
    df: DataFrame, dataset_id: str, base: str, fingerprint: str, stored: DataFrame | None, overrides, formats, sketches
) -> DataFrame:
    """Assign or edit the roles and save them, unless they leave no date column."""
    spark = df.sparkSession
    if stored is None:
        # one row per column, but costly to compute: written once, read often
        profiles = sinks.replace_table(
            prof.profile_columns(df, formats, sketches), base, f"{dataset_id}/profile"
        )
        roles = cls.assign_roles(profiles)
    else:
        profiles = sinks.read_table(spark, base, f"{dataset_id}/profile")
        # a row per column; held here as the file they come from is replaced
        kept = stored.select("position", *cls.ROLE_COLUMNS)
        roles = spark.createDataFrame(kept.collect(), kept.schema)
    if overrides is not None:
        roles = cls.apply_overrides(roles, overrides)
    confirmed = cls.confirmed_roles(roles, cls.classification_header(roles, profiles))
    cls.collect_roles(confirmed)  # raises without a date column: nothing is saved then
    sinks.save_roles(confirmed, fingerprint, dataset_id, base)
    return sinks.load_roles(spark, dataset_id, base)


def onboard(
    df: DataFrame,
    dataset_id: str,
    base: str,
    overrides: DataFrame | None = None,
    formats: prof.Formats | None = None,
    exact_scale: int | None = None,
    sketches: bool = False,
    hierarchies: bool = False,
) -> Onboarded:
    """Profile, assign roles, write the daily tables, and check that they agree.

    Without ``formats`` the order of day and month is found for each text column over all its
    values (see spellings); a date column for which both orders fit is a warning. ``sketches``
    estimates the distinct counts, which only the first load needs. With ``hierarchies`` a
    dimension that a finer one determines gets that one as its detail (see hierarchy). Rows without a readable
    date go to the table ``rejected_rows``.

    Roles confirmed earlier are used again while names and types are unchanged;
    ``overrides`` (column, new_role) are a person's edits of the new or the stored
    roles. Rows are always summed per day: what was one row a day at the first
    load may be many in the next file.
    """
    spark = df.sparkSession
    columns = prof.columns_of(df)
    fingerprint = prof.schema_fingerprint(columns).first()["fingerprint"]
    confirmed = sinks.load_roles(spark, dataset_id, base)
    if confirmed is not None:
        confirmed = confirmed.filter(F.col("fingerprint") == fingerprint)
    reused = confirmed is not None and not confirmed.isEmpty()
    doubtful: list[str] = []
    if formats is None:
        known = None if not reused or overrides is not None else [cls.collect_roles(confirmed).date_column]
        formats, doubtful = sp.formats_of(sp.date_orders(df, known))
    if not reused or overrides is not None:
        stored = confirmed if reused else None
        confirmed = _confirm(df, dataset_id, base, fingerprint, stored, overrides, formats, sketches)

    plan = replace(cls.collect_roles(confirmed), grain="other")
    details = hy.details_of(hy.dependencies(df, plan.dimensions)) if hierarchies else {}
    spec = ru.dataset_spec(plan, details)
    own = formats.get(plan.date_column, DATE_FORMATS) if isinstance(formats, Mapping) else formats
    dated = ru.dated_rows(df, plan.date_column, own)
    folder = f"{base}/{dataset_id}"
    rejected = sinks.replace_table(ru.rejected_rows(dated, plan.date_column), folder, "rejected_rows")
    kept = df.sparkSession.createDataFrame(sorted(details.items()), "segment string, detail string")
    sinks.replace_table(kept, folder, "hierarchy")
    fact = sinks.replace_table(ru.daily_fact(dated, plan, exact_scale), folder, spec.fact_table)
    tables = {spec.fact_table: fact}
    if plan.dimensions:
        rollup = sinks.replace_table(
            ru.dimension_rollup(dated, plan, exact_scale, details=details or None),
            folder,
            "metric_by_dimension",
            partition_by="dimension",
        )
        check = ru.reconcile(fact, rollup, plan.dimensions, spec.metrics)
        # at most one row per dimension
        errors = [r["error"] for r in ru.reconciliation_errors(check).collect()]
        if errors:
            raise ReconciliationError("; ".join(sorted(errors)))
        tables.update(ru.dimension_tables(rollup, spec))
    done = _onboarded(dataset_id, spec, confirmed, tables, reused)
    doubts = [f"day and month of '{c}' cannot be told apart" for c in doubtful if c == plan.date_column]
    review = done.requires_human_review or bool(doubts)
    return replace(
        done, warnings=(*done.warnings, *doubts), requires_human_review=review, rejected=rejected, dropped_rows=rejected.count()
    )


def _onboarded(
    dataset_id: str, spec: DatasetSpec, roles: DataFrame, tables: dict[str, DataFrame], reused: bool
) -> Onboarded:
    """With the grain of the daily table as it is, and the review state of the roles."""
    days = tables[spec.fact_table].agg(F.count("*").alias("days"), F.sum(ru.ROW_COUNT).alias("n_rows"))
    grain = days.select(cls.grain_of(F.col("days"), F.col("n_rows")).alias("grain")).first()["grain"]
    review = roles.select("requires_human_review", "validation_errors").first()
    return Onboarded(
        dataset_id,
        spec,
        roles,
        tables,
        reused,
        grain,
        bool(review["requires_human_review"]),
        tuple(review["validation_errors"] or ()),
    )


def dropped_rows(df: DataFrame, done: Onboarded) -> DataFrame:
    """How many rows had no readable date and are in no table."""
    none = F.lit(0).cast("bigint")
    kept = done.tables[done.spec.fact_table].select(
        none.alias("n_rows"), F.col(ru.ROW_COUNT).alias("kept_rows")
    )
    total = df.agg(F.count("*").alias("n_rows")).select("n_rows", none.alias("kept_rows"))
    return total.unionByName(kept).agg(
        F.sum("n_rows").alias("n_rows"), (F.sum("n_rows") - F.sum("kept_rows")).alias("dropped_rows")
    )


def onboard_file(
    spark: SparkSession, path: str, dataset_id: str, base: str, **options
) -> Onboarded:
    return onboard(read_flat_file(spark, path), dataset_id, base, **options)


def load_dataset(spark: SparkSession, dataset_id: str, base: str) -> Onboarded:
    """An onboarded dataset from its stored roles and tables."""
    roles = sinks.load_roles(spark, dataset_id, base)
    if roles is None:
        raise FileNotFoundError(f"No confirmed classification for '{dataset_id}': onboard it first")
    folder = f"{base}/{dataset_id}"
    details = {r["segment"]: r["detail"] for r in sinks.read_table(spark, folder, "hierarchy").collect()}
    spec = ru.dataset_spec(cls.collect_roles(roles), details)
    tables = {spec.fact_table: sinks.read_table(spark, folder, spec.fact_table)}
    if spec.dimensions:
        rollup = sinks.read_table(spark, folder, "metric_by_dimension")
        tables.update(ru.dimension_tables(rollup, spec))
    return _onboarded(dataset_id, spec, roles, tables, True)


def run_cycle(done: Onboarded, metric: str, generated_at: str, **options) -> DailyRun:
    """The daily run on an onboarded dataset."""
    return daily_run(done.tables, done.spec, [metric], generated_at, **options)
