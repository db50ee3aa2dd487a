"""Tables the jobs write: marts, alerts, run metrics and confirmed roles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.sources import versions


def replace_table(df: DataFrame, base: str, name: str, partition_by: str | None = None) -> DataFrame:
    """Create or replace ``base/name`` in one step and read it back (see versions).

    Reading back cuts the lineage at a file every executor can reach.
    """
    folder = f"{base}/{name}"
    path = versions.commit(df.sparkSession, folder, versions.write(df, folder, partition_by))
    # the written schema is known, so partition values keep their type
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The current version of a table."""
    path = versions.current(spark, f"{base}/{name}")
    if path is None:
        raise FileNotFoundError(f"there is no table {name!r} in {base}")
    return spark.read.parquet(path)


def replace_tables(tables: Mapping[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Replace several tables; none changes unless all could be written."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    written: dict[str, str] = {}
    try:
        for name, df in tables.items():
            written[f"{base}/{name}"] = versions.write(df, f"{base}/{name}")
    except Exception:
        for folder, version in written.items():
            versions.remove(spark, f"{folder}/{version}")
        raise
    paths = versions.commit_all(spark, written)
    return {name: spark.read.schema(df.schema).parquet(paths[f"{base}/{name}"]) for name, df in tables.items()}


def store_under(base: str):
    """A store that keeps each named frame as a table below ``base``."""
    return lambda name, df: replace_table(df, base, name)


def save_as_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalogue table.

    The new files lie in a folder of their own; a table that exists is pointed at them in one
    change of the catalogue. Only a change of columns needs it dropped and made anew.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    folder = f"{location}/{table}"
    version = versions.write(df, folder)
    path = f"{folder}/{version}"
    written = spark.read.parquet(path)
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == written.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    versions.commit(spark, folder, version)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# -- alerts ------------------------------------------------------------------------


def _append_once(rows: DataFrame, base: str, name: str, run_id: str) -> None:
    """Rows of a run take the place of what the same run wrote before, and of nothing else."""
    writer = rows.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{base}/{name}")


def append_alerts(alerts: DataFrame, base: str, run_id: str) -> None:
    """Only alerts marked sent go to the table the mailer reads; a repeated call adds none."""
    _append_once(alerts.filter("alert_status = 'sent'"), base, "alerts", run_id)


# -- run metrics ---------------------------------------------------------------------


def run_metrics(report: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Three numbers per run row: success 0/1, anomalies found, alert sent 0/1."""
    numbers = report.select(
        "metric",
        F.when(F.col("status") == "completed", 1.0).otherwise(0.0).alias("PipelineExecutionSuccess"),
        F.coalesce(F.col("anomaly_count"), F.lit(0)).cast("double").alias("AnomaliesDetected"),
        F.when(F.col("alert_status") == "sent", 1.0).otherwise(0.0).alias("AlertsSent"),
    )
    names = ["PipelineExecutionSuccess", "AnomaliesDetected", "AlertsSent"]
    long = numbers.unpivot("metric", names, "metric_name", "value").withColumn("unit", F.lit("Count"))
    return long if run_ts is None else long.withColumn("run_ts", run_ts)


def append_run_metrics(report: DataFrame, base: str, run_id: str) -> None:
    _append_once(run_metrics(report, F.current_timestamp()), base, "run_metrics", run_id)


# -- confirmed roles --------------------------------------------------------------------


def save_roles(confirmed: DataFrame, fingerprint: str, dataset_id: str, base: str) -> None:
    """Replace the stored confirmation of one dataset; a failed write keeps the old one."""
    rows = confirmed.withColumn("fingerprint", F.lit(fingerprint))
    folder = f"{base}/{dataset_id}/roles"
    versions.commit(confirmed.sparkSession, folder, versions.write(rows, folder, kind="json"))


def load_roles(spark: SparkSession, dataset_id: str, base: str) -> DataFrame | None:
    """The stored confirmation, or None if the dataset was never confirmed."""
    schema = (
        "position int, column string, role string, cardinality bigint, confidence double, "
        "reason string, date_column string, grain string, requires_human_review boolean, "
        "validation_errors array<string>, fingerprint string"
    )
    path = versions.current(spark, f"{base}/{dataset_id}/roles")
    return None if path is None else spark.read.schema(schema).json(path)


def reusable(stored: DataFrame, fingerprint: DataFrame) -> DataFrame:
    """Stored role rows whose schema fingerprint is still the current one."""
    return stored.join(fingerprint, "fingerprint", "left_semi")
