"""Column roles for an unknown table: date, metric, dimension or rejected.

All frames here have one row per column of the table, so the windows and
collected lists over them are bounded by the width of the schema.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits of the role rules.
MIN_DATE_PARSE_RATE = 0.95
MAX_DIMENSION_RATIO = 0.1
MAX_DIMENSION_NULL_RATE = 0.3
DAILY_RATIO = 0.95

ROLE_COLUMNS = ["column", "role", "cardinality", "confidence", "reason"]


def assign_roles(profiles: DataFrame) -> DataFrame:
    """Exactly one role and reason per column.

    The date is picked first: in a table with one row per day it looks like an id.
    """
    date_like = ~F.col("is_numeric") & (F.col("date_parse_rate") >= MIN_DATE_PARSE_RATE)
    preference = Window.partitionBy("date_like").orderBy(
        F.desc("date_parse_rate"), "null_rate", "position"
    )
    ranked = profiles.withColumn("date_like", date_like).withColumn(
        "choice", F.row_number().over(preference)
    )
    is_date = F.col("date_like") & (F.col("choice") == 1)
    role_and_reason = (
        F.when(is_date, _role("date", "best date parse rate"))
        .when(F.col("date_like"), _role("rejected", "another column is the date"))
        .when(F.col("is_likely_id"), _role("rejected", "identifier"))
        .when(F.col("is_numeric"), _role("metric", "numeric and not an identifier"))
        .when(F.col("null_rate") > MAX_DIMENSION_NULL_RATE, _role("rejected", "too many nulls"))
        .when(F.col("cardinality_ratio") > MAX_DIMENSION_RATIO, _role("rejected", "too many values"))
        .otherwise(_role("dimension", "few distinct values"))
    )
    return ranked.withColumn("r", role_and_reason).select(
        "position",
        F.col("name").alias("column"),
        F.col("r.role").alias("role"),
        "cardinality",
        F.bround(1.0 - F.col("null_rate"), 4).alias("confidence"),
        F.col("r.reason").alias("reason"),
    )


def _role(role: str, reason: str) -> Column:
    return F.struct(F.lit(role).alias("role"), F.lit(reason).alias("reason"))


def grain_of(day_cardinality: Column, n_rows: Column) -> Column:
    """daily when nearly every row has a day of its own."""
    ratio = F.coalesce(F.try_divide(day_cardinality, n_rows), F.lit(0.0))
    return F.when(ratio >= DAILY_RATIO, "daily").otherwise("other")


def validate_roles(roles: DataFrame, profiles: DataFrame) -> DataFrame:
    """(column, role, error) for every assignment the profile contradicts."""
    known = profiles.select(
        F.col("name").alias("column"),
        F.lit(True).alias("known"),
        "date_parse_rate",
        "is_numeric",
        "cardinality_ratio",
    )
    # The wording of the messages.
    noun = (
        F.when(F.col("role") == "date", "date_column")
        .when(F.col("role") == "metric", "a metric")
        .otherwise("a dimension")
    )
    proposed = F.concat(F.lit("'"), F.col("column"), F.lit("' proposed as "), noun, F.lit(" but "))
    problem = (
        F.when(F.col("known").isNull(), "is not a real column")
        .when(
            (F.col("role") == "date") & (F.col("date_parse_rate") < MIN_DATE_PARSE_RATE),
            F.concat(
                F.lit("only "),
                F.format_number(F.col("date_parse_rate") * 100, 0),
                F.lit("% parses as a date"),
            ),
        )
        .when((F.col("role") == "metric") & ~F.col("is_numeric"), "is not numeric")
        .when(
            (F.col("role") == "dimension") & (F.col("cardinality_ratio") > MAX_DIMENSION_RATIO),
            F.concat(
                F.lit("cardinality ratio "),
                F.format_number("cardinality_ratio", 2),
                F.lit(" suggests an identifier, not a category"),
            ),
        )
    )
    return (
        roles.filter(F.col("role") != "rejected")
        .join(known, "column", "left")
        .withColumn("problem", problem)
        .filter("problem IS NOT NULL")
        .select("column", "role", F.concat(proposed, "problem").alias("error"))
    )


def unknown_columns(roles: DataFrame, profiles: DataFrame) -> DataFrame:
    names = profiles.select(F.col("name").alias("column"))
    return roles.join(names, "column", "left_anti").select("column", "role")


def classification_header(roles: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row: date column, grain, review flag and the open errors."""
    named = profiles.withColumnRenamed("name", "column").select(
        "column", "day_cardinality", "n_rows"
    )
    date = F.col("role") == "date"
    return (
        roles.select("column", "role")
        .join(named, "column", "left")
        .join(validate_roles(roles, profiles), ["column", "role"], "left")
        .agg(
            F.max(F.when(date, F.col("column"))).alias("date_column"),
            F.max(F.when(date, F.col("day_cardinality"))).alias("days"),
            F.max("n_rows").alias("n_rows"),
            F.array_sort(F.collect_list("error")).alias("validation_errors"),
        )
        .select(
            "date_column",
            grain_of(F.col("days"), F.col("n_rows")).alias("grain"),
            (F.size("validation_errors") > 0).alias("requires_human_review"),
            "validation_errors",
        )
    )


def apply_overrides(roles: DataFrame, overrides: DataFrame) -> DataFrame:
    """Move columns to the role a person chose: (column, new_role).

    Accepts metric, dimension and reject; anything else changes nothing, and so
    does a column the table lacks. A moved date column leaves no date behind.
    """
    chosen = F.col("new_role")
    moved = overrides.select("column", F.lower(F.trim("new_role")).alias("new_role")).filter(
        F.col("new_role").isin("metric", "dimension", "reject")
    )
    # The reasons that a review report shows.
    reason = (
        F.when(chosen == "reject", "Manually rejected by user")
        .when(chosen.isNotNull(), "Manually assigned by user")
        .otherwise(F.col("reason"))
    )
    return roles.join(moved, "column", "left").select(
        "position",
        "column",
        F.when(chosen == "reject", "rejected").otherwise(F.coalesce(chosen, "role")).alias("role"),
        "cardinality",
        F.when(chosen.isNotNull(), F.lit(1.0)).otherwise(F.col("confidence")).alias("confidence"),
        reason.alias("reason"),
    )


def review_report(roles: DataFrame, profiles: DataFrame) -> DataFrame:
    """What a person confirms: every column with its role and the facts behind it."""
    facts = profiles.select(
        F.col("name").alias("column"), "date_parse_rate", "cardinality_ratio", "null_rate"
    )
    return (
        roles.join(facts, "column")
        .select("position", *ROLE_COLUMNS, "date_parse_rate", "cardinality_ratio", "null_rate")
        .orderBy("position")
    )


def role_matches(roles: DataFrame, expected: DataFrame) -> DataFrame:
    """Per role: columns missing from and extra to the expected (column, role) rows."""
    mine = roles.select("column", "role")
    theirs = expected.select("column", "role")
    missing = theirs.exceptAll(mine).withColumn("side", F.lit("missing"))
    extra = mine.exceptAll(theirs).withColumn("side", F.lit("extra"))
    asked = theirs.union(mine).select("role").distinct()
    counted = missing.union(extra).groupBy("role").agg(
        F.count_if(F.col("side") == "missing").alias("missing"),
        F.count_if(F.col("side") == "extra").alias("extra"),
    )
    return (
        asked.join(counted, "role", "left")
        .fillna(0, ["missing", "extra"])
        .withColumn("matches", (F.col("missing") == 0) & (F.col("extra") == 0))
    )


@dataclass(frozen=True)
class Roles:
    """Confirmed roles as plain names, for building plans."""

    date_column: str
    grain: str
    metrics: tuple[str, ...]
    dimensions: tuple[str, ...]


def collect_roles(confirmed: DataFrame) -> Roles:
    """Confirmed role rows, which repeat date_column and grain, as one object.

    Reads one row per column of the table to the driver.
    """
    rows = sorted(
        confirmed.select("position", "column", "role", "date_column", "grain").collect(),
        key=lambda r: r["position"],
    )
    if not rows or rows[0]["date_column"] is None:
        raise ValueError("no date column was found or confirmed")

    def named(role: str) -> tuple[str, ...]:
        return tuple(r["column"] for r in rows if r["role"] == role)

    return Roles(rows[0]["date_column"], rows[0]["grain"], named("metric"), named("dimension"))


def confirmed_roles(roles: DataFrame, header: DataFrame) -> DataFrame:
    """Role rows with the header of the whole table on each: date column, grain, and
    whether a person must look at it, with the open errors.

    Reads the single header row to the driver.
    """
    head = header.first()
    errors = F.array(*[F.lit(e) for e in head["validation_errors"]]).cast("array<string>")
    return roles.select(
        "*",
        F.lit(head["date_column"]).cast("string").alias("date_column"),
        F.lit(head["grain"]).alias("grain"),
        F.lit(head["requires_human_review"]).alias("requires_human_review"),
        errors.alias("validation_errors"),
    )
