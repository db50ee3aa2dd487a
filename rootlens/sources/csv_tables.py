"""Typed loads of the raw CSV files and checks on what was loaded."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.functions.scalars import lenient_timestamp
from rootlens.sources.sinks import replace_tables
from rootlens.sources.split_csv import parse_records, read_records

# Raw tables as (column, type); a number in parentheses is the
# width in bytes that longer strings are cut to.
RAW_TABLES: dict[str, list[tuple[str, str]]] = {
    "orders": [
        ("order_id", "varchar(50)"),
        ("customer_id", "varchar(50)"),
        ("order_status", "varchar(20)"),
        ("order_purchase_timestamp", "timestamp"),
        ("order_approved_at", "timestamp"),
        ("order_delivered_carrier_date", "timestamp"),
        ("order_delivered_customer_date", "timestamp"),
        ("order_estimated_delivery_date", "timestamp"),
    ],
    "order_items": [
        ("order_id", "varchar(50)"),
        ("order_item_id", "int"),
        ("product_id", "varchar(50)"),
        ("seller_id", "varchar(50)"),
        ("shipping_limit_date", "timestamp"),
        ("price", "decimal(10,2)"),
        ("freight_value", "decimal(10,2)"),
    ],
    "customers": [
        ("customer_id", "varchar(50)"),
        ("customer_unique_id", "varchar(50)"),
        ("customer_zip_code_prefix", "varchar(10)"),
        ("customer_city", "varchar(100)"),
        ("customer_state", "varchar(5)"),
    ],
    "products": [
        ("product_id", "varchar(50)"),
        ("product_category_name", "varchar(100)"),
        ("product_name_length", "int"),
        ("product_description_length", "int"),
        ("product_photos_qty", "int"),
        ("product_weight_g", "int"),
        ("product_length_cm", "int"),
        ("product_height_cm", "int"),
        ("product_width_cm", "int"),
    ],
    "sellers": [
        ("seller_id", "varchar(50)"),
        ("seller_zip_code_prefix", "varchar(10)"),
        ("seller_city", "varchar(100)"),
        ("seller_state", "varchar(5)"),
    ],
    "payments": [
        ("order_id", "varchar(50)"),
        ("payment_sequential", "int"),
        ("payment_type", "varchar(20)"),
        ("payment_installments", "int"),
        ("payment_value", "decimal(10,2)"),
    ],
    "category_translation": [
        ("product_category_name", "varchar(100)"),
        ("product_category_name_english", "varchar(100)"),
    ],
}


def cut_bytes(text: Column, width: int) -> Column:
    """The longest beginning of ``text`` that takes at most ``width`` bytes of UTF-8."""
    data = text.cast("binary")

    def goes_on(place: int) -> Column:
        """Whether a byte (from 1) continues a character."""
        return F.hex(F.substring(data, place, 1)).between("80", "BF")

    # a character takes up to four bytes, so its first one is among the last three kept
    cut = F.substring(data, 1, max(width - 3, 0))
    for back in (2, 1, 0):
        if width > back:
            cut = F.when(~goes_on(width - back + 1), F.substring(data, 1, width - back)).otherwise(cut)
    return F.when(F.octet_length(text) <= width, text).otherwise(cut.cast("string"))


def typed_column(name: str, kind: str) -> Column:
    """Blank text becomes NULL, long text is cut, anything unreadable fails the load."""
    filled = F.when(F.trim(name) != "", F.col(name))
    if kind.startswith("varchar"):
        width = int(kind[len("varchar(") : -1])
        return cut_bytes(filled, width).alias(name)
    if kind == "timestamp":
        moment = lenient_timestamp(filled)
        message = F.concat(F.lit(f"{name}: not a timestamp: "), filled)
        strict = F.when(
            filled.isNotNull() & moment.isNull(), F.raise_error(message).cast("timestamp_ntz")
        ).otherwise(moment)
        return strict.alias(name)
    return F.trim(filled).cast(kind).alias(name)


def typed(strings: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return strings.select(*[typed_column(name, kind) for name, kind in columns])


def read_csv_table(
    spark: SparkSession, path: str, columns: list[tuple[str, str]], multiline: bool = False
) -> DataFrame:
    """Columns go by position and the header line is skipped, whatever it says.

    A line with too few or too many fields stops the load, whichever columns are
    read later. ``multiline`` is for files with line breaks inside quotes, which are
    read in splits too (see split_csv).
    """
    schema = ", ".join(f"{name} string" for name, _ in columns)
    if multiline:
        records, _ = read_records(spark, path)
        names = [name for name, _ in columns]
        return typed(parse_records(records, names, schema, nullValue="", escape='"', mode="FAILFAST"), columns)
    # the number of fields is checked only where none are pruned
    strings = spark.read.option("columnPruning", False).csv(
        path,
        schema=schema,
        header=True,
        nullValue="",
        escape='"',
        mode="FAILFAST",
    )
    return typed(strings, columns)


def read_csv_catalogue(
    spark: SparkSession, paths: Mapping[str, str], tables=RAW_TABLES
) -> dict[str, DataFrame]:
    return {name: read_csv_table(spark, path, tables[name]) for name, path in paths.items()}


def load_catalogue(
    spark: SparkSession, paths: Mapping[str, str], base: str, tables=RAW_TABLES
) -> dict[str, DataFrame]:
    """Full refresh: every table is rewritten as parquet and read back.

    All are written before the first is replaced, so a file that cannot be read
    leaves the tables of the last load as they were."""
    return replace_tables(read_csv_catalogue(spark, paths, tables), base)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, row_count) for every table."""
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def verify_loads(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Recount and compare with ``expected`` (table, loaded); a missing table mismatches."""
    return (
        expected.join(row_counts(tables), "table", "full")
        .select("table", "loaded", "row_count")
        .withColumn("matches", F.coalesce(F.col("loaded") == F.col("row_count"), F.lit(False)))
    )


def list_tables(spark: SparkSession, schema: str = "default") -> DataFrame:
    """Tables of a schema by name."""
    return (
        spark.sql(f"SHOW TABLES IN {schema}")
        .filter(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
        .orderBy("table_name")
    )
