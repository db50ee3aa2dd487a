"""Statistics of every column of an unknown table.

Exact statistics: columns are stacked to (column, value) and counted per distinct value. That
one aggregation combines map-side, so a value that fills the table costs nothing
extra, and everything else (distinct counts, NULL rates, date parsing) is
computed on its much smaller result. Values travel as numbers or as 16-byte digests;
only texts that look like dates travel as they are, and are parsed once each.

Sketched statistics: one pass without any shuffle of values gives HyperLogLog
sketches of the values and days of each column. They are a few kilobytes whatever the table holds,
and those of a table's parts merge to those of the table. Distinct counts are
then estimates; all other counts stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.functions.literals import rows_of
from rootlens.functions.scalars import DATE_FORMATS, lenient_timestamp, may_be_date

#: Formats for all columns, or for each by name; columns not named are read with DATE_FORMATS.
Formats = Sequence[str] | Mapping[str, Sequence[str]]

# Share of distinct values above which a column looks like an id,
# how many example values are kept, and how many values the sampled date check reads.
ID_RATIO = 0.9
SAMPLE_VALUES = 5
DATE_SAMPLE = 1000


def is_numeric(kind: T.DataType) -> bool:
    """Flags count as numbers, like 0/1 columns."""
    return isinstance(kind, (T.NumericType, T.BooleanType))


def is_float(kind: T.DataType) -> bool:
    """Measured amounts; these are naturally near-unique and never ids."""
    return isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType))


def is_temporal(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def columns_of(df: DataFrame) -> DataFrame:
    """(position, name, dtype, is_numeric, is_float, is_temporal) from the schema."""
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("dtype"),
            F.lit(is_numeric(field.dataType)).alias("is_numeric"),
            F.lit(is_float(field.dataType)).alias("is_float"),
            F.lit(is_temporal(field.dataType)).alias("is_temporal"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return rows_of(df.sparkSession, rows)


#: log2 of the registers of a sketch; the relative standard error is about 1.04 / sqrt(4096).
SKETCH_BITS = 12
_MICROS_A_DAY = 86_400_000_000


def _number(name: str, kind: T.DataType) -> Column | None:
    """A long that is equal exactly when the values are; None for types that have none."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("long")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (column * F.lit(Decimal(10) ** kind.scale)).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(column) * 3600 + F.minute(column) * 60 + F.date_part(F.lit("SECONDS"), column)
        return F.unix_date(F.to_date(column)).cast("long") * _MICROS_A_DAY + (clock * 1_000_000).cast("long")
    return None


def _formats(formats: Formats, name: str) -> Sequence[str]:
    return formats.get(name, DATE_FORMATS) if isinstance(formats, Mapping) else formats


def _value_key(name: str, kind: T.DataType, formats: Sequence[str]) -> list[Column]:
    """(number, real, digest, text), of which one is filled: equal exactly when the values are."""
    column = F.col(f"`{name}`")
    nothing = [F.lit(None).cast(t) for t in ("long", "double", "binary", "string")]
    number = _number(name, kind)
    if number is not None:
        return [number, *nothing[1:]]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        real = column.cast("double")
        return [nothing[0], F.when(~F.isnan(real), real + F.lit(0.0)), *nothing[2:]]
    text = F.hex(column) if isinstance(kind, T.BinaryType) else column.cast("string")
    if is_numeric(kind):
        return [*nothing[:2], F.unhex(F.md5(text.cast("binary"))), nothing[3]]
    datelike = F.coalesce(may_be_date(text, formats), F.lit(False))
    return [
        *nothing[:2],
        F.when(~datelike, F.unhex(F.md5(text.cast("binary")))),
        F.when(datelike, text),
    ]


def _day_of(df: DataFrame, formats: Formats) -> Column:
    """The calendar day of a counted value; numbers have none."""
    by_formats: dict[tuple[str, ...], list[int]] = {}
    for p, f in enumerate(df.schema.fields):
        by_formats.setdefault(tuple(_formats(formats, f.name)), []).append(p)
    parsed = F.lit(None).cast("date")
    for forms, places in by_formats.items():
        read = F.to_date(lenient_timestamp(F.col("text"), forms))
        parsed = F.when(F.col("position").isin(places), read).otherwise(parsed)
    kinds = {p: f.dataType for p, f in enumerate(df.schema.fields)}

    def positions(kind: type) -> Column:
        return F.col("position").isin([p for p, k in kinds.items() if isinstance(k, kind)])

    number = F.col("number")
    return (
        F.when(positions(T.DateType), F.date_from_unix_date(number.cast("int")))
        .when(positions(T.TimestampType), F.to_date(F.timestamp_micros(number)))
        .when(positions(T.TimestampNTZType), F.date_from_unix_date(F.floor(number / _MICROS_A_DAY).cast("int")))
        .otherwise(parsed)
    )


_KEY = ["number", "real", "digest", "text"]


def value_counts(df: DataFrame, formats: Formats = DATE_FORMATS) -> DataFrame:
    """(position, number, real, digest, text, n) for every distinct value of every column, NULL included."""
    each = [
        F.struct(
            F.lit(p).alias("position"),
            *[k.alias(c) for c, k in zip(_KEY, _value_key(f.name, f.dataType, _formats(formats, f.name)), strict=True)],
        )
        for p, f in enumerate(df.schema.fields)
    ]
    stacked = df.select(F.explode(F.array(*each)).alias("each")).select("each.*")
    return stacked.groupBy("position", *_KEY).agg(F.count("*").alias("n"))


def _exact_counts(df: DataFrame, formats: Formats) -> DataFrame:
    filled = F.greatest(*[F.col(c).isNotNull() for c in _KEY])
    return (
        value_counts(df, formats)
        .withColumns({"filled": filled, "day": _day_of(df, formats)})
        .groupBy("position")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count_if("filled").alias("cardinality"),
            F.sum(F.when(F.col("filled"), F.col("n"))).alias("non_null"),
            F.sum(F.when(F.col("day").isNotNull(), F.col("n"))).alias("parsed"),
            F.count_distinct("day").alias("day_cardinality"),
        )
    )


def _day(name: str, kind: T.DataType, formats: Sequence[str]) -> Column:
    """The calendar day of a value, from the value itself; numbers have none."""
    column = F.col(f"`{name}`")
    if is_numeric(kind):
        return F.lit(None).cast("date")
    if is_temporal(kind):
        return F.to_date(column.cast("timestamp_ntz"))
    text = F.hex(column) if isinstance(kind, T.BinaryType) else column.cast("string")
    return F.to_date(lenient_timestamp(text, formats))


def column_sketches(df: DataFrame, formats: Formats = DATE_FORMATS) -> DataFrame:
    """(position, n_rows, non_null, parsed, value_sketch, day_sketch), a row a column, in one
    pass; what a task sends on is a few kilobytes a column."""
    sums, rows = [F.count("*").alias("n_rows")], []
    read = df.select("*", *[_day(f.name, f.dataType, _formats(formats, f.name)).alias(f"day {p}") for p, f in enumerate(df.schema.fields)])
    for p, f in enumerate(df.schema.fields):
        column, day = F.col(f"`{f.name}`"), F.col(f"`day {p}`")
        if is_float(f.dataType) and not isinstance(f.dataType, T.DecimalType):
            real = column.cast("double")
            column = F.when(~F.isnan(real), real + F.lit(0.0))
        hashed = F.when(column.isNotNull(), F.xxhash64(column))
        sums += [
            F.count(column).alias(f"filled {p}"),
            F.count(day).alias(f"parsed {p}"),
            F.hll_sketch_agg(hashed, SKETCH_BITS).alias(f"values {p}"),
            F.hll_sketch_agg(F.unix_date(day), SKETCH_BITS).alias(f"days {p}"),
        ]
        named = {"non_null": "filled", "parsed": "parsed", "value_sketch": "values", "day_sketch": "days"}
        rows.append(F.struct(F.lit(p).alias("position"), "n_rows", *[F.col(f"`{c} {p}`").alias(n) for n, c in named.items()]))
    return read.agg(*sums).select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """The sketches of a table from those of its parts, which share no rows."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("position")
        .agg(
            *[F.sum(c).alias(c) for c in ("n_rows", "non_null", "parsed")],
            *[F.hll_union_agg(c).alias(c) for c in ("value_sketch", "day_sketch")],
        )
    )


def _estimates(sketches: DataFrame) -> DataFrame:
    """Counts per column; an estimate is never above the number of values there are."""
    return sketches.select(
        "position",
        "n_rows",
        F.least(F.hll_sketch_estimate("value_sketch"), "non_null").alias("cardinality"),
        "non_null",
        "parsed",
        F.least(F.hll_sketch_estimate("day_sketch"), "parsed").alias("day_cardinality"),
    )


def column_statistics(
    df: DataFrame, formats: Formats = DATE_FORMATS, sketches: DataFrame | bool = False
) -> DataFrame:
    """Counts per column, from one pass over the table; see profile_columns for ``sketches``."""
    if sketches is False:
        counted = _exact_counts(df, formats)
    else:
        counted = _estimates(column_sketches(df, formats) if sketches is True else sketches)
    counts = ["n_rows", "cardinality", "non_null", "parsed", "day_cardinality"]
    return columns_of(df).join(counted, "position", "left").fillna(0, counts)


def profile_columns(
    df: DataFrame, formats: Formats = DATE_FORMATS, sketches: DataFrame | bool = False
) -> DataFrame:
    """One row per column, without sample values.

    The date rate covers all values, not only the first ones. With ``sketches`` the distinct
    counts are estimates, for tables whose distinct values are too many to be shuffled:
    True makes the sketches, a frame of merged_sketches is used as it is.
    """
    ratio = F.coalesce(F.try_divide("cardinality", "n_rows"), F.lit(0.0))
    return column_statistics(df, formats, sketches).select(
        "position",
        "name",
        "dtype",
        "n_rows",
        "cardinality",
        ratio.alias("cardinality_ratio"),
        F.coalesce(1.0 - F.try_divide("non_null", "n_rows"), F.lit(0.0)).alias("null_rate"),
        F.coalesce(F.try_divide("parsed", "non_null"), F.lit(0.0)).alias("date_parse_rate"),
        "day_cardinality",
        "is_numeric",
        likely_id(ratio, F.col("is_float")).alias("is_likely_id"),
    )


def likely_id(ratio: Column, float_column: Column) -> Column:
    return (ratio > ID_RATIO) & ~float_column


def _first_values(df: DataFrame, names: Sequence[str], order_by: Sequence[str], n: int) -> DataFrame:
    """(name, at, value) of the first n filled values of each column, in one scan; every
    task keeps only n of a column before the shuffle."""
    each = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in names]
    stacked = df.select(F.struct(*order_by).alias("at"), F.explode(F.array(*each)).alias("each"))
    order = Window.partitionBy("name").orderBy("at")
    return (
        stacked.select("at", "each.*")
        .filter("value IS NOT NULL")
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= n)
    )


def sample_values(df: DataFrame, order_by: Sequence[str], n: int = SAMPLE_VALUES) -> DataFrame:
    """(name, sample_values): the first n filled values as text.

    A distributed table has no row order of its own, so one must be named.
    """
    texts = F.array_sort(F.collect_list(F.struct("_place", "value")))
    found = _first_values(df, df.columns, order_by, n).groupBy("name").agg(texts.alias("texts"))
    names = columns_of(df).select("name")
    nothing = F.array().cast("array<string>")
    return names.join(found, "name", "left").select(
        "name", F.coalesce(F.col("texts.value"), nothing).alias("sample_values")
    )


def sampled_date_rates(
    df: DataFrame,
    order_by: Sequence[str],
    n: int = DATE_SAMPLE,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """(name, date_parse_rate) judged on the first n filled values; numbers score 0."""
    schema = columns_of(df)
    words = [f.name for f in df.schema.fields if not is_numeric(f.dataType)]
    if not words:
        return schema.select("name", F.lit(0.0).alias("date_parse_rate"))
    read = F.col("is_temporal") | lenient_timestamp(F.col("value"), formats).isNotNull()
    rates = (
        _first_values(df, words, order_by, n)
        .join(F.broadcast(schema.select("name", "is_temporal")), "name")
        .groupBy("name")
        .agg(F.avg(F.when(read, 1.0).otherwise(0.0)).alias("rate"))
    )
    return schema.join(rates, "name", "left").select(
        "name", F.coalesce("rate", F.lit(0.0)).alias("date_parse_rate")
    )


def full_profile(
    df: DataFrame, order_by: Sequence[str], formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    return profile_columns(df, formats).join(sample_values(df, order_by), "name")


def schema_fingerprint(profiles: DataFrame) -> DataFrame:
    """SHA-256 over the sorted (name, dtype) pairs; as many pairs as columns."""
    pairs = F.array_sort(F.collect_list(F.struct("name", "dtype")))
    return profiles.agg(F.sha2(F.to_json(pairs), 256).alias("fingerprint"))
