"""Which spelling of dates each text column uses.

Day-first and month-first dates look alike as long as no day is above 12, and a column is
written one way. So the spellings are tallied over all values of a column, and the order
that reads more of them holds for the whole column; where both read all, it is in doubt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.functions.scalars import DATE_FORMATS, DAY_FIRST_FORMATS, lenient_timestamp

MONTH_FIRST, DAY_FIRST = "month first", "day first"
_ORDERS = {MONTH_FIRST: DATE_FORMATS, DAY_FIRST: DAY_FIRST_FORMATS}


def spelling_tally(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(name, spelling, filled, parsed): how many values of each text column each single
    spelling reads, ISO among them. One pass, and one row from each task."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in (columns or df.columns) if isinstance(kinds[c], T.StringType)]
    forms = ["ISO 8601", *dict.fromkeys([*DATE_FORMATS, *DAY_FIRST_FORMATS])]
    sums, rows = [], []
    for i, name in enumerate(names):
        text = F.col(f"`{name}`")
        sums.append(F.count_if(F.trim(text) != "").alias(f"f{i}"))
        for j, form in enumerate(forms):
            read = lenient_timestamp(text, [form] if j else [])
            if j:  # ISO dates are read whatever else is asked for
                read = F.when(lenient_timestamp(text, []).isNull(), read)
            sums.append(F.count(read).alias(f"p{i}_{j}"))
            rows.append(F.struct(F.lit(name).alias("name"), F.lit(form).alias("spelling"), F.col(f"f{i}").alias("filled"), F.col(f"p{i}_{j}").alias("parsed")))
    if not names:
        return df.sparkSession.createDataFrame([], "name string, spelling string, filled bigint, parsed bigint")
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def date_orders(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(name, filled, month_first, day_first, date_order, in_doubt) of the text columns that hold dates.

    ``in_doubt`` says that both orders read all the dates there are, though not as the same days."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in (columns or df.columns) if isinstance(kinds[c], T.StringType)]
    shape = "name string, filled bigint, month_first bigint, day_first bigint, differ bigint"
    if not names:
        found = df.sparkSession.createDataFrame([], shape)
    else:
        sums, rows = [], []
        for i, name in enumerate(names):
            text = F.col(f"`{name}`")
            month, day = (lenient_timestamp(text, _ORDERS[o]) for o in (MONTH_FIRST, DAY_FIRST))
            sums += [
                F.count_if(F.trim(text) != "").alias(f"filled{i}"),
                F.count(month).alias(f"month_first{i}"),
                F.count(day).alias(f"day_first{i}"),
                F.count_if(month != day).alias(f"differ{i}"),
            ]
            rows.append(F.struct(F.lit(name).alias("name"), *[F.col(f"{c}{i}").alias(c) for c in ("filled", "month_first", "day_first", "differ")]))
        found = df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    order = F.when(F.col("day_first") > F.col("month_first"), DAY_FIRST).otherwise(MONTH_FIRST)
    doubt = (F.col("day_first") == F.col("month_first")) & (F.col("differ") > 0)
    return found.filter(F.greatest("month_first", "day_first") > 0).select(
        "name", "filled", "month_first", "day_first", order.alias("date_order"), doubt.alias("in_doubt")
    )


def formats_of(orders: DataFrame) -> tuple[dict[str, Sequence[str]], list[str]]:
    """The formats that each column is read with, and the columns whose order is in doubt; a row a column."""
    rows = orders.collect()
    return {r["name"]: _ORDERS[r["date_order"]] for r in rows}, sorted(r["name"] for r in rows if r["in_doubt"])
