"""The daily tables kept up to date by day or month.

They lie in folders by period. When orders, items or payments arrive or change, only the
periods of the orders concerned are summed again, from all rows of those orders, and
their folders replaced; all others stay as they are. With orders kept by period too (see
orders_by_period) only those periods' orders are read. Days suit tables with many rows a day, months
those with few.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.operators import marts as mt
from rootlens.sources import sinks, versions

DAILY = ("fact_daily_metrics", "metric_by_geography", "metric_by_product", "metric_by_payment")
PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
PERIOD = "period"


def _period(date: Column, unit: str) -> Column:
    return F.date_format(date, PERIODS[unit])


def _write_periods(rows: DataFrame, path: str) -> None:
    """Replace the folders of the periods that ``rows`` has, and no others."""
    writer = rows.repartition(PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PERIOD).parquet(path)


def _read(like: DataFrame, path: str) -> DataFrame:
    """The table without its folders' names."""
    named = T.StructType([*like.schema.fields, T.StructField(PERIOD, T.StringType())])
    return like.sparkSession.read.schema(named).parquet(path)


def orders_by_period(orders: DataFrame, base: str, unit: str = "day") -> DataFrame:
    """The raw orders in folders by period; orders without a date have none, and enter no table."""
    dated = orders.withColumn(PERIOD, _period(F.to_date("order_purchase_timestamp"), unit)).filter(F.col(PERIOD).isNotNull())
    _write_periods(dated, f"{base}/orders")
    return _read(orders, f"{base}/orders")


def _store_periods(built: Mapping[str, DataFrame], base: str, unit: str) -> None:
    for name in DAILY:
        _write_periods(built[name].withColumn(PERIOD, _period(F.col("metric_date"), unit)), f"{base}/{name}")


def read_daily(like: Mapping[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """The daily tables, with the columns of ``like``."""
    return {name: _read(like[name], f"{base}/{name}").select(like[name].columns) for name in DAILY}


def _plain(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {**raw, "orders": raw["orders"].drop(PERIOD)}


def build_daily(raw: Mapping[str, DataFrame], base: str, unit: str = "day") -> dict[str, DataFrame]:
    """All periods, from all rows."""
    built = mt.build_marts(_plain(raw), sinks.store_under(f"{base}/build"))
    _store_periods(built, base, unit)
    return read_daily(built, base)


def changed_days(orders: DataFrame, *batches: DataFrame) -> list[dt.date]:
    """The days of the orders whose ids stand in any of ``batches`` (new orders, items, payments).

    As many rows as calendar days reach the driver. An order that moved to another day is
    found under its new one only: its old row goes in as a batch with its own date beside it."""
    ids = reduce(DataFrame.union, [b.select("order_id") for b in batches]).dropna().distinct()
    days = orders.join(ids, "order_id", "left_semi").select(F.to_date("order_purchase_timestamp").alias("day"))
    return sorted(r["day"] for r in days.dropna().distinct().collect())


def _only(raw: Mapping[str, DataFrame], periods: Sequence[str], unit: str) -> dict[str, DataFrame]:
    """The raw tables with the orders of those periods, and the items and payments of these orders."""
    orders, wanted = raw["orders"], sorted(periods)
    if PERIOD in orders.columns:
        orders = orders.filter(F.col(PERIOD).isin(wanted)).drop(PERIOD)
    else:
        orders = orders.filter(_period(F.to_date("order_purchase_timestamp"), unit).isin(wanted))
    ids = orders.select("order_id").dropna().distinct()
    own = {t: raw[t].join(ids, "order_id", "left_semi") for t in ("order_items", "payments")}
    return {**raw, "orders": orders, **own}


def refresh(raw: Mapping[str, DataFrame], days: Sequence[dt.date], base: str, unit: str = "day") -> dict[str, DataFrame]:
    """Sum the periods of ``days`` again from the raw tables as they are now, and replace them.

    A period that has no rows any more loses its folder. The new rows are complete in a table of
    their own before the first folder changes; a refresh that is tried again gives the same."""
    if not days:
        return read_daily(mt.build_marts(_plain(raw)), base)
    periods = {d.strftime({"day": "%Y-%m-%d", "month": "%Y-%m"}[unit]) for d in days}
    built = mt.build_marts(_only(raw, list(periods), unit), sinks.store_under(f"{base}/refresh"))
    _store_periods(built, base, unit)
    for name in DAILY:
        found = built[name].select(_period(F.col("metric_date"), unit).alias("p")).distinct().collect()
        for gone in periods - {r["p"] for r in found}:
            versions.remove(built[name].sparkSession, f"{base}/{name}/{PERIOD}={gone}")
    return read_daily(built, base)
