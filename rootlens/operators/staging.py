"""Lazy cleaning views over the raw order tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootlens.functions.scalars import day, day_of_week, days_between
from rootlens.operators.skew import salted_lookup_join

# Orders in these states never count.
EXCLUDED_STATUSES = ("canceled", "unavailable")


def stage_orders(orders: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    return orders.filter(bought.isNotNull()).select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        day(bought).alias("order_date"),
        F.year(bought).alias("order_year"),
        F.month(bought).alias("order_month"),
        day_of_week(bought).alias("order_day_of_week"),
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        days_between(bought, F.col("order_delivered_customer_date")).alias("delivery_days"),
    )


def stage_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
    )


def stage_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_zip_code_prefix",
    )


def stage_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """A few category codes hold most products, so their rows are spread over tasks."""
    category = F.coalesce(
        F.col("product_category_name_english"), F.col("product_category_name"), F.lit("unknown")
    )
    joined = salted_lookup_join(products, translation, "product_category_name", ["product_id"], "left")
    return joined.select(
        "product_id",
        category.alias("product_category"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def counted_orders(staged_orders: DataFrame) -> DataFrame:
    """Orders that enter the metrics; a NULL status drops out as in SQL."""
    return staged_orders.filter(~F.col("order_status").isin(*EXCLUDED_STATUSES))


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_orders": stage_orders(raw["orders"]),
        "stg_order_items": stage_order_items(raw["order_items"]),
        "stg_customers": stage_customers(raw["customers"]),
        "stg_products": stage_products(raw["products"], raw["category_translation"]),
        "payments": raw["payments"],
    }
