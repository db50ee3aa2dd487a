"""Daily fact table and the three breakdown tables.

The large tables meet only after they have been summed to the grain that the
result needs: items to orders, orders to (customer, day), lines to
(order, category). Map-side combining therefore shrinks any hot order or
customer before it is shuffled, and COUNT DISTINCT becomes a plain count of
rows that are already unique. ``order_id``, ``customer_id`` and ``product_id``
are the declared keys of their staging tables; the quality suite checks them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.functions.scalars import label_by_code, label_by_list
from rootlens.operators.skew import salted_lookup_join
from rootlens.operators.staging import counted_orders, stage_all

# State code -> region.
REGIONS = {
    "Southeast": ("SP", "RJ", "MG", "ES"),
    "South": ("PR", "SC", "RS"),
    "Northeast": ("BA", "SE", "AL", "PE", "PB", "RN", "CE", "PI", "MA"),
    "Central-West": ("GO", "MT", "MS", "DF"),
    "North": ("AM", "PA", "AC", "RO", "RR", "AP", "TO"),
}
# Product category -> group.
CATEGORY_GROUPS = {
    "Electronics": (
        "computers_accessories",
        "electronics",
        "computers",
        "tablets_printing_image",
        "telephony",
        "consoles_games",
    ),
    "Home & Furniture": (
        "furniture_decor",
        "furniture_living_room",
        "furniture_bedroom",
        "furniture_mattress_and_upholstery",
        "office_furniture",
        "bed_bath_table",
        "home_comfort",
        "home_comfort_2",
        "home_confort",
    ),
    "Fashion & Sports": (
        "sports_leisure",
        "fashion_bags_accessories",
        "fashion_shoes",
        "fashion_sport",
        "fashion_underwear_beach",
        "fashion_male_clothing",
        "fashion_female_clothing",
        "fashion_childrens_clothes",
    ),
    "Health & Beauty": ("health_beauty", "perfumery", "diapers_and_hygiene"),
    "Kids & Toys": ("toys", "baby", "cool_stuff"),
    "Auto & Tools": (
        "auto",
        "garden_tools",
        "construction_tools_construction",
        "construction_tools_safety",
        "construction_tools_lights",
    ),
}
# Payment code -> display name.
PAYMENT_NAMES = {
    "credit_card": "Credit Card",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "debit_card": "Debit Card",
}


# -- dimensions -------------------------------------------------------------


def dim_geography(customers: DataFrame) -> DataFrame:
    code = F.col("customer_state")
    return (
        customers.filter(code.isNotNull())
        .select(code.alias("state_code"))
        .distinct()
        .withColumn("region", label_by_list(F.col("state_code"), REGIONS, "Unknown"))
    )


def dim_product(products: DataFrame) -> DataFrame:
    category = F.col("product_category")
    return (
        products.filter(category.isNotNull())
        .select("product_category")
        .distinct()
        .withColumn("product_category_group", label_by_list(category, CATEGORY_GROUPS, "Other"))
    )


def dim_payment(payments: DataFrame) -> DataFrame:
    code = F.col("payment_type")
    return (
        payments.filter(code.isNotNull())
        .select("payment_type")
        .distinct()
        .withColumn("payment_type_display", label_by_code(code, PAYMENT_NAMES, "Other"))
    )


# -- building blocks ----------------------------------------------------------


def line_total(items: DataFrame, column: str = "total_item_value") -> Column:
    """Sum of a money column over lines.

    Decimals with cents add up as whole numbers, which is cheaper to shuffle and
    to add than 128-bit decimals and just as exact.
    """
    kind = items.schema[column].dataType
    if not isinstance(kind, T.DecimalType) or kind.scale > 2:
        return F.sum(column)
    cents = F.sum((F.col(column) * 100).cast("bigint")).cast("decimal(20,0)")
    return (cents * F.lit(Decimal("0.01"))).cast("decimal(21,2)")


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        line_total(items).alias("order_revenue"),
        F.count("total_item_value").alias("item_count"),
    )


def order_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per counted order and status; the group-by keeps the join's partitioning.

    ``order_rows`` is 1 unless the order was loaded more than once. An order that
    was loaded with several statuses or customers must count once: ``of_customer``
    is 1 on one row of each (order, day, customer), ``of_day`` on one of each (order, day);
    ``customers_of_day`` is how many customers the order has on that day.
    """
    rest = ["order_status", "customer_id"]
    of_customer = Window.partitionBy("order_id", "order_date", "customer_id").orderBy(*rest)
    order_day = Window.partitionBy("order_id", "order_date")
    of_day = order_day.orderBy(*rest)

    def first(window) -> Column:
        return (F.row_number().over(window) == 1).cast("bigint")

    return (
        counted_orders(orders)
        .select("order_id", "order_date", "customer_id", "order_status")
        .join(items_per_order(items), "order_id")
        .groupBy("order_id", "order_date", "customer_id", "order_status")
        .agg(
            F.sum("order_revenue").alias("order_revenue"),
            F.sum("item_count").alias("item_count"),
            F.count("order_revenue").cast("decimal(10,0)").alias("order_rows"),
        )
        .withColumns({"of_customer": first(of_customer), "of_day": first(of_day)})
        .withColumn("customers_of_day", F.sum("of_customer").over(order_day))
    )


def shared_orders(revenue: DataFrame) -> DataFrame:
    """(order_id, order_date, customer_id) of the orders that several customers have on one day.

    An order belongs to one customer unless it was loaded anew for another one, so these are
    few beside the customer days; they are all that COUNT DISTINCT needs beyond those."""
    several = F.col("customers_of_day") > 1
    return revenue.filter(several & (F.col("of_customer") == 1)).select("order_id", "order_date", "customer_id")


def customer_days(revenue: DataFrame) -> DataFrame:
    """What each customer bought on each day: feeds the fact and geography tables."""
    return revenue.groupBy("order_date", "customer_id").agg(
        F.sum("of_customer").alias("orders"),
        F.sum("of_day").alias("orders_of_day"),
        F.count("order_revenue").alias("valued_orders"),
        F.sum("order_revenue").alias("revenue"),
        F.min("order_revenue").alias("smallest"),
        F.max("order_revenue").alias("largest"),
        F.sum("item_count").alias("items"),
    )


def _cents(amount: Column) -> Column:
    return F.round(amount, 2)


def _mean(total: Column, count: Column) -> Column:
    return _cents(F.try_divide(total, count))


def primary_payment(payments: DataFrame) -> DataFrame:
    """Payment type of each order's first payment; ``copies`` keeps repeated rows."""
    return (
        payments.filter(F.col("payment_sequential") == 1)
        .groupBy("order_id", "payment_type")
        .agg(F.count("*").cast("decimal(10,0)").alias("copies"))
    )


def lowest_per_key(rows: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """The row of each key that sorts first. A combinable MIN, so no hot key is sorted whole."""
    first = F.min(F.struct(*order_by, *[c for c in rows.columns if c not in {key, *order_by}]))
    return rows.groupBy(key).agg(first.alias("_first")).select(key, "_first.*")


# -- marts ----------------------------------------------------------------------


def fact_daily_metrics(by_customer_day: DataFrame) -> DataFrame:
    date = F.col("metric_date")
    return (
        by_customer_day.groupBy(F.col("order_date").alias("metric_date"))
        .agg(
            F.sum("orders_of_day").alias("order_count"),
            F.count("customer_id").alias("customer_count"),
            F.sum("revenue").alias("_revenue"),
            F.sum("valued_orders").alias("_valued"),
            F.min("smallest").alias("_smallest"),
            F.max("largest").alias("_largest"),
        )
        .select(
            "metric_date",
            "order_count",
            "customer_count",
            _cents(F.col("_revenue")).alias("total_revenue"),
            _mean(F.col("_revenue"), F.col("_valued")).alias("avg_order_value"),
            _cents(F.col("_smallest")).alias("min_order_value"),
            _cents(F.col("_largest")).alias("max_order_value"),
            F.year(date).alias("metric_year"),
            F.month(date).alias("metric_month"),
            (F.dayofweek(date) - 1).alias("day_of_week"),
        )
    )


def metric_by_geography(
    by_customer_day: DataFrame, shared: DataFrame, customers: DataFrame, geography: DataFrame
) -> DataFrame:
    """A customer has at most one row per day here, so no customer is hot in the join.

    A customer who was loaded several times multiplies the amounts, as in a join
    of rows, but not the orders. Orders are distinct within a state: the customer days count
    one of ``shared`` (see shared_orders) once for each of its customers, and what
    is too much where several of them live in one state is taken off.
    """
    # the customers grow with the orders, but their files compress well and the optimiser takes
    # the salted copies for single rows: without the hint the driver builds them all as a broadcast
    states = (
        customers.groupBy("customer_id", "customer_state")
        .agg(F.count("*").cast("decimal(10,0)").alias("copies"))
        .hint("merge")
    )
    copies = F.col("copies")
    daily = (
        by_customer_day.join(states, "customer_id")
        .groupBy(F.col("order_date").alias("metric_date"), F.col("customer_state").alias("state_code"))
        .agg(
            F.sum("orders").alias("_orders"),
            F.sum(F.col("revenue") * copies).alias("_revenue"),
            F.sum(F.col("items") * copies).alias("_items"),
        )
    )
    # a customer may have very many of the shared orders: the salted lookup spreads them
    repeated = (
        salted_lookup_join(shared, states.select("customer_id", "customer_state"), "customer_id", ["order_id"])
        .groupBy("order_id", "order_date", "customer_state")
        .agg((F.count("*") - 1).alias("extra"))
        .filter("extra > 0")
        .groupBy(F.col("order_date").alias("metric_date"), F.col("customer_state").alias("state_code"))
        .agg(F.sum("extra").alias("_extra"))
    )
    return daily.join(repeated, ["metric_date", "state_code"], "left").join(geography, "state_code").select(
        "metric_date",
        "state_code",
        "region",
        (F.col("_orders") - F.coalesce("_extra", F.lit(0))).alias("order_count"),
        _cents(F.col("_revenue")).alias("total_revenue"),
        _mean(F.col("_revenue"), F.col("_items")).alias("avg_item_value"),
    )


def metric_by_product(
    orders: DataFrame, items: DataFrame, products: DataFrame, groups: DataFrame
) -> DataFrame:
    """Lines look up their category first, then shrink to (order, category).

    An order that spans several lines of one category must count once, so the
    category is needed before orders are counted. Best-selling products make
    that lookup skewed: it is the salted one.
    """
    lines = salted_lookup_join(
        items.select("order_id", "order_item_id", "product_id", "total_item_value"),
        products.select("product_id", "product_category"),
        "product_id",
        ["order_id", "order_item_id"],
    )
    per_order = lines.groupBy("order_id", "product_category").agg(
        line_total(lines).alias("revenue"), F.count("total_item_value").alias("items")
    )
    daily = (
        counted_orders(orders)
        .select("order_id", "order_date")
        .join(per_order, "order_id")
        .groupBy("order_id", "order_date", "product_category")
        .agg(F.sum("revenue").alias("revenue"), F.sum("items").alias("items"))
        .groupBy(F.col("order_date").alias("metric_date"), "product_category")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("revenue").alias("_revenue"),
            F.sum("items").alias("_items"),
        )
    )
    return daily.join(groups, "product_category").select(
        "metric_date",
        "product_category",
        "product_category_group",
        "order_count",
        _cents(F.col("_revenue")).alias("total_revenue"),
        _mean(F.col("_revenue"), F.col("_items")).alias("avg_item_value"),
    )


def metric_by_payment(revenue: DataFrame, payments: DataFrame, names: DataFrame) -> DataFrame:
    """Items are summed to orders before payments join, so neither multiplies the other."""
    copies = F.col("copies")
    per_order = (
        revenue.join(primary_payment(payments), "order_id")
        .groupBy("order_id", "order_date", "payment_type")
        .agg(
            F.sum(F.col("order_revenue") * copies).alias("revenue"),
            F.sum(F.col("order_rows") * copies).alias("rows"),
        )
    )
    daily = per_order.groupBy(F.col("order_date").alias("metric_date"), "payment_type").agg(
        F.count("*").alias("order_count"),
        F.sum("revenue").alias("_revenue"),
        F.sum("rows").alias("_rows"),
    )
    return daily.join(names, "payment_type").select(
        "metric_date",
        "payment_type",
        "payment_type_display",
        "order_count",
        _cents(F.col("_revenue")).alias("total_revenue"),
        _mean(F.col("_revenue"), F.col("_rows")).alias("avg_order_value"),
    )


def _as_given(name: str, df: DataFrame) -> DataFrame:
    return df


def build_marts(
    raw: Mapping[str, DataFrame], store: Callable[[str, DataFrame], DataFrame] = _as_given
) -> dict[str, DataFrame]:
    """Every staging view, dimension, fact and breakdown table.

    Lazy by default. With a ``store`` (see sinks.store_under) the joins of orders
    with their items run once: order revenue feeds the payment table and the
    customer days, and those feed the fact and geography tables.
    """
    staged = stage_all(raw)
    orders, items = staged["stg_orders"], staged["stg_order_items"]
    revenue = store("order_revenue", order_revenue(orders, items))
    by_customer_day = store("customer_days", customer_days(revenue))
    geography = store("dim_geography", dim_geography(staged["stg_customers"]))
    groups = store("dim_product", dim_product(staged["stg_products"]))
    names = store("dim_payment", dim_payment(staged["payments"]))
    built = {
        "dim_geography": geography,
        "dim_product": groups,
        "dim_payment": names,
        "fact_daily_metrics": store("fact_daily_metrics", fact_daily_metrics(by_customer_day)),
        "metric_by_geography": store(
            "metric_by_geography",
            metric_by_geography(by_customer_day, shared_orders(revenue), staged["stg_customers"], geography),
        ),
        "metric_by_product": store(
            "metric_by_product", metric_by_product(orders, items, staged["stg_products"], groups)
        ),
        "metric_by_payment": store(
            "metric_by_payment", metric_by_payment(revenue, staged["payments"], names)
        ),
    }
    return {**staged, **built}
