"""Raw order tables read from the star-schema parquet files.

The files carry nation, brand and priority numbers where the analysis expects
state codes, category names and payment codes; fixed lists translate them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# position = nation key. The last one is no known state.
STATES = (
    "SP RJ MG ES PR SC RS BA SE AL PE PB RN CE PI MA GO MT MS DF AM PA AC RO ZZ".split()
)
# position = brand number - 1; later brands have no translation.
CATEGORIES = (
    "computers_accessories electronics telephony consoles_games furniture_decor "
    "bed_bath_table office_furniture home_comfort sports_leisure fashion_shoes "
    "fashion_sport health_beauty perfumery diapers_and_hygiene toys baby cool_stuff "
    "auto garden_tools stationery"
).split()
# Order status letter -> status name.
STATUSES = {"F": "delivered", "O": "shipped", "P": "canceled"}
# Order priority -> payment code.
PAYMENTS = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "debit_card",
    "5-LOW": "not_defined",
}


def _pick(names: list[str], position) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), position)


def _recode(column: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), column)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    never = F.lit(None).cast("timestamp_ntz")
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _recode(F.col("o_orderstatus"), STATUSES).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        never.alias("order_approved_at"),
        never.alias("order_delivered_carrier_date"),
        # Delivery takes one hour per order-key unit modulo 240.
        F.expr("o_orderdate + make_dt_interval(0, cast(pmod(o_orderkey, 240) as int))").alias(
            "order_delivered_customer_date"
        ),
        never.alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    freight = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        _pick(STATES, F.col("c_nationkey")).alias("customer_state"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("int")
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_category_name"),
        F.length("p_name").alias("product_name_length"),
        none.alias("product_description_length"),
        none.alias("product_photos_qty"),
        F.col("p_size").alias("product_weight_g"),
        none.alias("product_length_cm"),
        none.alias("product_height_cm"),
        none.alias("product_width_cm"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        _recode(F.col("o_orderpriority"), PAYMENTS).alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("payment_value"),
    )


def raw_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return (
        read_table(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .select(
            F.col("p_brand").alias("product_category_name"),
            _pick(CATEGORIES, number - 1).alias("product_category_name_english"),
        )
        .filter(F.col("product_category_name_english").isNotNull())
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        _pick(STATES, F.col("s_nationkey")).alias("seller_state"),
    )


def read_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "sellers": raw_sellers(spark, sf_dir),
        "payments": raw_payments(spark, sf_dir),
        "category_translation": raw_translation(spark, sf_dir),
    }
