"""Adapters: the driver's TPC-H-like tables presented as raw e-commerce tables.

The test tables are a star schema (customer, nation, region, orders, lineitem, part)
plus an ``events`` stream. These functions map them onto the logical raw tables the
cleaning jobs expect. The mapping is ours; every value is derived from the given rows
so the work grows with the tables.

=================  ===========================================================
customers          customer_id = c_custkey; customer_unique_id = c_custkey div 2
                   (a person owns up to two accounts, possibly in two cities);
                   customer_city = n_name; customer_state = r_name
orders             order_id = o_orderkey; customer_id = o_custkey;
                   order_status from o_orderstatus (F delivered, O processing,
                   P shipped); order_purchase_timestamp = o_orderdate
order items        order_id = l_orderkey; product_id = l_partkey;
                   price = l_extendedprice; freight_value = l_quantity
products           product_id = p_partkey; product_category_name = p_type, NULL
                   for PROMO (so the 'unknown' fill rule is exercised)
reviews            review_id = event_id; order_id = event_id div 2 (low orders get
                   two reviews, the rest none); review_score = value % 7, a
                   fractional raw score (0 and 6 fall out of range)
=================  ===========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Columns of the test tables, given to the scans so that building a query
# reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) have a fixed size at every scale factor,
    # so broadcasting them is bounded.
    geo = (
        table(spark, sf_dir, "nation")
        .join(
            table(spark, sf_dir, "region"),
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .select("n_nationkey", "n_name", "r_name")
    )
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey")
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey div 2").alias("customer_unique_id"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )
    )


# Order-status letters of the test data mapped to status words.
STATUS_WORDS = {"F": "delivered", "O": "processing", "P": "shipped"}


def _status(c: str) -> F.Column:
    expr = None
    for letter, word in STATUS_WORDS.items():
        expr = (F.when if expr is None else expr.when)(F.col(c) == letter, F.lit(word))
    return expr


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _status("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        # the test data has no delivery time: a week after the purchase
        (F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("order_delivered_customer_date"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.expr("nullif(p_type, 'PROMO')").alias("product_category_name"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("payment_value")
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name")
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and state of every customer (many repeated rows, like the real file)."""
    return raw_customers(spark, sf_dir).select(
        F.col("customer_city").alias("geolocation_city"),
        F.col("customer_state").alias("geolocation_state"),
    )


def raw_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lower("p_type").alias("product_category_name"),
        F.col("p_type").alias("product_category_name_english"),
    ).distinct()


def raw_products_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with every descriptive column of ``part`` (for the wide cleaning variant)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.expr("nullif(p_type, 'PROMO')").alias("product_category_name"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_size").alias("product_size"),
        F.col("p_retailprice").alias("product_retail_price"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.expr("event_id div 2").alias("order_id"),
        (F.col("value") % 7).alias("review_score"),
    )


RAW_ADAPTERS = {
    "customers": raw_customers,
    "orders": raw_orders,
    "items": raw_items,
    "products": raw_products,
    "reviews": raw_reviews,
    "payments": raw_payments,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "translation": raw_translation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in RAW_ADAPTERS.items()}


def cleaned_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw adapters passed through the cleaning rules (lazy; gates not run)."""
    from basketry.plans.clean import CLEANERS

    return {name: cleaner.clean(RAW_ADAPTERS[name](spark, sf_dir)) for name, cleaner in CLEANERS.items()}
