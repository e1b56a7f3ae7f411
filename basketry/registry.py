"""Registered queries over the driver's test tables, each paired with oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> DuckDB SQL``.
Every query reads the given tables (through the adapters in ``sources.starschema``)
in full. Queries of the table-version and CSV operators write their inputs under the
session's checkpoint folder first.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from basketry.functions.casts import to_double, to_int_score, to_timestamp
from basketry.functions.money import money, money_out
from basketry.functions.text import fold_accents, normalize_city
from basketry.operators import profile as prof
from basketry.operators.mode import mode_by
from basketry.operators.ntile import Key, ntile_labels
from basketry.operators.quality import Gates, enforce, gate_report
from basketry.operators.topk import first_n, top_k
from basketry.oracle import with_ctes
from basketry.plans import clean, marts, rfm
from basketry.plans.clean import CLEANERS
from basketry.plans.pipeline import run_pipeline
from basketry.session import bound_tasks, scratch_path, stored
from basketry.sinks.versioned import SchemaMismatchError, VersionedTable
from basketry.sources import csv as csvsrc
from basketry.sources import lookup
from basketry.sources import starschema as star
from basketry.sources.quoted import read_quoted

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return deco


def cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Cleaned tables. The queries run on the session they are given, so the settings that
    their joins need are set here, not only in ``session.get_session``."""
    tables = star.cleaned_tables(spark, sf_dir)
    bound_tasks(spark, tables.values())
    return tables


def c360(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cleaned(spark, sf_dir)
    return marts.customer_360(t["orders"], t["items"], t["customers"], t["products"], t["reviews"])


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cleaned(spark, sf_dir)
    return marts.orders_enriched(t["orders"], t["items"], t["reviews"], t["customers"])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cleaned(spark, sf_dir)
    return marts.sales_by_state_category_month(t["items"], t["orders"], t["customers"], t["products"])


def segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.segment_rfm(c360(spark, sf_dir))


GRAIN_TIES = ("customer_unique_id", "customer_city")
ASC_GRAIN = "customer_unique_id ASC NULLS FIRST, customer_city ASC NULLS FIRST"

# ======================================================================== marts ==

@query("mart_customer_360", "SELECT * FROM c360")
def q_mart_customer_360(spark, sf_dir):
    return c360(spark, sf_dir)


@query(
    "mart_customer_basic",
    """
SELECT c.customer_unique_id, c.customer_city, count(DISTINCT o.order_id) AS total_orders,
       CAST(round(sum(CAST(i.price AS DECIMAL(28,8)) + CAST(i.freight_value AS DECIMAL(28,8))), 2)
            AS DOUBLE) AS total_lifetime_value,
       max(o.order_purchase_timestamp) AS last_purchase_date
FROM clean_orders o JOIN clean_items i ON i.order_id = o.order_id
JOIN clean_customers c ON c.customer_id = o.customer_id
GROUP BY c.customer_unique_id, c.customer_city""",
)
def q_mart_customer_basic(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    return marts.customer_basic(t["orders"], t["items"], t["customers"])


@query("mart_orders_enriched", "SELECT * FROM fact")
def q_mart_orders_enriched(spark, sf_dir):
    return fact(spark, sf_dir)


@query("mart_sales_state_category_month", "SELECT * FROM sales")
def q_mart_sales(spark, sf_dir):
    return sales(spark, sf_dir)


@query("rfm_recency", "SELECT * FROM rfm_base")
def q_rfm_recency(spark, sf_dir):
    return rfm.recency(c360(spark, sf_dir))


@query("rfm_scores", "SELECT * FROM rfm_scored")
def q_rfm_scores(spark, sf_dir):
    return rfm.scores(rfm.recency(c360(spark, sf_dir)))


@query("rfm_segments", "SELECT * FROM rfm_segmented")
def q_rfm_segments(spark, sf_dir):
    return segmented(spark, sf_dir)


@query(
    "rfm_segment_counts",
    "SELECT RFM_Segment, count(*) AS count FROM rfm_segmented GROUP BY RFM_Segment",
)
def q_rfm_segment_counts(spark, sf_dir):
    return rfm.segment_counts(segmented(spark, sf_dir))


@query(
    "topk_customers",
    f"SELECT * FROM c360 ORDER BY total_lifetime_value DESC NULLS LAST, {ASC_GRAIN} LIMIT 10",
)
def q_topk_customers(spark, sf_dir):
    return top_k(c360(spark, sf_dir), "total_lifetime_value", 10, tiebreak=GRAIN_TIES)


@query(
    "topk_orders",
    "SELECT * FROM fact ORDER BY total_revenue DESC NULLS LAST, order_id ASC NULLS FIRST, "
    "review_score ASC NULLS FIRST LIMIT 10",
)
def q_topk_orders(spark, sf_dir):
    return top_k(fact(spark, sf_dir), "total_revenue", 10, tiebreak=("order_id", "review_score"))


SALES_KEYS = ("order_year", "order_month", "customer_state", "product_category_name")


@query(
    "topk_sales",
    "SELECT * FROM sales ORDER BY total_sales DESC NULLS LAST, "
    + ", ".join(f"{k} ASC NULLS FIRST" for k in SALES_KEYS)
    + " LIMIT 10",
)
def q_topk_sales(spark, sf_dir):
    return top_k(sales(spark, sf_dir), "total_sales", 10, tiebreak=SALES_KEYS)


@query(
    "topk_segments",
    f"SELECT * FROM rfm_segmented ORDER BY total_lifetime_value DESC NULLS LAST, {ASC_GRAIN} LIMIT 10",
)
def q_topk_segments(spark, sf_dir):
    return top_k(segmented(spark, sf_dir), "total_lifetime_value", 10, tiebreak=GRAIN_TIES)


# table of the run -> (its relation in SQL, an order-free sum over its rows)
RUN_TABLES = {
    "customers": ("clean_customers", "customer_id"),
    "orders": ("clean_orders", "order_id"),
    "items": ("clean_items", "price"),
    "products": ("clean_products", "product_id"),
    "reviews": ("clean_reviews", "review_score"),
    "customer_360": ("c360", "total_lifetime_value"),
    "fact_orders_enriched": ("fact", "total_revenue"),
    "agg_sales_by_state_category_month": ("sales", "total_sales"),
    "segment_rfm": ("rfm_segmented", "R_Score * 100 + F_Score * 10 + M_Score"),
}


@query(
    "pipeline_end_to_end",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, CAST(0 AS BIGINT) AS version, count(*) AS rows, "
        f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE) AS checksum FROM {relation}"
        for name, (relation, value) in RUN_TABLES.items()
    ),
)
def q_pipeline(spark, sf_dir):
    raw = star.raw_tables(spark, sf_dir)
    bound_tasks(spark, [raw[name] for name in CLEANERS])
    tables = run_pipeline(spark, raw, scratch_path(spark, "pipeline"))
    parts = [
        tables[name].read().agg(
            F.lit(name).alias("table_name"),
            F.lit(tables[name].latest_version()).cast("long").alias("version"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.expr(value).cast("decimal(18,2)")).cast("double").alias("checksum"),
        )
        for name, (_, value) in RUN_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# ===================================================================== cleaning ==

for _name in ("customers", "orders", "items", "products", "reviews"):

    def _make(name):
        def fn(spark, sf_dir):
            return CLEANERS[name].clean(star.RAW_ADAPTERS[name](spark, sf_dir))

        return fn

    query(f"clean_{_name}", f"SELECT * FROM clean_{_name}")(_make(_name))


@query(
    "clean_products_wide",
    """
SELECT p_partkey AS product_id, COALESCE(lower(NULLIF(p_type, 'PROMO')), 'unknown') AS product_category_name,
       p_name AS product_name, p_brand AS product_brand, p_size AS product_size,
       p_retailprice AS product_retail_price
FROM part""",
)
def q_clean_products_wide(spark, sf_dir):
    return clean.clean_products_wide(star.raw_products_wide(spark, sf_dir))


# ================================================================== projections ==

@query(
    "prj_select",
    "SELECT order_id, customer_id, order_purchase_timestamp FROM raw_orders",
)
def q_prj_select(spark, sf_dir):
    return star.raw_orders(spark, sf_dir).select("order_id", "customer_id", "order_purchase_timestamp")


@query(
    "prj_replace",
    """
SELECT order_id, product_id,
       TRY_CAST(CAST(price AS VARCHAR) AS DOUBLE) AS price,
       TRY_CAST(CAST(freight_value AS VARCHAR) AS DOUBLE) AS freight_value
FROM raw_items""",
)
def q_prj_replace(spark, sf_dir):
    # amounts arrive as text (as from CSV) and are replaced in place by numbers
    text = star.raw_items(spark, sf_dir).withColumns(
        {"price": F.col("price").cast("string"), "freight_value": F.col("freight_value").cast("string")}
    )
    return text.withColumns({"price": to_double("price"), "freight_value": to_double("freight_value")})


@query("prj_constant", "SELECT *, 500 AS loyalty_points FROM clean_customers")
def q_prj_constant(spark, sf_dir):
    return cleaned(spark, sf_dir)["customers"].withColumn("loyalty_points", F.lit(500))


@query("prj_sql_expr", "SELECT * FROM rfm_base")
def q_prj_sql_expr(spark, sf_dir):
    # a derived column written as a SQL string (the same rule as rfm.recency)
    return c360(spark, sf_dir).withColumn(
        "recency_days", F.expr(f"datediff(DATE'{rfm.REFERENCE_DATE}', last_purchase_date)")
    )


# ====================================================================== filters ==

@query("flt_status", "SELECT * FROM raw_orders WHERE order_status = 'delivered'")
def q_flt_status(spark, sf_dir):
    return star.raw_orders(spark, sf_dir).filter(F.col("order_status") == clean.DELIVERED)


@query(
    "flt_non_negative",
    "SELECT * FROM (SELECT order_id, product_id, price - 50000 AS margin FROM raw_items) WHERE margin >= 0",
)
def q_flt_non_negative(spark, sf_dir):
    items = star.raw_items(spark, sf_dir).select(
        "order_id", "product_id", (F.col("price") - 50000).alias("margin")
    )
    return items.filter(F.col("margin") >= 0)


@query(
    "flt_score_range",
    """
SELECT * FROM (SELECT review_id, order_id, CAST(trunc(review_score) AS INTEGER) AS review_score FROM raw_reviews)
WHERE review_score BETWEEN 1 AND 5""",
)
def q_flt_score_range(spark, sf_dir):
    r = star.raw_reviews(spark, sf_dir).withColumn("review_score", to_int_score("review_score"))
    return r.filter(F.col("review_score").between(1, 5))


@query("flt_is_null", "SELECT * FROM raw_products WHERE product_category_name IS NULL")
def q_flt_is_null(spark, sf_dir):
    return star.raw_products(spark, sf_dir).filter(F.col("product_category_name").isNull())


@query(
    "flt_any_null",
    """
SELECT i.order_id, i.product_id, p.product_category_name
FROM raw_items i LEFT JOIN raw_products p ON p.product_id = i.product_id
WHERE i.order_id IS NULL OR i.product_id IS NULL OR p.product_category_name IS NULL""",
)
def q_flt_any_null(spark, sf_dir):
    j = star.raw_items(spark, sf_dir).select("order_id", "product_id").join(
        star.raw_products(spark, sf_dir), "product_id", "left"
    )
    cols = ["order_id", "product_id", "product_category_name"]
    return j.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])).select(*cols)


# ======================================================================== joins ==

@query(
    "join_inner",
    """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
       o.order_delivered_customer_date,
       i.product_id, i.price, i.freight_value
FROM clean_orders o JOIN clean_items i ON i.order_id = o.order_id""",
)
def q_join_inner(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    return t["orders"].join(t["items"], on="order_id", how="inner")


@query(
    "join_left",
    """
SELECT i.product_id, i.order_id, i.price, i.freight_value, p.product_category_name
FROM clean_items i LEFT JOIN clean_products p ON p.product_id = i.product_id""",
)
def q_join_left(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    return t["items"].join(t["products"], on="product_id", how="left")


@query(
    "join_chain_360",
    """
SELECT o.order_id, i.product_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
       o.order_delivered_customer_date,
       i.price, i.freight_value, c.customer_unique_id, c.customer_city, c.customer_state,
       p.product_category_name, r.review_id, r.review_score
FROM clean_orders o
JOIN clean_items i ON i.order_id = o.order_id
JOIN clean_customers c ON c.customer_id = o.customer_id
LEFT JOIN clean_products p ON p.product_id = i.product_id
LEFT JOIN clean_reviews r ON r.order_id = o.order_id""",
)
def q_join_chain_360(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    return marts.joined_chain(t["orders"], t["items"], t["customers"], t["products"], t["reviews"])


@query(
    "join_preagg",
    """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
       o.order_delivered_customer_date,
       t.total_revenue, t.total_freight, t.total_items
FROM clean_orders o JOIN item_totals t ON t.order_id = o.order_id""",
)
def q_join_preagg(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    return t["orders"].join(marts.item_totals(t["items"]), on="order_id", how="inner")


@query(
    "join_pruned",
    """
SELECT o.customer_id, o.order_id, o.order_purchase_timestamp, c.customer_state
FROM clean_orders o JOIN clean_customers c ON c.customer_id = o.customer_id""",
)
def q_join_pruned(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    return t["orders"].select("order_id", "customer_id", "order_purchase_timestamp").join(
        t["customers"].select("customer_id", "customer_state"), on="customer_id", how="inner"
    )


# ================================================================= aggregations ==

@query("agg_order_totals", "SELECT * FROM item_totals")
def q_agg_order_totals(spark, sf_dir):
    return marts.item_totals(cleaned(spark, sf_dir)["items"])


@query(
    "agg_customer_basic",
    """
SELECT customer_unique_id, customer_city, count(*) AS accounts
FROM clean_customers GROUP BY customer_unique_id, customer_city""",
)
def q_agg_customer_basic(spark, sf_dir):
    return cleaned(spark, sf_dir)["customers"].groupBy("customer_unique_id", "customer_city").agg(
        F.count(F.lit(1)).alias("accounts")
    )


@query(
    "agg_sales_state_category_month",
    """
SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
       order_status, count(*) AS orders
FROM raw_orders GROUP BY 1, 2, 3""",
)
def q_agg_group_exprs(spark, sf_dir):
    o = star.raw_orders(spark, sf_dir)
    return o.groupBy(
        F.year("order_purchase_timestamp").alias("order_year"),
        F.month("order_purchase_timestamp").alias("order_month"),
        F.col("order_status"),
    ).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "agg_sum",
    """
SELECT product_id, CAST(sum(CAST(price AS DECIMAL(28,8))) AS DOUBLE) AS total_sales
FROM clean_items GROUP BY product_id""",
)
def q_agg_sum(spark, sf_dir):
    return cleaned(spark, sf_dir)["items"].groupBy("product_id").agg(
        money_out(F.sum(money("price"))).alias("total_sales")
    )


@query(
    "agg_sum_expr",
    """
SELECT order_id,
       CAST(round(sum(CAST(price AS DECIMAL(28,8)) + CAST(freight_value AS DECIMAL(28,8))), 2) AS DOUBLE)
         AS order_value
FROM clean_items GROUP BY order_id""",
)
def q_agg_sum_expr(spark, sf_dir):
    return cleaned(spark, sf_dir)["items"].groupBy("order_id").agg(
        money_out(F.sum(money("price") + money("freight_value")), 2).alias("order_value")
    )


@query(
    "agg_count",
    """
SELECT p.product_category_name, count(i.product_id) AS items
FROM clean_items i LEFT JOIN raw_products p ON p.product_id = i.product_id
GROUP BY p.product_category_name""",
)
def q_agg_count(spark, sf_dir):
    items = cleaned(spark, sf_dir)["items"]
    return items.join(star.raw_products(spark, sf_dir), "product_id", "left").groupBy(
        "product_category_name"
    ).agg(F.count("product_id").alias("items"))


@query(
    "agg_count_distinct",
    """
SELECT c.customer_unique_id, count(DISTINCT o.order_id) AS orders
FROM raw_orders o JOIN raw_customers c ON c.customer_id = o.customer_id
GROUP BY c.customer_unique_id""",
)
def q_agg_count_distinct(spark, sf_dir):
    o = star.raw_orders(spark, sf_dir).join(star.raw_customers(spark, sf_dir), "customer_id")
    return o.groupBy("customer_unique_id").agg(F.count_distinct("order_id").alias("orders"))


@query(
    "agg_max",
    """
SELECT customer_id, max(order_purchase_timestamp) AS last_purchase_date
FROM raw_orders GROUP BY customer_id""",
)
def q_agg_max(spark, sf_dir):
    return star.raw_orders(spark, sf_dir).groupBy("customer_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase_date")
    )


@query(
    "agg_avg",
    "SELECT order_id, round(avg(review_score), 1) AS average_review_score "
    "FROM clean_reviews GROUP BY order_id",
)
def q_agg_avg(spark, sf_dir):
    return cleaned(spark, sf_dir)["reviews"].groupBy("order_id").agg(
        F.round(F.avg("review_score"), 1).alias("average_review_score")
    )


@query(
    "agg_mode",
    """
WITH cats AS (
  SELECT i.order_id, p.product_category_name
  FROM clean_items i LEFT JOIN clean_products p ON p.product_id = i.product_id),
ranked AS (
  SELECT order_id, product_category_name,
         row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, product_category_name) AS rk
  FROM cats WHERE product_category_name IS NOT NULL GROUP BY order_id, product_category_name)
SELECT k.order_id, r.product_category_name AS favorite_category
FROM (SELECT DISTINCT order_id FROM cats) k LEFT JOIN ranked r ON r.order_id = k.order_id AND r.rk = 1""",
)
def q_agg_mode(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    cats = t["items"].join(t["products"], "product_id", "left")
    return mode_by(cats, ["order_id"], "product_category_name", "favorite_category")


@query(
    "agg_row_count",
    """
SELECT 'customers' AS table_name, count(*) AS rows FROM raw_customers
UNION ALL SELECT 'orders', count(*) FROM raw_orders
UNION ALL SELECT 'items', count(*) FROM raw_items
UNION ALL SELECT 'products', count(*) FROM raw_products
UNION ALL SELECT 'reviews', count(*) FROM raw_reviews
UNION ALL SELECT 'payments', count(*) FROM raw_payments
UNION ALL SELECT 'sellers', count(*) FROM raw_sellers
UNION ALL SELECT 'geolocation', count(*) FROM raw_geolocation
UNION ALL SELECT 'translation', count(*) FROM raw_translation""",
)
def q_agg_row_count(spark, sf_dir):
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in star.raw_tables(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "agg_distinct_keys",
    "SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT customer_unique_id FROM raw_customers)",
)
def q_agg_distinct_keys(spark, sf_dir):
    return star.raw_customers(spark, sf_dir).select("customer_unique_id").distinct().agg(
        F.count(F.lit(1)).alias("distinct_keys")
    )


# ====================================================================== windows ==

@query(
    "win_ntile_desc",
    f"""
SELECT customer_unique_id, customer_city, recency_days,
       CAST(ntile(4) OVER (ORDER BY recency_days DESC NULLS LAST, {ASC_GRAIN}) AS INTEGER) AS R_Score
FROM rfm_base""",
)
def q_win_ntile_desc(spark, sf_dir):
    base = rfm.recency(c360(spark, sf_dir)).select(*GRAIN_TIES, "recency_days")
    keys = [Key("recency_days", descending=True), *map(Key, GRAIN_TIES)]
    return ntile_labels(stored(base, "ntile-desc"), 4, {"R_Score": keys})


@query(
    "win_ntile_asc",
    f"""
SELECT customer_unique_id, customer_city, total_orders, total_lifetime_value,
  CAST(ntile(4) OVER (ORDER BY total_orders ASC NULLS FIRST, {ASC_GRAIN}) AS INTEGER) AS F_Score,
  CAST(ntile(4) OVER (ORDER BY total_lifetime_value ASC NULLS FIRST, {ASC_GRAIN}) AS INTEGER) AS M_Score
FROM c360""",
)
def q_win_ntile_asc(spark, sf_dir):
    base = c360(spark, sf_dir).select(*GRAIN_TIES, "total_orders", "total_lifetime_value")
    ties = list(map(Key, GRAIN_TIES))
    orders = {"F_Score": [Key("total_orders"), *ties], "M_Score": [Key("total_lifetime_value"), *ties]}
    return ntile_labels(stored(base, "ntile-asc"), 4, orders)


# ================================================================ sorts / limits ==

@query(
    "lim_n",
    "SELECT * FROM clean_customers ORDER BY customer_id ASC NULLS FIRST LIMIT 5",
)
def q_lim_n(spark, sf_dir):
    return first_n(cleaned(spark, sf_dir)["customers"], 5, ("customer_id",))


# ======================================================================== sets ==

@query("set_distinct", "SELECT DISTINCT customer_unique_id FROM raw_customers")
def q_set_distinct(spark, sf_dir):
    return star.raw_customers(spark, sf_dir).select("customer_unique_id").distinct()


@query(
    "set_drop_duplicates",
    "SELECT DISTINCT customer_unique_id, customer_city, customer_state FROM raw_customers",
)
def q_set_drop_duplicates(spark, sf_dir):
    return star.raw_customers(spark, sf_dir).drop("customer_id").dropDuplicates()


# ==================================================================== functions ==

@query("fn_lower", "SELECT product_id, lower(product_category_name) AS product_category_name FROM raw_products")
def q_fn_lower(spark, sf_dir):
    return star.raw_products(spark, sf_dir).withColumn(
        "product_category_name", F.lower("product_category_name")
    )


@query(
    "fn_fold_accents",
    "SELECT doc_id, translate(text, 'áàâãäéèêëíìîïóòôõöúùûüç', 'aaaaaeeeeiiiiooooouuuuc') AS text FROM documents",
)
def q_fn_fold_accents(spark, sf_dir):
    docs = star.table(spark, sf_dir, "documents")
    return docs.select("doc_id", fold_accents("text").alias("text"))


@query(
    "fn_fillna",
    "SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name FROM raw_products",
)
def q_fn_fillna(spark, sf_dir):
    return star.raw_products(spark, sf_dir).fillna("unknown", subset=["product_category_name"])


@query(
    "fn_cast_double",
    """
SELECT l_orderkey AS order_id, l_linenumber AS line,
       TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price,
       TRY_CAST(l_returnflag AS DOUBLE) AS flag_as_number
FROM lineitem""",
)
def q_fn_cast_double(spark, sf_dir):
    li = star.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        to_double(F.col("l_extendedprice").cast("string")).alias("price"),
        to_double("l_returnflag").alias("flag_as_number"),
    )


@query(
    "fn_cast_int",
    """
SELECT review_id,
       CAST(trunc(TRY_CAST(CAST(review_score AS VARCHAR) AS DOUBLE)) AS INTEGER) AS review_score
FROM raw_reviews""",
)
def q_fn_cast_int(spark, sf_dir):
    r = star.raw_reviews(spark, sf_dir)
    return r.select("review_id", to_int_score(F.col("review_score").cast("string")).alias("review_score"))


@query(
    "fn_to_timestamp",
    """
SELECT o_orderkey AS order_id,
       TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS order_purchase_timestamp,
       TRY_CAST(o_orderpriority AS TIMESTAMP) AS junk_timestamp
FROM orders""",
)
def q_fn_to_timestamp(spark, sf_dir):
    o = star.table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        to_timestamp(F.col("o_orderdate").cast("string")).alias("order_purchase_timestamp"),
        to_timestamp("o_orderpriority").alias("junk_timestamp"),
    )


@query(
    "fn_year_month",
    """
SELECT order_id, CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month
FROM raw_orders""",
)
def q_fn_year_month(spark, sf_dir):
    return star.raw_orders(spark, sf_dir).select(
        "order_id",
        F.year("order_purchase_timestamp").alias("order_year"),
        F.month("order_purchase_timestamp").alias("order_month"),
    )


@query(
    "fn_datediff",
    """
SELECT order_id,
       CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), DATE '2018-10-01') AS INTEGER) AS recency_days
FROM raw_orders""",
)
def q_fn_datediff(spark, sf_dir):
    return star.raw_orders(spark, sf_dir).select(
        "order_id",
        F.datediff(F.to_date(F.lit(rfm.REFERENCE_DATE)), F.col("order_purchase_timestamp")).alias(
            "recency_days"
        ),
    )


@query(
    "fn_round",
    """
SELECT l_orderkey AS order_id, l_linenumber AS line,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS DOUBLE)
         AS discount_amount
FROM lineitem""",
)
def q_fn_round(spark, sf_dir):
    li = star.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        money_out(money("l_extendedprice") * money("l_discount"), 2).alias("discount_amount"),
    )


# ================================================================ quality gates ==

def _gate_sql(table: str, rule: str, columns: str, failed_expr: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{columns}' AS columns, "
        f"count(*) AS rows, "
        f"CAST({failed_expr} AS BIGINT) AS failed, CAST({failed_expr} AS BIGINT) = 0 AS passed "
        f"FROM {source}"
    )


def _distinct_fail(col: str, source: str) -> str:
    return f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {col} FROM {source}))"


@query(
    "dq_not_null",
    _gate_sql("products", "not_null", "product_id", "count(*) FILTER (WHERE product_id IS NULL)", "raw_products")
    + "\nUNION ALL\n"
    + _gate_sql(
        "products",
        "not_null",
        "product_category_name",
        "count(*) FILTER (WHERE product_category_name IS NULL)",
        "raw_products",
    ),
)
def q_dq_not_null(spark, sf_dir):
    gates = Gates(not_null=("product_id", "product_category_name"))
    return gate_report(star.raw_products(spark, sf_dir), gates, "products")


@query(
    "dq_unique",
    _gate_sql("customers", "unique", "customer_id", _distinct_fail("customer_id", "raw_customers"), "raw_customers")
    + "\nUNION ALL\n"
    + _gate_sql(
        "customers",
        "unique",
        "customer_unique_id",
        _distinct_fail("customer_unique_id", "raw_customers"),
        "raw_customers",
    ),
)
def q_dq_unique(spark, sf_dir):
    gates = Gates(unique=(("customer_id",), ("customer_unique_id",)))
    return gate_report(star.raw_customers(spark, sf_dir), gates, "customers")


_ITEM_CATS = "(SELECT i.order_id, i.product_id, p.product_category_name FROM raw_items i LEFT JOIN raw_products p ON p.product_id = i.product_id)"


@query(
    "dq_any_null",
    _gate_sql(
        "items",
        "any_null",
        "order_id,product_id",
        "count(*) FILTER (WHERE order_id IS NULL OR product_id IS NULL)",
        _ITEM_CATS,
    )
    + "\nUNION ALL\n"
    + _gate_sql(
        "items",
        "any_null",
        "product_id,product_category_name",
        "count(*) FILTER (WHERE product_id IS NULL OR product_category_name IS NULL)",
        _ITEM_CATS,
    ),
)
def q_dq_any_null(spark, sf_dir):
    j = star.raw_items(spark, sf_dir).select("order_id", "product_id").join(
        star.raw_products(spark, sf_dir), "product_id", "left"
    )
    gates = Gates(any_null=(("order_id", "product_id"), ("product_id", "product_category_name")))
    return gate_report(j, gates, "items")


@query(
    "dq_report",
    "\nUNION ALL\n".join(
        [
            _gate_sql("customers", "not_null", "customer_id", "count(*) FILTER (WHERE customer_id IS NULL)", "clean_customers"),
            _gate_sql("customers", "unique", "customer_id", _distinct_fail("customer_id", "clean_customers"), "clean_customers"),
            _gate_sql("orders", "not_null", "order_id", "count(*) FILTER (WHERE order_id IS NULL)", "clean_orders"),
            _gate_sql("items", "any_null", "order_id,product_id", "count(*) FILTER (WHERE order_id IS NULL OR product_id IS NULL)", "clean_items"),
            _gate_sql("products", "not_null", "product_id", "count(*) FILTER (WHERE product_id IS NULL)", "clean_products"),
            _gate_sql("reviews", "any_null", "review_id,order_id", "count(*) FILTER (WHERE review_id IS NULL OR order_id IS NULL)", "clean_reviews"),
        ]
    ),
)
def q_dq_report(spark, sf_dir):
    t = cleaned(spark, sf_dir)
    reports = [gate_report(t[name], CLEANERS[name].gates, name) for name in t]
    return reduce(DataFrame.unionByName, reports)


# ==================================================================== profiling ==

RAW_COLUMN_NAMES = {
    "customers": ("customer_id", "customer_unique_id", "customer_city", "customer_state"),
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_delivered_customer_date",
    ),
    "items": ("order_id", "product_id", "price", "freight_value"),
    "products": ("product_id", "product_category_name"),
    "reviews": ("review_id", "order_id", "review_score"),
    "payments": ("order_id", "payment_value"),
    "sellers": ("seller_id", "seller_name"),
    "geolocation": ("geolocation_city", "geolocation_state"),
    "translation": ("product_category_name", "product_category_name_english"),
}
RAW_COLUMNS = {name: len(columns) for name, columns in RAW_COLUMN_NAMES.items()}


def _null_sql(name: str, relation: str, columns: tuple[str, ...]) -> list[str]:
    return [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, {i} AS position, "
        f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 2) AS null_pct, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS n FROM {relation}"
        for i, c in enumerate(columns)
    ]


RAW_NULLS_SQL = "\nUNION ALL\n".join(
    sql for name, columns in RAW_COLUMN_NAMES.items() for sql in _null_sql(name, f"raw_{name}", columns)
)


def _per_raw_sql(template: str) -> str:
    return "\nUNION ALL\n".join(
        template.format(name=name, ncols=n) for name, n in RAW_COLUMNS.items()
    )


@query(
    "prof_shape",
    _per_raw_sql("SELECT '{name}' AS table_name, count(*) AS rows, {ncols} AS columns FROM raw_{name}"),
)
def q_prof_shape(spark, sf_dir):
    parts = [
        prof.shape(df).select(F.lit(name).alias("table_name"), "rows", "columns")
        for name, df in star.raw_tables(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


_DUP_SQL = (
    "SELECT '{name}' AS table_name, count(*) AS rows, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS duplicate_rows, "
    "round(COALESCE((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src}))) * 100 / "
    "NULLIF(count(*), 0), 0), 2) AS duplicate_pct FROM {src}"
)


@query(
    "prof_duplicates",
    _DUP_SQL.format(
        name="customer_people",
        src="(SELECT customer_unique_id, customer_city, customer_state FROM raw_customers)",
    )
    + "\nUNION ALL\n"
    + "\nUNION ALL\n".join(_DUP_SQL.format(name=n, src=f"raw_{n}") for n in RAW_COLUMNS),
)
def q_prof_duplicates(spark, sf_dir):
    raw = star.raw_tables(spark, sf_dir)
    inputs = {"customer_people": raw["customers"].drop("customer_id"), **raw}
    parts = [
        prof.duplicates(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in inputs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "prof_null_pct",
    """
SELECT count(*) FILTER (WHERE product_id IS NULL) / count(*) * 100 AS product_id,
       count(*) FILTER (WHERE product_category_name IS NULL) / count(*) * 100 AS product_category_name
FROM raw_products""",
)
def q_prof_null_pct(spark, sf_dir):
    return prof.null_pct_wide(star.raw_products(spark, sf_dir))


@query(
    "prof_null_report",
    f"""
SELECT table_name, column_name, position, null_pct FROM (
{RAW_NULLS_SQL}
UNION ALL
SELECT 'items_with_category', 'product_category_name', 2,
       round(count(*) FILTER (WHERE product_category_name IS NULL) / count(*) * 100, 2),
       count(*) FILTER (WHERE product_category_name IS NULL)
FROM (SELECT i.order_id, i.product_id, p.product_category_name
      FROM raw_items i LEFT JOIN raw_products p ON p.product_id = i.product_id))
WHERE n > 0""",
)
def q_prof_null_report(spark, sf_dir):
    raw = star.raw_tables(spark, sf_dir)
    items_cat = raw["items"].select("order_id", "product_id").join(raw["products"], "product_id", "left")
    inputs = {**raw, "items_with_category": items_cat.select("order_id", "product_id", "product_category_name")}
    return reduce(DataFrame.unionByName, [prof.null_shares(df, name) for name, df in inputs.items()])


@query(
    "prof_all",
    "SELECT *, NULL::VARCHAR AS column_name, NULL::INTEGER AS position, NULL::DOUBLE AS null_pct FROM ("
    + _per_raw_sql(
        "SELECT '{name}' AS table_name, count(*) AS rows, {ncols} AS columns, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{name})) AS duplicate_rows, "
        "round(COALESCE((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{name}))) * 100 / "
        "NULLIF(count(*), 0), 0), 2) AS duplicate_pct FROM raw_{name}"
    )
    + f""")
UNION ALL
SELECT table_name, NULL, NULL, NULL, NULL, column_name, position, null_pct FROM (
{RAW_NULLS_SQL})
WHERE n > 0""",
)
def q_prof_all(spark, sf_dir):
    """Summary rows of all nine tables, and a row per column with NULLs."""
    return prof.report(star.raw_tables(spark, sf_dir))


# ====================================================================== sources ==

DOC_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@query("src_csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_src_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents-csv")
    docs = star.table(spark, sf_dir, "documents").select(*DOC_SCHEMA.names)
    csvsrc.write_csv(docs, path)
    return csvsrc.read_raw(spark, path, multiline=True, schema=DOC_SCHEMA)


@query("src_csv_quoted", "SELECT doc_id, text, lang, source FROM documents")
def q_src_csv_quoted(spark, sf_dir):
    """The documents through CSV files whose quoted fields hold line breaks, by blocks."""
    path = scratch_path(spark, "documents-quoted-csv")
    csvsrc.write_csv(star.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), path)
    rows = read_quoted(spark, path)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


@query(
    "src_csv_inferred",
    "SELECT CAST(order_id AS INTEGER) AS order_id, CAST(product_id AS INTEGER) AS product_id, "
    "price, freight_value FROM raw_items",
)
def q_src_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "items-csv")
    csvsrc.write_csv(star.raw_items(spark, sf_dir), path)
    return csvsrc.read_csv_inferred(spark, path)  # the types are what inference found


@query(
    "src_registry",
    _per_raw_sql("SELECT '{name}' AS source, count(*) AS rows, {ncols} AS columns FROM raw_{name}"),
)
def q_src_registry(spark, sf_dir):
    base = scratch_path(spark, "raw-csv")
    raw = star.raw_tables(spark, sf_dir)
    for name, df in raw.items():
        csvsrc.write_csv(df, csvsrc.source_path(base, name))
    loaded = csvsrc.load_raw_sources(spark, base, names=list(raw))
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in loaded.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "src_lookup_csv",
    "SELECT DISTINCT lower(p_type) AS product_category_name, p_type AS product_category_name_english FROM part",
)
def q_src_lookup_csv(spark, sf_dir):
    path = scratch_path(spark, "translation-csv")
    pairs = star.table(spark, sf_dir, "part").select(
        F.lower("p_type").alias("product_category_name"),
        F.col("p_type").alias("product_category_name_english"),
    ).distinct()
    csvsrc.write_csv(pairs, path)
    table = lookup.read_translation(spark, path)
    enforce(gate_report(table, lookup.TRANSLATION_GATES, "translation"))
    return table


@query(
    "src_schema",
    """
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS data_type,
       is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name = 'orders'""",
)
def q_src_schema(spark, sf_dir):
    """The schema that inference finds in the rows of a CSV of ``orders``."""
    path = scratch_path(spark, "orders-csv")
    csvsrc.write_csv(star.table(spark, sf_dir, "orders"), path)
    return csvsrc.schema_table(spark, csvsrc.read_csv_inferred(spark, path))


# =============================================================== table versions ==

def _new_table(spark, name) -> VersionedTable:
    return VersionedTable(spark, scratch_path(spark, name))


@query("tbl_latest", "SELECT * FROM clean_customers")
def q_tbl_latest(spark, sf_dir):
    t = _new_table(spark, "tbl-latest")
    t.overwrite(cleaned(spark, sf_dir)["customers"])
    return t.read()


@query("tbl_overwrite", "SELECT * FROM clean_customers")
def q_tbl_overwrite(spark, sf_dir):
    t = _new_table(spark, "tbl-overwrite")
    t.overwrite(star.raw_customers(spark, sf_dir))
    t.overwrite(cleaned(spark, sf_dir)["customers"])
    return t.read()


@query("tbl_overwrite_schema", "SELECT customer_id, customer_state FROM clean_customers")
def q_tbl_overwrite_schema(spark, sf_dir):
    t = _new_table(spark, "tbl-overwrite-schema")
    customers = cleaned(spark, sf_dir)["customers"]
    t.overwrite(customers)
    t.overwrite(customers.select("customer_id", "customer_state"), overwrite_schema=True)
    return t.read()


def _with_points(df: DataFrame) -> DataFrame:
    return df.withColumn("loyalty_points", F.lit(500))


@query("tbl_append_rejected", "SELECT * FROM clean_customers")
def q_tbl_append_rejected(spark, sf_dir):
    t = _new_table(spark, "tbl-append-rejected")
    t.overwrite(cleaned(spark, sf_dir)["customers"])
    try:
        t.append(_with_points(star.raw_customers(spark, sf_dir)))
    except SchemaMismatchError:
        pass
    else:
        raise AssertionError("append with an unknown column was not rejected")
    return t.read()


def _demo_table(spark, sf_dir, name) -> VersionedTable:
    """v0 = cleaned customers; v1 = append of raw customers with a new column (merged)."""
    t = _new_table(spark, name)
    t.overwrite(cleaned(spark, sf_dir)["customers"])
    t.append(_with_points(star.raw_customers(spark, sf_dir)), merge_schema=True)
    return t


@query(
    "tbl_append_merged",
    "SELECT *, CAST(NULL AS INTEGER) AS loyalty_points FROM clean_customers "
    "UNION ALL SELECT *, 500 AS loyalty_points FROM raw_customers",
)
def q_tbl_append_merged(spark, sf_dir):
    return _demo_table(spark, sf_dir, "tbl-append-merged").read()


@query("tbl_as_of", "SELECT * FROM clean_customers")
def q_tbl_as_of(spark, sf_dir):
    return _demo_table(spark, sf_dir, "tbl-as-of").read(version=0)


@query("tbl_rollback", "SELECT * FROM clean_customers")
def q_tbl_rollback(spark, sf_dir):
    t = _demo_table(spark, sf_dir, "tbl-rollback")
    t.rollback(0)
    return t.read()


@query(
    "tbl_history",
    """
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, 'Overwrite' AS mode,
       (SELECT count(*) FROM clean_customers) AS num_output_rows
UNION ALL SELECT 1, 'WRITE', 'Append', (SELECT count(*) FROM raw_customers)
UNION ALL SELECT 2, 'RESTORE', NULL, (SELECT count(*) FROM clean_customers)""",
)
def q_tbl_history(spark, sf_dir):
    t = _demo_table(spark, sf_dir, "tbl-history")
    t.rollback(0)
    h = t.history()
    return h.select(
        "version", "operation", F.col("operationParameters")["mode"].alias("mode"), "num_output_rows"
    )


@query(
    "fn_normalize_city",
    "SELECT doc_id, translate(lower(text), 'áàâãäéèêëíìîïóòôõöúùûüç', 'aaaaaeeeeiiiiooooouuuuc') AS text "
    "FROM documents",
)
def q_fn_normalize_city(spark, sf_dir):
    docs = star.table(spark, sf_dir, "documents")
    return docs.select("doc_id", normalize_city("text").alias("text"))
