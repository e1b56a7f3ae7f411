"""Marts over the cleaned tables.

Semantics follow the reference exactly, including its quirks:

* reviews join on order_id without dedupe, so an order with two reviews counts its
  items twice in value, average score and favourite category (but once in
  total_orders, a distinct count);
* the customer grain is (customer_unique_id, customer_city);
* an item whose product is missing has category NULL (left join), distinct from
  'unknown'; NULL categories are ignored by the favourite;
* ``price + freight_value`` is added per row before the sum, so a NULL freight drops
  the whole row from the lifetime value.

The plans differ from the original jobs in HOW: those join every item row to
orders, customers, products and reviews (up to four shuffles of item-sized data, and
the review fan-out materialised), then aggregate. Here items meet their order once
and are reduced to one row per (order, category) inside that partitioning
(``order_lines``); reviews are reduced to one row per order and the fan-out becomes a
multiplier, so only order-sized data meets the customer join. Customer 360, sales and the
order fact's item totals are all sums over those lines, so a run that builds all three
writes them once and shuffles the items once (``plans.pipeline``). Money is summed as
DECIMAL(28,8) (exact, order-independent), rounded half-up and returned as double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.money import money, money_out, money_times
from basketry.operators.joins import fanout_left_join
from basketry.operators.mode import heaviest

GRAIN = ["customer_unique_id", "customer_city"]


def _items_with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    # Left join: a missing product keeps a NULL category. The planner broadcasts the
    # product side only while its estimated size is under the broadcast threshold;
    # beyond that it is a sort-merge join (AQE splits a hot product's partition).
    return items.select("order_id", "product_id", "price", "freight_value").join(
        products.select("product_id", "product_category_name"), "product_id", "left"
    )


def order_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """A row per (order, category): the order's customer and time, item rows, known
    products, and the sums of price, freight and of both together.

    Items meet their order once (one exchange by order_id) and are reduced inside that
    partitioning. An order holding a large share of all items is split by AQE's skew join
    (spark.sql.adaptive.forceOptimizeSkewedJoin, on in basketry.session): the split tasks
    pre-aggregate their share and AQE adds the one exchange the aggregation then needs.
    """
    lines = _items_with_category(items, products).join(
        orders.select("order_id", "customer_id", "order_purchase_timestamp"), "order_id"
    )
    return lines.groupBy(
        "order_id", "customer_id", "order_purchase_timestamp", "product_category_name"
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("product_id").alias("n_items"),
        F.sum(money("price")).alias("price"),
        F.sum(money("freight_value")).alias("freight"),
        F.sum(money("price") + money("freight_value")).alias("value"),
    )


def review_stats(reviews: DataFrame) -> DataFrame:
    """Per order: review rows (the fan-out factor), scores present, score sum."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count("review_score").alias("n_scores"),
        F.sum("review_score").cast("long").alias("score_sum"),
    )


def customer_360(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """Per (customer_unique_id, customer_city): total_orders, total_lifetime_value,
    last_purchase_date, average_review_score, favorite_category."""
    return customer_360_of(order_lines(orders, items, products), customers, reviews)


def customer_360_of(lines: DataFrame, customers: DataFrame, reviews: DataFrame) -> DataFrame:
    """Customer 360 from order lines.

    ``base`` has one row per (order, category). A single GROUPING SETS
    aggregation reduces it both per (customer, order) -- for the distinct order
    count and the order measures -- and per (customer, category) -- for the
    favourite's weights; one more aggregation per customer combines the two kinds of
    rows. ``base`` is therefore computed once, and every step is a map-side-combined
    aggregation, so a customer holding a large share of all rows is spread over
    tasks by order and category before it is reduced to one row.
    """
    base = (
        lines.join(review_stats(reviews), "order_id", "left")
        .join(customers.select("customer_id", *GRAIN), "customer_id")
        .withColumn("fan", F.coalesce(F.col("n_reviews"), F.lit(1)))
    )
    # grouping_id bits follow (grain..., order_id, category): 1 = (grain, order_id)
    # rows, 2 = (grain, category) rows
    stage = base.groupingSets(
        [GRAIN + ["order_id"], GRAIN + ["product_category_name"]],
        *GRAIN,
        "order_id",
        "product_category_name",
    ).agg(
        F.grouping_id().alias("gid"),
        F.sum(money_times("value", "fan")).alias("value"),
        F.max("order_purchase_timestamp").alias("last_ts"),
        F.sum(F.col("n_rows") * F.col("score_sum")).alias("score_num"),
        F.sum(F.col("n_rows") * F.col("n_scores")).alias("score_den"),
        F.sum(F.col("n_rows") * F.col("fan")).alias("weight"),
    )
    is_order = F.col("gid") == 1
    is_cat = (F.col("gid") == 2) & F.col("product_category_name").isNotNull()
    return stage.groupBy(*GRAIN).agg(
        F.count(F.when(is_order, 1)).alias("total_orders"),
        money_out(F.sum(F.when(is_order, F.col("value"))), 2).alias("total_lifetime_value"),
        F.max(F.when(is_order, F.col("last_ts"))).alias("last_purchase_date"),
        F.round(
            F.try_divide(
                F.sum(F.when(is_order, F.col("score_num"))),
                F.sum(F.when(is_order, F.col("score_den"))),
            ).cast("double"),
            1,
        ).alias("average_review_score"),
        heaviest("weight", "product_category_name", is_cat).alias("favorite_category"),
    )


def customer_basic(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Prototype variant: total_orders, total_lifetime_value, last_purchase_date."""
    per_order = items.groupBy("order_id").agg(
        F.sum(money("price") + money("freight_value")).alias("value")
    )
    base = per_order.join(
        orders.select("order_id", "customer_id", "order_purchase_timestamp"), "order_id"
    ).join(customers.select("customer_id", *GRAIN), "customer_id")
    return base.groupBy(*GRAIN).agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_out(F.sum("value"), 2).alias("total_lifetime_value"),
        F.max("order_purchase_timestamp").alias("last_purchase_date"),
    )


def item_totals(items: DataFrame) -> DataFrame:
    """Per order: total_revenue, total_freight (unrounded), total_items (non-null products)."""
    return items.groupBy("order_id").agg(
        money_out(F.sum(money("price"))).alias("total_revenue"),
        money_out(F.sum(money("freight_value"))).alias("total_freight"),
        F.count("product_id").alias("total_items"),
    )


def item_totals_of(lines: DataFrame) -> DataFrame:
    """Item totals from order lines (orders of the lines only)."""
    return lines.groupBy("order_id").agg(
        money_out(F.sum("price")).alias("total_revenue"),
        money_out(F.sum("freight")).alias("total_freight"),
        F.sum("n_items").alias("total_items"),
    )


def orders_enriched(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, customers: DataFrame
) -> DataFrame:
    """Order fact: order columns + item totals + review score (one row per review) +
    city/state. Orders without items are dropped; orders without reviews keep NULL."""
    return orders_enriched_of(item_totals(items), orders, reviews, customers)


def orders_enriched_of(
    totals: DataFrame, orders: DataFrame, reviews: DataFrame, customers: DataFrame
) -> DataFrame:
    """Order fact from item totals per order."""
    # orders meet their reviews first: both sides are then plain shuffles, so an order
    # with very many reviews is split; the item totals are one row per order
    reviewed = fanout_left_join(orders, reviews.select("order_id", "review_score"), "order_id")
    return (
        reviewed.join(totals, "order_id")
        .join(
            customers.select("customer_id", "customer_city", "customer_state"),
            "customer_id",
            "left",
        )
        .select(
            *orders.columns, "total_revenue", "total_freight", "total_items", "review_score",
            "customer_city", "customer_state",
        )
    )


def joined_chain(
    orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, reviews: DataFrame
) -> DataFrame:
    """The unreduced five-table chain, a row per item and review, with every column: orders
    with items and customers, products and reviews where there are any.

    Orders meet their reviews first, in the form whose fan-out side can be split
    (``fanout_left_join``), then their items: an inner join, so a hot order is split on
    either side."""
    names = dict.fromkeys(
        ["order_id", "product_id", "customer_id", *orders.columns, *items.columns, *customers.columns,
         *products.columns, *reviews.columns]
    )
    return (
        fanout_left_join(orders, reviews, "order_id")
        .join(items, "order_id")
        .join(customers, "customer_id")
        .join(products, "product_id", "left")
        .select(*names)
    )


def sales_by_state_category_month(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Plain group-by (no subtotals) of item sales by year, month, state, category."""
    return sales_of(order_lines(orders, items, products), customers)


def sales_of(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales from order lines: at most a row per order and category meets the customers
    and is reduced per output group."""
    return (
        lines.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy(
            F.year("order_purchase_timestamp").alias("order_year"),
            F.month("order_purchase_timestamp").alias("order_month"),
            "customer_state",
            "product_category_name",
        )
        .agg(
            money_out(F.sum("price"), 2).alias("total_sales"),
            F.sum("n_items").alias("total_items_sold"),
        )
    )
