"""Cleaning rules for the five raw tables, each with its data-quality gates.

Each ``clean_*`` is a lazy DataFrame -> DataFrame function. Filters use three-valued
logic on purpose: a NULL price, status or score fails the predicate and the row is
dropped, as in the reference.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.casts import to_double, to_int_score, to_timestamp
from basketry.functions.text import normalize_city
from basketry.operators.quality import Gates

# Cleaning-rule constants.
DELIVERED = "delivered"
UNKNOWN_CATEGORY = "unknown"
ORDER_TIMESTAMPS = ("order_purchase_timestamp", "order_delivered_customer_date")
SCORE_MIN, SCORE_MAX = 1, 5


def clean_customers(raw: DataFrame) -> DataFrame:
    """City: lower-case, then fold accents."""
    return raw.withColumn("customer_city", normalize_city("customer_city"))


def clean_orders(raw: DataFrame, status: str = DELIVERED) -> DataFrame:
    """Keep one status (delivered); parse the timestamp columns (junk -> NULL, row kept).
    Both timestamps are required."""
    missing = [c for c in ORDER_TIMESTAMPS if c not in raw.columns]
    if missing:
        raise ValueError(f"orders lack the columns {missing}")
    df = raw.filter(F.col("order_status") == status)
    return df.withColumns({c: to_timestamp(c) for c in ORDER_TIMESTAMPS})


def clean_items(raw: DataFrame) -> DataFrame:
    """Price and freight to double; keep price >= 0 (NULL or junk price dropped)."""
    return raw.withColumns(
        {"price": to_double("price"), "freight_value": to_double("freight_value")}
    ).filter(F.col("price") >= 0)


def clean_products(raw: DataFrame, keep_all_columns: bool = False) -> DataFrame:
    """Category lower-cased, NULL -> 'unknown'. The job keeps id + category only."""
    df = raw if keep_all_columns else raw.select("product_id", "product_category_name")
    return df.withColumn(
        "product_category_name", F.lower("product_category_name")
    ).fillna(UNKNOWN_CATEGORY, subset=["product_category_name"])


def clean_products_wide(raw: DataFrame) -> DataFrame:
    """Prototype variant: same rules, every raw column kept."""
    return clean_products(raw, keep_all_columns=True)


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Three columns; score to int ('5.7' -> 5); keep scores 1..5."""
    return raw.select(
        "review_id", "order_id", to_int_score("review_score").alias("review_score")
    ).filter(F.col("review_score").between(SCORE_MIN, SCORE_MAX))


@dataclass(frozen=True)
class Cleaner:
    clean: Callable[[DataFrame], DataFrame]
    gates: Gates


CLEANERS: dict[str, Cleaner] = {
    "customers": Cleaner(
        clean_customers, Gates(not_null=("customer_id",), unique=(("customer_id",),))
    ),
    "orders": Cleaner(clean_orders, Gates(not_null=("order_id",))),
    "items": Cleaner(clean_items, Gates(any_null=(("order_id", "product_id"),))),
    "products": Cleaner(clean_products, Gates(not_null=("product_id",))),
    "reviews": Cleaner(clean_reviews, Gates(any_null=(("review_id", "order_id"),))),
}
