"""Recency / frequency / monetary scores and segments over the customer-360 mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.ntile import Key, ntile_labels, ntile_window
from basketry.session import stored

# Default reference date for recency, score count, segment labels.
REFERENCE_DATE = "2018-10-01"
BUCKETS = 4
CHAMPIONS = "1. Champions"
LOYAL = "2. Loyal Customers"
AT_RISK = "3. At Risk"
HIBERNATING = "4. Hibernating / Lost"
POTENTIAL = "5. Potential / Others"

# Rows tied on a score key are ordered by the customer grain, so scores are repeatable.
TIEBREAK = ("customer_unique_id", "customer_city")


def recency(c360: DataFrame, reference_date: str = REFERENCE_DATE) -> DataFrame:
    """recency_days = days from last purchase to the reference date."""
    return c360.withColumn(
        "recency_days",
        F.datediff(F.to_date(F.lit(reference_date)), F.col("last_purchase_date")),
    )


# score column -> its first sort key
SCORE_KEYS = {
    "R_Score": Key("recency_days", descending=True),
    "F_Score": Key("total_orders"),
    "M_Score": Key("total_lifetime_value"),
}


def scores(base: DataFrame, method: str = "range", materialized: bool = False) -> DataFrame:
    """R (recency descending: oldest = 1), F (order count), M (value), each 1..4.

    One plan at every size: the boundary rows of all three scores are selected together
    on the key columns, and the wide rows are labelled by comparing them with those nine
    rows, without a shuffle. Unless ``materialized`` (a table that was just read), ``base``
    is written as a table first, since it is read a few times. ``method="window"`` is the
    plain one-task form that tests compare with.
    """
    ties = [Key(c) for c in TIEBREAK]
    orders = {out: [key, *ties] for out, key in SCORE_KEYS.items()}
    if method == "window":
        for out, keys in orders.items():
            base = ntile_window(base, BUCKETS, [x.order() for x in keys], out)
        return base
    if method != "range":
        raise ValueError(f"unknown scoring method {method!r}")
    if not materialized:
        base = stored(base, "rfm-base")
    return ntile_labels(base, BUCKETS, orders)


# Fixed rule: the thresholds and their order decide the segment.
def segment_label(r: Column, f: Column, m: Column) -> Column:
    """First matching rule wins."""
    return (
        F.when((r >= 3) & (f >= 3) & (m >= 3), CHAMPIONS)
        .when((r >= 2) & (f >= 2), LOYAL)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r <= 2) & (f <= 2), HIBERNATING)
        .otherwise(POTENTIAL)
    )


def segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn(
        "RFM_Segment", segment_label(F.col("R_Score"), F.col("F_Score"), F.col("M_Score"))
    )


def segment_rfm(
    c360: DataFrame,
    reference_date: str = REFERENCE_DATE,
    method: str = "range",
    materialized: bool = False,
) -> DataFrame:
    """Segments over a customer-360 table (``materialized``: it was read from a table)."""
    return segments(scores(recency(c360, reference_date), method, materialized))


def segment_counts(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("RFM_Segment").count().orderBy("RFM_Segment")
