"""Cleaning jobs row by row (FIXTURES B)."""

import pytest

from basketry.plans import clean


def test_items_price_rule(spark):
    raw = spark.createDataFrame(
        [("o1", "p", "12.5", "1"), ("o2", "p", "abc", "1"), ("o3", "p", "-1", "1"), ("o4", "p", None, "1")],
        "order_id string, product_id string, price string, freight_value string",
    )
    got = [(r.order_id, r.price) for r in clean.clean_items(raw).collect()]
    assert got == [("o1", 12.5)]


def test_reviews_score_rule(spark):
    raw = spark.createDataFrame(
        [(f"r{i}", "o", s) for i, s in enumerate(["5", "0", "6", "5.7", None])],
        "review_id string, order_id string, review_score string",
    )
    got = sorted((r.review_id, r.review_score) for r in clean.clean_reviews(raw).collect())
    assert got == [("r0", 5), ("r3", 5)]


def test_products_lower_and_fill(spark):
    raw = spark.createDataFrame([("p1", "TOYS", 1), ("p2", None, 2)], "product_id string, product_category_name string, w int")
    assert [tuple(r) for r in clean.clean_products(raw).collect()] == [("p1", "toys"), ("p2", "unknown")]
    wide = clean.clean_products_wide(raw)
    assert wide.columns == ["product_id", "product_category_name", "w"]


def test_orders_whitelist_and_bad_timestamp(spark):
    raw = spark.createDataFrame(
        [("o1", "c", "delivered", "zzz", None), ("o2", "c", "shipped", "2018-01-01", None),
         ("o3", "c", None, "2018-01-01", None)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_delivered_customer_date string",
    )
    rows = clean.clean_orders(raw).collect()
    assert [(r.order_id, r.order_purchase_timestamp) for r in rows] == [("o1", None)]
    with pytest.raises(ValueError, match="order_delivered_customer_date"):
        clean.clean_orders(raw.drop("order_delivered_customer_date"))


def test_timestamps_keep_a_utc_offset(spark):
    raw = spark.createDataFrame(
        [("o1", "c", "delivered", "2018-01-01T00:00:00+05:00", "2018-01-01 00:00:00")],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_delivered_customer_date string",
    )
    row = clean.clean_orders(raw).first()
    assert str(row.order_purchase_timestamp) == "2017-12-31 19:00:00"
    assert str(row.order_delivered_customer_date) == "2018-01-01 00:00:00"


def test_customers_city(spark):
    raw = spark.createDataFrame([("c1", "u1", "SÃO PAULO", "SP")], "customer_id string, customer_unique_id string, customer_city string, customer_state string")
    assert clean.clean_customers(raw).collect()[0].customer_city == "sao paulo"


def test_orders_parse_both_timestamps(spark):
    raw = spark.createDataFrame(
        [("o1", "c", "delivered", "2017-10-02 10:56:33", "2017-10-10 21:25:13"), ("o2", "c", "delivered", "x", None)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_delivered_customer_date string",
    )
    rows = {r.order_id: r for r in clean.clean_orders(raw).collect()}
    assert rows["o1"].order_delivered_customer_date.day == 10
    assert rows["o2"].order_purchase_timestamp is None and rows["o2"].order_delivered_customer_date is None
    assert dict(clean.clean_orders(raw).dtypes)["order_delivered_customer_date"] == "timestamp_ntz"
