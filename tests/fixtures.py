"""Hand-made rows (FIXTURES.md §4) as DataFrames."""

from datetime import datetime

CUSTOMERS = "customer_id string, customer_unique_id string, customer_city string, customer_state string"
ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz"
ITEMS = "order_id string, product_id string, price double, freight_value double"
PRODUCTS = "product_id string, product_category_name string"
REVIEWS = "review_id string, order_id string, review_score int"

T1 = datetime(2018, 1, 1, 10, 0, 0)
T2 = datetime(2018, 2, 1, 10, 0, 0)


def fanout_tables(spark):
    """A: two accounts of one person in two cities; o1 has two reviews, o2 none."""
    return dict(
        customers=spark.createDataFrame(
            [("c1", "u1", "sp", "SP"), ("c2", "u1", "rio", "RJ")], CUSTOMERS
        ),
        orders=spark.createDataFrame(
            [("o1", "c1", "delivered", T1), ("o2", "c2", "delivered", T2)], ORDERS
        ),
        items=spark.createDataFrame(
            [("o1", "p1", 10.0, 1.0), ("o1", "p2", 20.0, 2.0), ("o2", "p1", 5.0, 0.5)], ITEMS
        ),
        products=spark.createDataFrame([("p1", "toys"), ("p2", "auto")], PRODUCTS),
        reviews=spark.createDataFrame([("r1", "o1", 5), ("r2", "o1", 3)], REVIEWS),
    )


def plan_text(df, mode="formatted"):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
