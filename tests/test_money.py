"""Sums of amounts that are tiny, huge or no numbers."""

from pyspark.sql import functions as F

from basketry.functions.money import money, money_out, unsummable
from basketry.plans import marts
from tests.fixtures import ITEMS


def test_sub_cent_amounts_add_up(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("price"))
    assert df.agg(money_out(F.sum(money("price")), 2).alias("s")).first().s == 4.0


def test_odd_amounts_do_not_abort_and_are_counted(spark):
    rows = [("o", "p", x, 1.0) for x in (1.5, float("nan"), float("inf"), 1e20, None, 2.5)]
    items = spark.createDataFrame(rows, ITEMS)
    got = marts.item_totals(items).first()
    assert (got.total_revenue, got.total_items) == (4.0, 6)
    assert items.agg(unsummable("price").alias("n")).first().n == 3


def test_amounts_under_a_cent_as_in_sql(spark, tmp_path):
    """One rounding rule: eight digits an amount, cents (half-up) a result."""
    import duckdb

    from basketry.oracle import with_ctes
    from basketry.plans.clean import CLEANERS
    from basketry.sources import starschema as star

    n = 4000
    lines = spark.range(n).select(
        (F.col("id") % 37).alias("l_orderkey"), (F.col("id") % 5).alias("l_partkey"), F.col("id").alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), (F.col("id") % 11 * 0.001).alias("l_quantity"),
        (F.col("id") * 0.00123457 + 0.005).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit(None).cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    items = CLEANERS["items"].clean(star.raw_items(spark, str(tmp_path)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = sorted(map(tuple, marts.item_totals(items).collect()))
    assert got == sorted(con.execute(with_ctes("SELECT * FROM item_totals")).fetchall())
    value = items.agg(money_out(F.sum(money("price") + money("freight_value")), 2).alias("v")).first().v
    sql = "SELECT CAST(round(sum(CAST(price AS DECIMAL(28,8)) + CAST(freight_value AS DECIMAL(28,8))), 2) AS DOUBLE) FROM clean_items"
    assert value == con.execute(with_ctes(sql)).fetchone()[0]


def test_review_fan_out_keeps_all_digits(spark):
    """6,000 orders of 26e-8 with two reviews each: 0.00312, not 6,000 roundings up."""
    from tests.fixtures import CUSTOMERS, PRODUCTS

    n = spark.range(6000)
    order = F.concat(F.lit("o"), F.col("id")).alias("order_id")
    t = F.lit("2018-01-01").cast("timestamp_ntz").alias("order_purchase_timestamp")
    orders = n.select(order, F.lit("c").alias("customer_id"), F.lit("delivered").alias("order_status"), t)
    items = n.select(order, F.lit("p").alias("product_id"), F.lit(0.00000026).alias("price"),
                     F.lit(0.0).alias("freight_value"))
    reviews = n.crossJoin(spark.range(2).select(F.lit(5).alias("review_score"))).select(order, "review_score")
    customers = spark.createDataFrame([("c", "u", "x", "S")], CUSTOMERS)
    got = marts.customer_360(orders, items, customers, spark.createDataFrame([], PRODUCTS), reviews).first()
    assert (got.total_orders, got.total_lifetime_value) == (6000, 0.0)
