"""Physical-plan properties that matter at scale."""

from basketry import registry, session
from tests.fixtures import plan_text

SF = "/root/testdata/sf0.001"


def test_filters_and_projection_reach_the_scan(spark):
    text = plan_text(registry.QUERIES["clean_items"](spark, SF))
    assert "GreaterThanOrEqual(l_extendedprice,0.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in text


def test_customer_360_reads_items_once_and_has_no_single_partition(spark):
    text = plan_text(registry.QUERIES["mart_customer_360"](spark, SF))
    assert text.count("lineitem.parquet") == 1
    assert "SinglePartition" not in text
    assert "Expand" in text  # one grouping-sets pass


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_customer_is_split_and_exact(spark):
    """One customer places a third of all orders: the customer join is split by AQE
    (thresholds lowered so the small test data counts as skewed) and totals stay exact."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from basketry.plans import marts
    from tests.fixtures import CUSTOMERS, PRODUCTS, REVIEWS

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        customers = spark.createDataFrame([(f"c{i}", f"u{i}", "x", "S") for i in range(300)], CUSTOMERS)
        orders = spark.range(n).select(
            F.concat(F.lit("o"), F.col("id")).alias("order_id"),
            F.when(F.col("id") % 3 == 0, F.lit("c0"))
            .otherwise(F.concat(F.lit("c"), F.col("id") % 300))
            .alias("customer_id"),
            F.lit("delivered").alias("order_status"),
            F.lit(datetime(2018, 1, 1)).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        )
        items = spark.range(n).select(
            F.concat(F.lit("o"), F.col("id")).alias("order_id"),
            F.lit("p1").alias("product_id"),
            F.lit(1.0).alias("price"),
            F.lit(0.5).alias("freight_value"),
        )
        products = spark.createDataFrame([("p1", "toys")], PRODUCTS)
        reviews = spark.createDataFrame([], REVIEWS)
        df = marts.customer_360(orders, items, customers, products, reviews)
        rows = {r.customer_unique_id: r for r in df.collect()}
        assert (rows["u0"].total_orders, rows["u0"].total_lifetime_value) == (10_000, 15_000.0)
        assert sum(r.total_orders for r in rows.values()) == n
        assert "SortMergeJoin(skew=true)" in plan_text(df, "simple")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_order_tables(spark):
    from datetime import datetime

    from pyspark.sql import functions as F

    from tests.fixtures import CUSTOMERS, PRODUCTS, REVIEWS

    n = 30_000
    customers = spark.createDataFrame([(f"c{i}", f"u{i}", "x", "S") for i in range(300)], CUSTOMERS)
    orders = spark.range(n).select(
        F.concat(F.lit("o"), F.col("id")).alias("order_id"),
        F.concat(F.lit("c"), F.col("id") % 300).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit(datetime(2018, 1, 1)).cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )
    # one order holds a third of all items
    items = spark.range(3 * n).select(
        F.when(F.col("id") % 3 == 0, F.lit("o0")).otherwise(F.concat(F.lit("o"), F.col("id") % n)).alias("order_id"),
        F.concat(F.lit("p"), F.col("id") % 4).alias("product_id"),
        F.lit(1.0).alias("price"),
        F.lit(0.5).alias("freight_value"),
    )
    products = spark.createDataFrame([("p0", "toys"), ("p1", "auto"), ("p2", "toys"), ("p3", "home")], PRODUCTS)
    return orders, items, customers, products, spark.createDataFrame([], REVIEWS)


def test_hot_order(spark):
    from pyspark.sql import functions as F

    from basketry.plans import marts

    conf = {
        **SKEW_CONF,
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # enough partitions for the size statistics to single out the hot one
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders, items, customers, products, reviews = _hot_order_tables(spark)
        c360 = marts.customer_360(orders, items, customers, products, reviews)
        rows = {r.customer_unique_id: r for r in c360.collect()}
        # items of orders k, k+n, k+2n share k % 3: o0 gets 30,000 items, orders with
        # k % 3 != 0 get three each, the rest none; u0's only order with items is o0
        assert (rows["u0"].total_orders, rows["u0"].total_lifetime_value) == (1, 45_000.0)
        assert sum(r.total_orders for r in rows.values()) == 20_001
        assert "SortMergeJoin(skew=true)" in plan_text(c360, "simple")

        # prices that do not compress, so that the hot partition is large
        priced = items.withColumn("price", F.rand(1))
        sales = marts.sales_by_state_category_month(priced, orders, customers, products)
        got = {r.product_category_name: r.total_items_sold for r in sales.collect()}
        assert sum(got.values()) == 90_000
        # the hot order's partition is split in the join of items and orders
        assert "SortMergeJoin(skew=true)" in plan_text(sales, "simple")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_product(spark):
    """One product is on a third of all items: the items-to-products left join is split
    on its preserved (items) side and every mart total stays exact."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from basketry.plans import marts
    from tests.fixtures import CUSTOMERS, REVIEWS

    conf = {**SKEW_CONF, "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        customers = spark.createDataFrame([(f"c{i}", f"u{i}", "x", "S") for i in range(300)], CUSTOMERS)
        orders = spark.range(n).select(
            F.concat(F.lit("o"), F.col("id")).alias("order_id"),
            F.concat(F.lit("c"), F.col("id") % 300).alias("customer_id"),
            F.lit("delivered").alias("order_status"),
            F.lit(datetime(2018, 1, 1)).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        )
        items = spark.range(3 * n).select(
            F.concat(F.lit("o"), F.col("id") % n).alias("order_id"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("product_id"),
            F.lit(2.0).alias("price"),
            F.lit(0.0).alias("freight_value"),
        )
        products = spark.range(500).select(
            F.concat(F.lit("p"), F.col("id")).alias("product_id"), F.lit("misc").alias("product_category_name")
        ).unionByName(spark.createDataFrame([("hot", "toys")], "product_id string, product_category_name string"))
        sales = marts.sales_by_state_category_month(items, orders, customers, products)
        got = {r.product_category_name: (r.total_sales, r.total_items_sold) for r in sales.collect()}
        assert got == {"toys": (60_000.0, 30_000), "misc": (120_000.0, 60_000)}
        assert "SortMergeJoin(skew=true)" in plan_text(sales, "simple")
        c360 = marts.customer_360(orders, items, customers, products, spark.createDataFrame([], REVIEWS))
        assert sum(r.total_lifetime_value for r in c360.collect()) == 180_000.0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_segments_move_no_customer_row_into_one_task(spark):
    text = plan_text(registry.QUERIES["rfm_segments"](spark, SF))
    assert "SinglePartition" not in text and "Window" not in text


def test_hot_review_is_split(spark):
    """A third of all reviews belong to one order: the join of orders and reviews is
    split, on a session without the library's settings but for the query's own."""
    from pyspark.sql import functions as F

    from basketry.plans import marts
    from tests.fixtures import PRODUCTS

    conf = {
        **SKEW_CONF,
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders, items, customers, _, _ = _hot_order_tables(spark)
        orders = spark.createDataFrame(orders.collect(), orders.schema)
        reviews = spark.range(90_000).select(
            F.col("id").cast("string").alias("review_id"),
            F.when(F.col("id") % 3 == 0, F.lit("o1")).otherwise(F.concat(F.lit("o"), F.col("id") % 30_000))
            .alias("order_id"),
            (F.col("id") % 5 + 1).cast("int").alias("review_score"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        fact = marts.orders_enriched(orders, items, reviews, customers)
        rows = fact.groupBy("order_id").count().where("order_id = 'o1'").collect()
        assert rows[0]["count"] == 30_000 + 3
        fact.collect()
        text = plan_text(fact, "simple")
        assert "SortMergeJoin(skew=true)" in text

        products = spark.createDataFrame([(f"p{i}", "c") for i in range(4)], PRODUCTS)
        few = items.where("order_id <> 'o0'")
        chain = marts.joined_chain(orders, few, customers, products, reviews)
        assert chain.where("order_id = 'o1'").count() == 3 * (30_000 + 3)
        text = plan_text(chain, "simple")
        assert "FullOuter" not in text and text.count("LeftOuter") == 1  # the products only
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_marts_bound_the_partitions_of_any_session(spark):
    """The marts merge shuffled partitions up to 16 MB, whatever larger size the session
    they are given allows; a smaller one stays."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name)
    try:
        for query in ("mart_customer_360", "win_ntile_asc"):
            spark.conf.set(name, "64MB")
            registry.QUERIES[query](spark, SF)
            assert spark.conf.get(name) == "16m"
        spark.conf.set(name, "8388608b")
        registry.QUERIES["mart_customer_360"](spark, SF)
        assert spark.conf.get(name) == "8388608b"
    finally:
        spark.conf.set(name, old)


def test_marts_deal_large_inputs_to_more_partitions(spark, monkeypatch):
    """A session with few shuffle partitions does not make the tasks of the marts grow with
    the tables: shuffles start from a number that follows the size of the scanned files."""
    few, first = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    old = {k: spark.conf.get(k, None) for k in (few, first)}
    try:
        spark.conf.set(few, "2")
        spark.conf.unset(first)
        monkeypatch.setattr(session, "PARTITION_INPUT", 1 << 12)
        df = registry.QUERIES["mart_customer_360"](spark, SF)
        tables = registry.cleaned(spark, SF).values()
        assert int(spark.conf.get(first)) == -(-session.scanned_bytes(tables) // (1 << 12)) > 20
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f", {spark.conf.get(first)})" in plan
        spark.conf.set(first, "100000")  # a larger number stays
        registry.QUERIES["mart_customer_360"](spark, SF)
        assert spark.conf.get(first) == "100000"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_customer_scores_bound_their_tasks_on_any_session(spark, monkeypatch):
    """What is computed from customer 360 has its bounds, too: merged partitions of 16 MB, and
    shuffles that start from a number of partitions that follows the tables."""
    first, size = (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    old = {k: spark.conf.get(k, None) for k in (first, size)}
    monkeypatch.setattr(session, "PARTITION_INPUT", 1 << 10)
    try:
        wanted = -(-session.scanned_bytes(registry.cleaned(spark, SF).values()) // (1 << 10))
        for name in ("prj_sql_expr", "rfm_recency", "rfm_scores", "rfm_segment_counts", "rfm_segments"):
            spark.conf.unset(first)
            spark.conf.set(size, "64MB")
            registry.QUERIES[name](spark, SF)
            assert spark.conf.get(first) == str(wanted) and spark.conf.get(size) == "16m"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
