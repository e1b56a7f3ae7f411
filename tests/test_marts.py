"""Marts: hand-worked rows (FIXTURES A/B) and brute force on random tables."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from basketry.plans import marts
from tests.fixtures import CUSTOMERS, ITEMS, ORDERS, PRODUCTS, REVIEWS, T1, fanout_tables


def _c360(t):
    return marts.customer_360(t["orders"], t["items"], t["customers"], t["products"], t["reviews"])


def test_customer_360_fanout_and_grain(spark):
    rows = {(r.customer_unique_id, r.customer_city): r for r in _c360(fanout_tables(spark)).collect()}
    sp = rows[("u1", "sp")]
    assert sp.total_orders == 1
    assert sp.total_lifetime_value == 66.0  # 33 counted once per review
    assert sp.average_review_score == 4.0
    assert sp.favorite_category == "auto"  # tie 2-2 -> smallest
    rio = rows[("u1", "rio")]
    assert (rio.total_orders, rio.total_lifetime_value) == (1, 5.5)
    assert rio.average_review_score is None
    assert rio.favorite_category == "toys"
    assert len(rows) == 2


def test_order_fact_keeps_review_fanout(spark):
    t = fanout_tables(spark)
    rows = marts.orders_enriched(t["orders"], t["items"], t["reviews"], t["customers"]).collect()
    got = sorted(
        (r.order_id, r.review_score or 0, r.total_revenue, r.total_freight, r.total_items) for r in rows
    )
    assert got == [("o1", 3, 30.0, 3.0, 2), ("o1", 5, 30.0, 3.0, 2), ("o2", 0, 5.0, 0.5, 1)]


def test_null_freight_and_missing_product(spark):
    t = fanout_tables(spark)
    t["items"] = spark.createDataFrame(
        [("o1", "p1", 10.0, None), ("o2", "px", 5.0, 0.5)], ITEMS
    )
    t["reviews"] = spark.createDataFrame([], REVIEWS)
    rows = {r.customer_city: r for r in _c360(t).collect()}
    assert rows["sp"].total_lifetime_value is None  # price + NULL adds nothing
    assert rows["rio"].favorite_category is None  # product absent: NULL, not 'unknown'
    fact = {r.order_id: r for r in marts.orders_enriched(t["orders"], t["items"], t["reviews"], t["customers"]).collect()}
    assert fact["o1"].total_revenue == 10.0 and fact["o1"].total_freight is None
    sales = marts.sales_by_state_category_month(t["items"], t["orders"], t["customers"], t["products"]).collect()
    cats = {r.product_category_name: r.total_items_sold for r in sales}
    assert cats == {"toys": 1, None: 1}


def _random_tables(spark, seed):
    rnd = random.Random(seed)
    cities = ["a", "b", None]
    cats = ["x", "y", "z", None]
    customers = [(f"c{i}", f"u{i // 3}", rnd.choice(cities), "S") for i in range(12)]
    orders = []
    for i in range(40):
        ts = datetime(2018, 1, 1) + timedelta(days=rnd.randint(0, 300))
        orders.append((f"o{i % 37}", f"c{rnd.randint(0, 13)}", "delivered", ts))  # dup ids, unknown customers
    items = [
        (f"o{rnd.randint(0, 40)}", f"p{rnd.randint(0, 6)}",
         round(rnd.uniform(0, 100), 2), rnd.choice([round(rnd.uniform(0, 9), 2), None]))
        for _ in range(120)
    ]
    products = [(f"p{i}", rnd.choice(cats)) for i in range(6)]  # p6 missing
    reviews = [(f"r{i}", f"o{rnd.randint(0, 40)}", rnd.choice([1, 2, 3, 4, 5, None])) for i in range(50)]
    raw = dict(customers=customers, orders=orders, items=items, products=products, reviews=reviews)
    schemas = dict(customers=CUSTOMERS, orders=ORDERS, items=ITEMS, products=PRODUCTS, reviews=REVIEWS)
    return raw, {k: spark.createDataFrame(v, schemas[k]) for k, v in raw.items()}


def _brute_c360(raw):
    """Row-by-row evaluation of the join chain and the five measures."""
    cust = defaultdict(list)
    for c in raw["customers"]:
        cust[c[0]].append(c)
    prods = defaultdict(list)
    for p in raw["products"]:
        prods[p[0]].append(p)
    revs = defaultdict(list)
    for r in raw["reviews"]:
        revs[r[1]].append(r)
    groups = defaultdict(list)
    for o in raw["orders"]:
        for i in (i for i in raw["items"] if i[0] == o[0]):
            for c in cust[o[1]]:
                for p in prods[i[1]] or [(None, None)]:
                    for r in revs[o[0]] or [(None, None, None)]:
                        groups[(c[1], c[2])].append((o[0], o[3], i[2], i[3], p[1], r[2]))
    out = {}
    for key, rows in groups.items():
        vals = [Decimal(str(pr)) + Decimal(str(fr)) for _, _, pr, fr, _, _ in rows if pr is not None and fr is not None]
        ltv = float(sum(vals).quantize(Decimal("0.01"), ROUND_HALF_UP)) if vals else None
        scores = [s for *_, s in rows if s is not None]
        avg = None
        if scores:
            avg = float(Decimal(repr(sum(scores) / len(scores))).quantize(Decimal("0.1"), ROUND_HALF_UP))
        counts = Counter(cat for *_, cat, _ in rows if cat is not None)
        fav = min(counts, key=lambda k: (-counts[k], k)) if counts else None
        out[key] = (len({r[0] for r in rows}), ltv, max(r[1] for r in rows), avg, fav)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_customer_360_equals_brute_force(spark, seed):
    raw, t = _random_tables(spark, seed)
    got = {
        (r.customer_unique_id, r.customer_city): (
            r.total_orders, r.total_lifetime_value, r.last_purchase_date, r.average_review_score, r.favorite_category
        )
        for r in _c360(t).collect()
    }
    assert got == _brute_c360(raw)


def test_sales_equals_brute_force(spark):
    raw, t = _random_tables(spark, 7)
    state = {c[0]: c[3] for c in raw["customers"]}
    cat = defaultdict(list)
    for p in raw["products"]:
        cat[p[0]].append(p[1])
    exp = defaultdict(lambda: [Decimal(0), 0])
    for i in raw["items"]:
        for o in (o for o in raw["orders"] if o[0] == i[0] and o[1] in state):
            for c in cat[i[1]] or [None]:
                k = (o[3].year, o[3].month, state[o[1]], c)
                exp[k][0] += Decimal(str(i[2]))
                exp[k][1] += 1
    expected = {k: (float(v[0].quantize(Decimal("0.01"))), v[1]) for k, v in exp.items()}
    got = {
        (r.order_year, r.order_month, r.customer_state, r.product_category_name): (r.total_sales, r.total_items_sold)
        for r in marts.sales_by_state_category_month(t["items"], t["orders"], t["customers"], t["products"]).collect()
    }
    assert got == expected


def test_fact_counts_one_row_per_review(spark):
    raw, t = _random_tables(spark, 11)
    fact = marts.orders_enriched(t["orders"], t["items"], t["reviews"], t["customers"])
    with_items = [o for o in raw["orders"] if any(i[0] == o[0] for i in raw["items"])]
    n_rev = Counter(r[1] for r in raw["reviews"])
    assert fact.count() == sum(max(1, n_rev[o[0]]) for o in with_items)


def test_basic_variant(spark):
    t = fanout_tables(spark)
    rows = {r.customer_city: r for r in marts.customer_basic(t["orders"], t["items"], t["customers"]).collect()}
    assert rows["sp"].total_lifetime_value == 33.0 and rows["sp"].total_orders == 1
    assert rows["rio"].last_purchase_date.month == 2
    assert T1.year == 2018


def test_order_lines_serve_all_marts_of_a_run(spark, tmp_path, monkeypatch):
    """The items meet their orders once a run; the marts read the lines and equal those
    built on their own."""
    from basketry.plans import marts, pipeline

    t = fanout_tables(spark)
    t["orders"] = t["orders"].withColumn("order_delivered_customer_date", F.col("order_purchase_timestamp"))
    own = {
        "customer_360": marts.customer_360(t["orders"], t["items"], t["customers"], t["products"], t["reviews"]),
        "fact_orders_enriched": marts.orders_enriched(t["orders"], t["items"], t["reviews"], t["customers"]),
        "agg_sales_by_state_category_month": marts.sales_by_state_category_month(
            t["items"], t["orders"], t["customers"], t["products"]
        ),
    }
    built = []
    order_lines = marts.order_lines
    monkeypatch.setattr(marts, "order_lines", lambda *a: built.append(1) or order_lines(*a))
    tables = pipeline.run_pipeline(spark, t, str(tmp_path))
    assert len(built) == 1
    for name, df in own.items():
        got = tables[name].read()
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
