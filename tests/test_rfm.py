"""Quantile scores and segments (FIXTURES E)."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.operators.ntile import SAMPLE, Key, first_rows, ntile_labels, ntile_window
from basketry.plans import rfm
from tests.fixtures import plan_text


def labels(df, k, keys, out, sample=SAMPLE):
    return ntile_labels(df, k, {out: keys}, sample)


def test_ntile_bucket_sizes(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "k int")
    got = labels(df, 4, [Key("k")], "b").orderBy("k").collect()
    assert [r.b for r in got] == [1, 1, 2, 3, 4]
    assert labels(df.limit(0), 4, [Key("k")], "b").collect() == []


def test_recency_desc_null_scores_last(spark):
    df = spark.createDataFrame(
        [("a", "x", None), ("b", "x", 10), ("c", "x", 20), ("d", "x", 30), ("e", "x", 40)],
        "customer_unique_id string, customer_city string, recency_days int",
    )
    keys = [Key("recency_days", descending=True), Key("customer_unique_id")]
    got = {r.customer_unique_id: r.R for r in labels(df, 4, keys, "R").collect()}
    assert [got[k] for k in "abcde"] == [4, 3, 2, 1, 1]


def check_against_window(df, k, orders, sample):
    got = {r.i: r for r in ntile_labels(df, k, orders, sample).collect()}
    for out, keys in orders.items():
        want = ntile_window(df, k, [x.order() for x in keys], "b").collect()
        assert {i: r[out] for i, r in got.items()} == {r.i: r.b for r in want}, out


@settings(max_examples=6, deadline=None)
@given(
    n=st.integers(min_value=0, max_value=80),
    k=st.integers(min_value=1, max_value=7),
    sample=st.integers(min_value=1, max_value=20),
    seed=st.integers(min_value=0, max_value=10_000),
)
def test_selected_labels_equal_window_ntile(spark, n, k, sample, seed):
    """Ties, NULL and NaN keys, both directions, two orders at once, several rounds."""
    rnd = random.Random(seed)
    values = [None, float("nan"), float("inf"), -0.0, 0.0, 1.5, -2.0]
    rows = [(rnd.choice(values), rnd.choice([None, "a", "ä", "z", "中"]), f"i{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "v double, s string, i string").repartition(3)
    orders = {
        "desc": [Key("v", descending=True), Key("i")],
        "asc": [Key("s"), Key("v"), Key("i", descending=True)],
    }
    check_against_window(df, k, orders, sample)


def test_selection_in_many_rounds_on_a_skewed_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 41).cast("int").alias("v"),
        (F.col("id") * 7919 % 30_011).alias("w"),
        F.col("id").alias("i"),
    )
    orders = {"a": [Key("v", descending=True), Key("i")], "b": [Key("w"), Key("i")], "c": [Key("v"), Key("w")]}
    for sample in (300, 4096):
        check_against_window(df, 4, orders, sample)


def test_rows_reaching_the_driver_are_bounded(spark, monkeypatch):
    from basketry.operators import ntile

    seen = []
    sampled = ntile._sampled

    def counted(df, names, searched, sample):
        rows = sampled(df, names, searched, sample)
        seen.append(max(map(len, rows)))
        return rows

    monkeypatch.setattr(ntile, "_sampled", counted)
    labels(spark.range(200_000), 4, [Key("id")], "b", sample=100).count()
    assert max(seen) < 300 and 2 <= len(seen) < 15


def test_labels_need_a_total_order(spark):
    df = spark.range(1000).select(F.lit(1).alias("v"))
    with pytest.raises(ValueError, match="tiebreak"):
        labels(df, 4, [Key("v")], "b", sample=10)


def test_labels_shuffle_nothing(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    assert "Exchange" not in plan_text(labels(df, 4, [Key("v"), Key("id")], "b"))
    assert "SinglePartition" in plan_text(ntile_window(df, 4, [F.col("v").asc(), F.col("id").asc()], "b"))


SEGMENT_TABLE = {
    # (R, F) -> label; Champions needs M >= 3 (else Loyal)
    (1, 1): rfm.HIBERNATING, (1, 2): rfm.HIBERNATING, (1, 3): rfm.AT_RISK, (1, 4): rfm.AT_RISK,
    (2, 1): rfm.HIBERNATING, (2, 2): rfm.LOYAL, (2, 3): rfm.LOYAL, (2, 4): rfm.LOYAL,
    (3, 1): rfm.POTENTIAL, (3, 2): rfm.LOYAL, (3, 3): rfm.CHAMPIONS, (3, 4): rfm.CHAMPIONS,
    (4, 1): rfm.POTENTIAL, (4, 2): rfm.LOYAL, (4, 3): rfm.CHAMPIONS, (4, 4): rfm.CHAMPIONS,
}


def test_all_64_segment_combinations(spark):
    combos = list(itertools.product(range(1, 5), repeat=3))
    df = spark.createDataFrame(combos, "R_Score int, F_Score int, M_Score int")
    got = {(r.R_Score, r.F_Score, r.M_Score): r.RFM_Segment for r in rfm.segments(df).collect()}
    for (r, f, m), label in got.items():
        expected = SEGMENT_TABLE[(r, f)]
        if expected == rfm.CHAMPIONS and m < 3:
            expected = rfm.LOYAL
        assert label == expected, (r, f, m)
    assert len(got) == 64


def test_segment_rfm_both_methods_agree(spark):
    rows = [
        (f"u{i}", "c", i % 3 + 1, float(i * 7 % 11), None if i == 0 else f"2018-0{i % 9 + 1}-01 00:00:00")
        for i in range(30)
    ]
    df = spark.createDataFrame(
        rows, "customer_unique_id string, customer_city string, total_orders long, total_lifetime_value double, t string"
    ).withColumn("last_purchase_date", F.col("t").cast("timestamp_ntz")).drop("t")
    a = {r.customer_unique_id: tuple(r)[-4:] for r in rfm.segment_rfm(df, method="range").collect()}
    b = {r.customer_unique_id: tuple(r)[-4:] for r in rfm.segment_rfm(df, method="window").collect()}
    assert a == b
    assert a["u0"][0] == 4  # NULL recency sorts last in descending order -> bucket 4


def test_bucket_formula_at_huge_row_counts():
    n, k = 10**15 + 3, 4  # buckets of q+1, q+1, q+1, q rows with q = n div 4
    q = n // k
    assert first_rows(n, k) == [(2, q + 2), (3, 2 * (q + 1) + 1), (4, 3 * (q + 1) + 1)]
    assert first_rows(2, 4) == [(2, 2)] and first_rows(0, 4) == []
