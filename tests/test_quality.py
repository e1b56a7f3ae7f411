"""Gates (FIXTURES C)."""

import pytest

from basketry.operators.quality import DataQualityError, Gates, enforce, gate_report
from tests.fixtures import plan_text


def _failed(spark, rows, schema, gates):
    df = spark.createDataFrame(rows, schema)
    return {(r.rule, r.columns): r.failed for r in gate_report(df, gates, "t").collect()}


def test_unique_counts_extra_rows(spark):
    got = _failed(spark, [("a",), ("b",), ("b",)], "customer_id string", Gates(unique=(("customer_id",),)))
    assert got == {("unique", "customer_id"): 1}


def test_unique_treats_null_as_a_value(spark):
    got = _failed(spark, [("a",), (None,), (None,)], "k string", Gates(unique=(("k",),)))
    assert got == {("unique", "k"): 1}


def test_not_null(spark):
    got = _failed(spark, [("a",), (None,)], "customer_id string", Gates(not_null=("customer_id",)))
    assert got == {("not_null", "customer_id"): 1}


def test_any_null(spark):
    got = _failed(
        spark, [("o1", None), ("o2", "p")], "order_id string, product_id string",
        Gates(any_null=(("order_id", "product_id"),)),
    )
    assert got == {("any_null", "order_id,product_id"): 1}


def test_empty_table_passes_unless_min_rows(spark):
    df = spark.createDataFrame([], "k string")
    gates = Gates(not_null=("k",), unique=(("k",),))
    assert all(r.passed for r in enforce(gate_report(df, gates, "t")))
    with pytest.raises(DataQualityError):
        enforce(gate_report(df, Gates(min_rows=1), "t"))


def test_enforce_raises_with_detail(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(DataQualityError, match="unique: 1 rows"):
        enforce(gate_report(df, Gates(unique=(("k",),)), "customers"))


def test_several_unique_rules_do_not_expand_the_rows(spark):
    rows = [("a", 1, "x"), ("b", 1, None), ("b", 1, "x"), (None, 2, "x"), (None, 3, None)]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(3)
    gates = Gates(not_null=("k", "v"), unique=(("k",), ("k", "n"), ("n", "v")), any_null=(("k", "v"),), min_rows=7)
    report = gate_report(df, gates, "t")
    got = {(r.rule, r.columns): (r.rows, r.failed) for r in report.collect()}
    assert got == {
        ("not_null", "k"): (5, 2), ("not_null", "v"): (5, 2), ("any_null", "k,v"): (5, 3), ("min_rows", "7"): (5, 2),
        ("unique", "k"): (5, 2), ("unique", "k,n"): (5, 1), ("unique", "n,v"): (5, 1),
    }
    text = plan_text(report)
    assert "Expand" not in text
    empty = gate_report(df.limit(0), gates, "t").collect()
    assert {(r.rule, r.failed) for r in empty} == {("not_null", 0), ("unique", 0), ("any_null", 0), ("min_rows", 7)}
