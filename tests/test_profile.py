"""Profiling (FIXTURES D) and brute force."""

import random

from basketry.operators import profile as prof


def test_profile_hand_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, None)], "a int, b string")
    s = prof.shape(df).collect()[0]
    assert (s.rows, s.columns) == (4, 2)
    d = prof.duplicates(df).collect()[0]
    assert (d.duplicate_rows, d.duplicate_pct) == (1, 25.0)
    nulls = [(r.column_name, r.null_pct) for r in prof.null_shares(df).collect()]
    assert nulls == [("b", 50.0)]
    summary, n2 = prof.profile(df, "t")
    assert tuple(summary.collect()[0]) == ("t", 4, 2, 1, 25.0)
    assert [(r.column_name, r.null_pct) for r in n2.collect()] == [("b", 50.0)]


def test_profile_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    d = prof.duplicates(df).collect()[0]
    assert (d.rows, d.duplicate_rows, d.duplicate_pct) == (0, 0, 0.0)
    assert prof.null_shares(df).count() == 0
    assert prof.null_pct_wide(df).collect()[0].a is None


def test_profile_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 2, None]), rnd.choice(["p", None]), rnd.choice([0.5, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    summary, nulls = prof.profile(df, "t")
    s = summary.collect()[0]
    assert s.rows == 300 and s.duplicate_rows == 300 - len(set(rows))
    want = {
        c: round(sum(r[i] is None for r in rows) / 300 * 100, 2)
        for i, c in enumerate("abc")
        if any(r[i] is None for r in rows)
    }
    assert {r.column_name: r.null_pct for r in nulls.collect()} == want


def test_profile_all_unions_reports(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(None,)], "y string")
    summary, nulls = prof.profile_all({"a": a, "b": b})
    assert {r.table_name: r.duplicate_rows for r in summary.collect()} == {"a": 1, "b": 0}
    assert [(r.table_name, r.column_name) for r in nulls.collect()] == [("b", "y")]
