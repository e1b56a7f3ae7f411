"""Digest-first distinct counts and the two-level mode."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import distinct, profile
from basketry.operators.mode import mode_by
from tests.fixtures import plan_text

ROWS = [(1, "a", None), (1, "a", None), (1, None, "a"), (None, "a", "1"), (2, "b", "c"), (2, "b", "c"), (2, "b", "c")]
SCHEMA = "x int, y string, z string"


def counts(df):
    return distinct.row_counts(df).first()


def test_counts_and_nulls(spark):
    got = counts(spark.createDataFrame(ROWS, SCHEMA).repartition(3))
    assert tuple(got) == (7, 4, 1, 1, 2)
    assert tuple(counts(spark.createDataFrame([], SCHEMA))) == (0, 0, 0, 0, 0)
    assert tuple(counts(spark.range(5).select())) == (5, 1)


@pytest.mark.parametrize("forced", [lambda cs: [F.lit(7), F.lit(8)], lambda cs: [F.col(cs[0]) % 2, F.lit(1)]])
def test_rows_that_share_a_digest_are_compared_whole(spark, monkeypatch, forced):
    monkeypatch.setattr(distinct, "digest", lambda cs: [c.cast("long") for c in forced(cs)])
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 9), rnd.choice(["p", "q", None]), "s") for _ in range(200)]
    got = counts(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert (got.rows, got.distinct_rows) == (200, len(set(rows)))


def test_floats_compare_as_values(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,)], "v double")
    assert counts(df).distinct_rows == df.distinct().count() == 3


def test_many_columns(spark):
    df = spark.range(20).select(*[F.when(F.col("id") % 7 != i % 7, F.col("id") % 3).alias(f"c{i}") for i in range(70)])
    got = counts(df)
    assert got.distinct_rows == df.distinct().count()
    assert [got[f"__null_{i}"] for i in (0, 62, 69)] == [df.where(f"c{i} IS NULL").count() for i in (0, 62, 69)]


def test_first_shuffle_carries_digests_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan_text(distinct.row_counts(df), "simple")
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(__d0" in line]
    assert shuffles and "bitmap_construct_agg" in text
    out = distinct.row_counts(df)
    assert out.first().distinct_rows == df.count()


def test_mode_against_counting(spark):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 5), rnd.choice(["a", "b", "c", None])) for _ in range(300)] + [(9, None)]
    got = {r.g: r.m for r in mode_by(spark.createDataFrame(rows, "g int, v string").repartition(3), ["g"], "v", "m").collect()}
    for g in {g for g, _ in rows}:
        n = Counter(v for k, v in rows if k == g and v is not None)
        assert got[g] == (min(n, key=lambda v: (-n[v], v)) if n else None)


def test_mode_of_a_hot_group_is_spread_by_value(spark):
    """A third of all rows is one group with very many values: it is counted per (group,
    value) in all tasks before a row per task is left."""
    df = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).alias("g"),
        (F.col("id") * 7919 % 500_009).alias("v"),
    ).unionByName(spark.range(5).select(F.lit(-1).cast("long").alias("g"), F.lit(12).cast("long").alias("v")))
    out = mode_by(df, ["g"], "v", "m")
    text = plan_text(out, "simple")
    assert "mode(" not in text and "hashpartitioning(g" in text and "Aggregate(keys=[g" in text
    assert out.where("g = -1").first().m == 12


def test_profile_counts_rows_that_repeat(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA)
    got = profile.duplicates(df).first()
    assert (got.rows, got.duplicate_rows) == (21, 17)
