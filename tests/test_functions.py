"""Scalar cleaning rules on single values (FIXTURES B)."""

from pyspark.sql import functions as F

from basketry.functions import normalize_city, to_double, to_int_score, to_timestamp
from basketry.functions.text import ACCENTED, PLAIN


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_accent_map_is_one_to_one():
    assert len(ACCENTED) == len(PLAIN) == 23


def test_city_lower_then_fold(spark):
    assert _one(spark, ["SÃO PAULO", "Ñu", "Goiânia", None], normalize_city) == [
        "sao paulo",
        "ñu",
        "goiania",
        None,
    ]


def test_to_double_tolerates_junk(spark):
    assert _one(spark, ["12.5", "abc", "-1", None], to_double) == [12.5, None, -1.0, None]


def test_score_to_int_truncates_through_double(spark):
    assert _one(spark, ["5", "0", "6", "5.7", None, "x"], to_int_score) == [5, 0, 6, 5, None, None]


def test_timestamp_junk_is_null(spark):
    out = _one(spark, ["2017-10-02 10:56:33", "zzz"], to_timestamp)
    assert out[0].isoformat() == "2017-10-02T10:56:33"
    assert out[1] is None


def test_checkpoint_root_is_shared_setting_or_local_fallback(spark):
    from basketry.session import checkpoint_root

    root = checkpoint_root(spark)
    assert root and spark.sparkContext.getCheckpointDir()
