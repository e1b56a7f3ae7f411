"""CSV shapes (FIXTURES G) and the registry of raw sources."""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from basketry.sources import csv as csvsrc
from basketry.sources.lookup import TRANSLATION_GATES, read_translation
from basketry.operators.quality import enforce, gate_report

REVIEW_SCHEMA = StructType(
    [
        StructField("review_id", StringType()),
        StructField("order_id", StringType()),
        StructField("review_score", IntegerType()),
        StructField("review_comment_message", StringType()),
    ]
)


def _write(path, text: bytes):
    with open(path, "wb") as f:
        f.write(text)


def test_bom_crlf_quoted_newline_doubled_quotes(spark, tmp_path):
    p = tmp_path / "reviews.csv"
    _write(
        p,
        "﻿review_id,order_id,review_score,review_comment_message\r\n".encode()
        + b'r1,o1,5,"plain"\r\n'
        + b'r2,o2,4,"two\nlines"\r\n'
        + b'r3,o3,3,"she said ""great""\nthen left"\r\n'
        + b"r4,o4,x,\r\n",
    )
    df = csvsrc.read_raw(spark, str(p), multiline=True, schema=REVIEW_SCHEMA)
    rows = {r.review_id: r for r in df.collect()}
    assert sorted(rows) == ["r1", "r2", "r3", "r4"]
    assert rows["r2"].review_comment_message == "two\nlines"
    assert rows["r3"].review_comment_message == 'she said "great"\nthen left'
    assert rows["r4"].review_score is None  # junk score -> NULL, row kept for the filter


def test_columns_matched_by_name_not_position(spark, tmp_path):
    p = tmp_path / "items.csv"
    _write(p, b"price,order_id,extra\r\n12.5,o1,z\r\nabc,o2,z\r\n")
    schema = StructType([StructField("order_id", StringType()), StructField("price", StringType())])
    got = csvsrc.read_raw(spark, str(p), schema=schema).collect()
    assert [tuple(r) for r in got] == [("o1", "12.5"), ("o2", "abc")]


def test_translation_table_with_bom(spark, tmp_path):
    p = tmp_path / "t.csv"
    _write(
        p,
        "﻿product_category_name,product_category_name_english\r\n".encode()
        + b"beleza_saude,health_beauty\r\ninformatica_acessorios,computers_accessories\r\n",
    )
    df = read_translation(spark, str(p))
    assert df.columns == ["product_category_name", "product_category_name_english"]
    assert df.count() == 2
    enforce(gate_report(df, TRANSLATION_GATES, "translation"))


def test_registry_round_trip(spark, tmp_path):
    base = str(tmp_path / "raw")
    df = spark.createDataFrame([("o1", "c1", "delivered", "2018-01-01 00:00:00", None)],
                               "order_id string, customer_id string, order_status string, "
                               "order_purchase_timestamp string, order_delivered_customer_date string")
    csvsrc.write_csv(df, csvsrc.source_path(base, "orders"))
    loaded = csvsrc.load_raw_sources(spark, base, names=["orders"])
    assert loaded["orders"].columns == df.columns
    assert len(csvsrc.RAW_SOURCES) == 9


def test_a_folder_with_differing_headers_fails(spark, tmp_path):
    import pytest

    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n20,10\n")
    with pytest.raises(Exception, match="(?is)header|enforce"):
        csvsrc.read_raw(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text("x,y\n10,20\n")
    assert sorted(map(tuple, csvsrc.read_raw(spark, str(tmp_path)).collect())) == [("1", "2"), ("10", "20")]
