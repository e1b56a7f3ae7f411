"""The spark-submit command line, end to end from raw CSV files."""

from pyspark.sql import functions as F

from basketry import jobs
from basketry.plans import pipeline
from basketry.sinks.versioned import VersionedTable
from basketry.sources.csv import source_path, write_csv
from tests.fixtures import fanout_tables


def _raw_csv(spark, base):
    t = fanout_tables(spark)
    t["orders"] = t["orders"].withColumn("order_purchase_timestamp", F.col("order_purchase_timestamp").cast("string"))
    t["orders"] = t["orders"].withColumn("order_delivered_customer_date", F.lit(None).cast("string"))
    for name, df in t.items():
        write_csv(df, source_path(base, name))


def test_cli_jobs_from_csv(spark, tmp_path, capsys):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_csv(spark, raw)
    for source in pipeline.SILVER:
        assert jobs.main(["clean", source, "--raw-dir", raw, "--lake", lake]) == 0
    for mart in ("customer_360", "fact_orders_enriched", "agg_sales_by_state_category_month", "segment_rfm"):
        assert jobs.main(["mart", mart, "--lake", lake]) == 0
    c360 = {r.customer_city: r for r in VersionedTable(spark, f"{lake}/gold/customer_360").read().collect()}
    assert c360["sp"].total_lifetime_value == 66.0 and c360["sp"].favorite_category == "auto"
    seg = VersionedTable(spark, f"{lake}/gold/segment_rfm").read()
    assert seg.count() == 2 and "RFM_Segment" in seg.columns
    assert jobs.main(["history", "--table", f"{lake}/silver/customers"]) == 0
    assert "WRITE" in capsys.readouterr().out
    assert jobs.main(["top", "--table", f"{lake}/gold/customer_360", "--by", "total_lifetime_value", "--n", "1"]) == 0
    assert "66.0" in capsys.readouterr().out


def test_cli_run_and_profile(spark, tmp_path, capsys):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    _raw_csv(spark, raw)
    assert jobs.main(["run", "--raw-dir", raw, "--lake", lake]) == 0
    assert VersionedTable(spark, f"{lake}/gold/agg_sales_by_state_category_month").read().count() == 3
    assert jobs.main(["profile", "--raw-dir", raw, "--sources", "orders,items"]) == 0
    out = capsys.readouterr().out
    assert "orders" in out and "items" in out


def test_cli_prints_every_row(spark, tmp_path, capsys):
    table = VersionedTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1,)], "id int")
    for _ in range(23):
        table.append(df)
    assert jobs.main(["history", "--table", str(tmp_path / "t")]) == 0
    assert capsys.readouterr().out.count("WRITE") == 23
    wide = spark.range(1050).selectExpr("CAST(NULL AS INT) AS c", "id")
    jobs.show_all(wide)
    assert len(capsys.readouterr().out.splitlines()) == 1051
