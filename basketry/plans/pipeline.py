"""The whole run: raw tables -> cleaned tables (gates first) -> marts -> segments.

Order of the reference's daily schedule: the five cleaning jobs, then customer 360
and the order fact, then segments (reads customer 360) and sales. Each step writes a
versioned table and the next step reads it back, so a lost executor only recomputes
from the last written table, never from the raw files. Jobs without a dependency
between them are submitted together (Spark runs concurrent jobs of one session side
by side), as the reference's schedule runs its cleaning jobs in parallel. The item rows
meet their orders once a run: the order lines (``marts.order_lines``) are written to the
application's scratch folder, and customer 360, the order fact and sales are sums over
them.

Tables live under one root: ``<root>/silver/<name>`` and ``<root>/gold/<name>``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from basketry.operators.quality import enforce, gate_report
from basketry.plans import marts, rfm
from basketry.plans.clean import CLEANERS
from basketry.session import stored
from basketry.sinks.versioned import VersionedTable

SILVER = ("customers", "orders", "items", "reviews", "products")
GOLD = ("customer_360", "fact_orders_enriched", "segment_rfm", "agg_sales_by_state_category_month")


def silver_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/silver/{name}")


def gold_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/gold/{name}")


def clean_job(spark: SparkSession, name: str, raw: DataFrame, root: str) -> VersionedTable:
    """Clean one raw table, write it, run its gates on the written data, then commit."""
    cleaner = CLEANERS[name]
    table = silver_table(spark, root, name)

    def check(written: DataFrame) -> int | None:
        # one aggregation gives the gate results and the row count for the commit record
        rows = enforce(gate_report(written, cleaner.gates, name))
        return rows[0]["rows"] if rows else None

    table.overwrite(cleaner.clean(raw), check=check)
    return table


def gold_job(
    spark: SparkSession,
    name: str,
    root: str,
    silver: dict[str, DataFrame] | None = None,
    reference_date: str = rfm.REFERENCE_DATE,
    lines: DataFrame | None = None,
) -> VersionedTable:
    """Build one mart from the latest cleaned tables (or ``silver``, and the order
    ``lines`` of them where a run has written those) and commit it with its new schema. ``segment_rfm`` reads the committed customer 360."""
    s = silver or {n: silver_table(spark, root, n).read() for n in SILVER}
    if lines is None and name != "segment_rfm":
        lines = marts.order_lines(s["orders"], s["items"], s["products"])
    if name == "customer_360":
        df = marts.customer_360_of(lines, s["customers"], s["reviews"])
    elif name == "fact_orders_enriched":
        df = marts.orders_enriched_of(marts.item_totals_of(lines), s["orders"], s["reviews"], s["customers"])
    elif name == "agg_sales_by_state_category_month":
        df = marts.sales_of(lines, s["customers"])
    elif name == "segment_rfm":
        c360 = gold_table(spark, root, "customer_360").read()
        df = rfm.segment_rfm(c360, reference_date, materialized=True)
    else:
        raise ValueError(f"unknown mart {name!r}; one of {GOLD}")
    table = gold_table(spark, root, name)
    table.overwrite(df, overwrite_schema=True)
    return table


def run_pipeline(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    reference_date: str = rfm.REFERENCE_DATE,
) -> dict[str, VersionedTable]:
    with ThreadPoolExecutor(max_workers=len(SILVER)) as pool:
        futures = {name: pool.submit(clean_job, spark, name, raw[name], root) for name in SILVER}
        # result() re-raises a failed gate: no mart is built from a failed table
        tables: dict[str, VersionedTable] = {name: f.result() for name, f in futures.items()}
    s = {name: t.read() for name, t in tables.items()}
    lines = stored(marts.order_lines(s["orders"], s["items"], s["products"]), "order-lines")

    def chain(first: str, second: str) -> tuple[VersionedTable, VersionedTable]:
        a = gold_job(spark, first, root, s, reference_date, lines)
        b = gold_job(spark, second, root, s, reference_date, lines)
        return a, b

    with ThreadPoolExecutor(max_workers=2) as pool:
        left = pool.submit(chain, "customer_360", "segment_rfm")
        right = pool.submit(chain, "fact_orders_enriched", "agg_sales_by_state_category_month")
        tables["customer_360"], tables["segment_rfm"] = left.result()
        tables["fact_orders_enriched"], tables["agg_sales_by_state_category_month"] = right.result()
    return tables
