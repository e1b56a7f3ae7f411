"""Write PLANS.md: physical-plan trees of the headline queries.

Broadcast joins are switched off so the trees show the shape the plans take when no
dimension fits under the broadcast threshold (the 100 TB case); with small
dimensions Spark replaces the matching sort-merge joins by broadcast joins.
Usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry import registry  # noqa: E402
from basketry.session import get_session  # noqa: E402

QUERIES = [
    ("mart_customer_360", "items meet their order once; (order, category) reduction in place; one GROUPING SETS pass"),
    ("mart_orders_enriched", "per-order item totals; review fan-out as inner join + anti join on distinct keys"),
    ("mart_sales_state_category_month", "sums over the order lines, at most a row per order and category, per output group"),
    ("win_ntile_desc", "distributed ntile: rows of a written table, labelled by comparison with the three selected boundary rows"),
    ("prof_all", "profile: groups by row digest; whole rows only where a digest repeats (bitmap subquery)"),
    ("dq_report", "gates: one aggregation per table, by the unique columns where there is such a rule"),
]


def explain(df) -> tuple[str, list[str]]:
    """(operator tree, one line per parquet scan: table, pushed filters, read schema)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    body, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if "Scan parquet" not in block.split("\n", 1)[0]:
            continue
        fields = dict(
            line.split(": ", 1) for line in block.splitlines()[1:] if ": " in line
        )
        table = fields.get("Location", "").rsplit("/", 1)[-1].rstrip("]")
        scans.append(
            f"- `{block.splitlines()[0].strip()}` {table}: pushed {fields.get('PushedFilters', '[]')}, "
            f"reads `{fields.get('ReadSchema', '')}`"
        )
    return body.replace("== Physical Plan ==\n", ""), scans


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(
        master="local[8]",
        shuffle_partitions=16,
        conf={
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the headline queries\n")
    print("Generated by `python tools/plans.py` with broadcast joins off (the shape when no")
    print("dimension is small). `Exchange` = shuffle. The only explicit broadcasts are the")
    print("fixed-size nation/region tables of the test adapters.\n")
    for name, note in QUERIES:
        df = registry.QUERIES[name](spark, sf)
        body, scans = explain(df)
        print(f"## {name}\n\n{note}.\n\n```\n{body.rstrip()}\n```\n")
        print("\n".join(scans) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
