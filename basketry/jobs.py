"""Command line for ``spark-submit``: one job per step of the daily run.

    spark-submit basketry/jobs.py clean customers --raw-dir RAW --lake LAKE
    spark-submit basketry/jobs.py mart customer_360 --lake LAKE
    spark-submit basketry/jobs.py mart segment_rfm --lake LAKE [--reference-date D]
    spark-submit basketry/jobs.py run --raw-dir RAW --lake LAKE
    spark-submit basketry/jobs.py profile --raw-dir RAW
    spark-submit basketry/jobs.py history --table LAKE/silver/customers
    spark-submit basketry/jobs.py top --table LAKE/gold/customer_360 --by total_lifetime_value

Raw files are found through the source registry (``--raw-dir`` plus the registered
file name, or ``--path name=uri`` per source). The session comes from the submitting
environment (master, checkpoint folder, resources) plus basketry's defaults.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402

from basketry.operators.profile import profile_all  # noqa: E402
from basketry.operators.topk import top_k  # noqa: E402
from basketry.plans import pipeline, rfm  # noqa: E402
from basketry.session import get_session  # noqa: E402
from basketry.sinks.versioned import VersionedTable  # noqa: E402
from basketry.sources.csv import RAW_SOURCES, load_raw_sources  # noqa: E402


def _paths(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items or []:
        name, _, uri = item.partition("=")
        if name not in RAW_SOURCES or not uri:
            raise SystemExit(f"--path expects <source>=<uri> with a source of {list(RAW_SOURCES)}")
        out[name] = uri
    return out


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="basketry")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("clean", help="clean one raw source into its versioned table")
    c.add_argument("source", choices=pipeline.SILVER)
    c.add_argument("--raw-dir", default="")
    c.add_argument("--path", action="append", default=[])
    c.add_argument("--lake", required=True)

    m = sub.add_parser("mart", help="build one mart from the cleaned tables")
    m.add_argument("mart", choices=pipeline.GOLD)
    m.add_argument("--lake", required=True)
    m.add_argument("--reference-date", default=rfm.REFERENCE_DATE)

    r = sub.add_parser("run", help="all cleaning jobs, then all marts")
    r.add_argument("--raw-dir", default="")
    r.add_argument("--path", action="append", default=[])
    r.add_argument("--lake", required=True)
    r.add_argument("--reference-date", default=rfm.REFERENCE_DATE)

    f = sub.add_parser("profile", help="shape, duplicates and NULL shares of raw sources")
    f.add_argument("--raw-dir", default="")
    f.add_argument("--path", action="append", default=[])
    f.add_argument("--sources", default=",".join(RAW_SOURCES))

    h = sub.add_parser("history", help="version history of a table")
    h.add_argument("--table", required=True)

    t = sub.add_parser("top", help="largest rows of a table by one column")
    t.add_argument("--table", required=True)
    t.add_argument("--by", required=True)
    t.add_argument("--n", type=int, default=10)
    t.add_argument("--tiebreak", default="", help="comma-separated columns for ties")
    return p


def show_all(df: DataFrame) -> None:
    """Print every row, fetched partition by partition."""
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join(str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = get_session("basketry")
    if args.command == "clean":
        raw = load_raw_sources(spark, args.raw_dir, [args.source], _paths(args.path))
        table = pipeline.clean_job(spark, args.source, raw[args.source], args.lake)
        print(f"{args.source}: version {table.latest_version()}")
    elif args.command == "mart":
        table = pipeline.gold_job(spark, args.mart, args.lake, reference_date=args.reference_date)
        print(f"{args.mart}: version {table.latest_version()}")
    elif args.command == "run":
        raw = load_raw_sources(spark, args.raw_dir, list(pipeline.SILVER), _paths(args.path))
        tables = pipeline.run_pipeline(spark, raw, args.lake, args.reference_date)
        for name, t in tables.items():
            print(f"{name}: version {t.latest_version()}")
    elif args.command == "profile":
        names = [n for n in args.sources.split(",") if n]
        summary, nulls = profile_all(load_raw_sources(spark, args.raw_dir, names, _paths(args.path)))
        show_all(summary)
        show_all(nulls)
    elif args.command == "history":
        show_all(VersionedTable(spark, args.table).history())
    elif args.command == "top":
        ties = tuple(c for c in args.tiebreak.split(",") if c)
        top_k(VersionedTable(spark, args.table).read(), args.by, args.n, tiebreak=ties).show(
            args.n, truncate=False
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
