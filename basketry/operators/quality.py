"""Data-quality gates.

All rules of a table are evaluated in one job (the original runs one per rule). Without
unique rules that is a single aggregation. With unique rules, rows are grouped by the first
rule's columns and the groups answer that rule and all others; every further unique rule
groups its own columns only. So there is one shuffle per set of unique columns, combined
map-side, and several distinct counts never expand the rows. The report is a small
DataFrame, one row per rule; ``enforce`` raises before anything is committed when a rule
fails.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataQualityError(Exception):
    """A gate failed; the job must stop before its write is committed."""


@dataclass(frozen=True)
class Gates:
    not_null: tuple[str, ...] = ()
    # each entry: columns that must be unique together (NULL counts as a value)
    unique: tuple[tuple[str, ...], ...] = ()
    # each entry: columns of which none may be NULL in any row
    any_null: tuple[tuple[str, ...], ...] = ()
    # opt-in: fail when the table has fewer rows (the reference passes empty tables)
    min_rows: int | None = None

    def counted(self) -> list[tuple[str, str, F.Column]]:
        """(rule, columns, failing rows of a group of rows) of the rules that only count."""
        out: list[tuple[str, str, F.Column]] = []
        for c in self.not_null:
            out.append(("not_null", c, F.count(F.when(F.col(c).isNull(), 1))))
        for cols in self.any_null:
            cond = reduce(or_, [F.col(c).isNull() for c in cols])
            out.append(("any_null", ",".join(cols), F.count(F.when(cond, 1))))
        return out


SCHEMA = "table_name string, rule string, columns string, rows long, failed long, passed boolean"


def _report(one: DataFrame, table: str, failed: list[tuple[str, str, F.Column]]) -> DataFrame:
    """A row per rule from the single row of counts; ``failed`` are columns of it."""
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(cols).alias("columns"),
            F.col("_rows").alias("rows"),
            count.cast("long").alias("failed"),
        )
        for rule, cols, count in failed
    ]
    return one.select(F.inline(F.array(*entries))).withColumn("passed", F.col("failed") == 0)


def gate_report(df: DataFrame, gates: Gates, table: str = "") -> DataFrame:
    """(table_name, rule, columns, rows, failed, passed) of every rule; ``rows`` is the
    table's row count (the same on every line)."""
    counted = gates.counted()
    sums = [expr.alias(f"_r{i}") for i, (_, _, expr) in enumerate(counted)]
    failed = [(rule, cols, F.col(f"_r{i}")) for i, (rule, cols, _) in enumerate(counted)]
    if gates.min_rows is not None:
        short = F.greatest(F.lit(0), F.lit(gates.min_rows) - F.col("_rows"))
        failed.append(("min_rows", str(gates.min_rows), short))
    if not failed and not gates.unique:
        return df.sparkSession.createDataFrame([], SCHEMA)
    rows = F.count(F.lit(1)).alias("_rows")
    if not gates.unique:
        return _report(df.agg(rows, *sums), table, failed)
    parts = []
    for n, cols in enumerate(gates.unique):
        # a NULL key is a value like any other, as in select(key).distinct().count()
        mine = sums if n == 0 else []
        groups = df.groupBy(*cols).agg(rows, *mine)
        totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in groups.columns[len(cols):]]
        one = groups.agg(*totals, F.count(F.lit(1)).alias("_groups"))
        rule = ("unique", ",".join(cols), F.col("_rows") - F.col("_groups"))
        parts.append(_report(one, table, [rule, *failed] if n == 0 else [rule]))
    return reduce(DataFrame.unionByName, parts)


def enforce(report: DataFrame) -> list:
    """Collect the (rule-count sized) report; raise if any rule failed."""
    rows = report.collect()
    failed = [r for r in rows if r["failed"] > 0]
    if failed:
        detail = "; ".join(
            f"{r['table_name']}.{r['columns']} {r['rule']}: {r['failed']} rows" for r in failed
        )
        raise DataQualityError(f"Data-quality gate failed, nothing committed: {detail}")
    return rows
