"""Table profiling: shape, duplicate rows, NULL share per column.

Rows are grouped by a digest and their NULL pattern (``operators.distinct``), and the
groups answer every question at once: row count, distinct rows, duplicates and NULLs per
column. Only rows whose digest repeats are shuffled and compared whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.distinct import row_counts


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns))
    )


def _dup_pct(dups: F.Column, rows: F.Column) -> F.Column:
    # 0 for an empty table, as in the reference
    return F.round(F.coalesce(F.try_divide(dups * 100, rows), F.lit(0.0)).cast("double"), 2)


def duplicates(df: DataFrame) -> DataFrame:
    """(rows, duplicate_rows, duplicate_pct): rows minus distinct rows; pct to 2 digits."""
    stats = row_counts(df)
    return stats.select(
        "rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        _dup_pct(F.col("rows") - F.col("distinct_rows"), F.col("rows")).alias("duplicate_pct"),
    )


def _null_rows(counts: DataFrame, columns: list[str], table: str | None) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(i).alias("position"),
                F.col(f"__null_{i}").alias("nulls"),
            )
            for i, c in enumerate(columns)
        ]
    )
    out = counts.select("rows", F.inline(entries)).withColumn(
        "null_pct", F.try_divide(F.col("nulls"), F.col("rows")) * 100
    )
    # keep shares above zero, then round to two digits (as the reference prints them)
    out = out.filter(F.col("null_pct") > 0).withColumn("null_pct", F.round("null_pct", 2))
    cols = ["column_name", "position", "null_pct"]
    if table is not None:
        out = out.withColumn("table_name", F.lit(table))
        cols = ["table_name"] + cols
    return out.select(*cols)


def null_shares(df: DataFrame, table: str | None = None) -> DataFrame:
    """(column_name, position, null_pct) for columns with any NULL; pct to 2 digits."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column_name string, position int, null_pct double")
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count(F.when(F.col(f"`{c}`").isNull(), F.lit(1))).alias(f"__null_{i}")
            for i, c in enumerate(df.columns)
        ],
    )
    return _null_rows(counts, df.columns, table)


def null_pct_wide(df: DataFrame) -> DataFrame:
    """One row, one column per input column: percent of NULLs (NULL for an empty table)."""
    total = F.count(F.lit(1))
    return df.agg(
        *[
            (F.try_divide(F.count(F.when(F.col(f"`{c}`").isNull(), F.lit(c))), total) * 100).alias(c)
            for c in df.columns
        ]
    )


def _entries(df: DataFrame, table: str) -> DataFrame:
    """Summary and NULL rows of one table from a single row of counts."""
    dups = F.col("rows") - F.col("distinct_rows")
    summary = F.struct(
        F.lit(table).alias("table_name"),
        F.col("rows"),
        F.lit(len(df.columns)).alias("columns"),
        dups.alias("duplicate_rows"),
        _dup_pct(dups, F.col("rows")).alias("duplicate_pct"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("int").alias("position"),
        F.lit(None).cast("double").alias("null_pct"),
    )
    nulls = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(None).cast("long").alias("rows"),
            F.lit(None).cast("int").alias("columns"),
            F.lit(None).cast("long").alias("duplicate_rows"),
            F.lit(None).cast("double").alias("duplicate_pct"),
            F.lit(c).alias("column_name"),
            F.lit(i).alias("position"),
            (F.try_divide(F.col(f"__null_{i}"), F.col("rows")) * 100).alias("null_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    out = row_counts(df).select(F.inline(F.array(summary, *nulls)))
    # keep shares above zero, then round to two digits (as the reference prints them)
    return out.where(F.col("column_name").isNull() | (F.col("null_pct") > 0)).withColumn(
        "null_pct", F.round("null_pct", 2)
    )


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """Profile of every table: a summary row (table_name, rows, columns, duplicate_rows,
    duplicate_pct) and a row for each column with NULLs (table_name, column_name, position,
    null_pct), from one pass of counts per table."""
    parts = [_entries(df, name) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def profile_all(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``report`` as two DataFrames: (summary, nulls)."""
    both = report(tables)
    is_null_row = F.col("column_name").isNotNull()
    return (
        both.where(~is_null_row).drop("column_name", "position", "null_pct"),
        both.where(is_null_row).select("table_name", "column_name", "position", "null_pct"),
    )


def profile(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(summary, nulls) of one table."""
    return profile_all({table: df})
