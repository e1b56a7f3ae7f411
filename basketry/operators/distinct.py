"""Exact distinct-row counts that shuffle a digest per row instead of the row.

Rows are grouped by two 64-bit hashes and the pattern of their NULLs (hashes skip NULLs),
with map-side counts, so a copy repeated by a third of all rows crosses the shuffle once
per task. A digest held by one row is one distinct row. Only rows whose digest repeats are
compared whole: a digest may be shared by different rows, and then each of them counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 22  # 128 bitmaps of 4 KB

def digest(columns: list[str]) -> list[Column]:
    """Two hashes of a row, from different seeds."""
    row = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(*row), F.xxhash64(F.lit("second"), *reversed(row))]


def digested(df: DataFrame) -> DataFrame:
    """``df`` with its digest as ``__d0`` and ``__d1`` and which columns are NULL."""
    columns = df.columns
    nulls = F.array(*[F.col(f"`{c}`").isNull() for c in columns])
    # adds nothing, but counts as non-deterministic: the optimiser then leaves a filter on
    # the digest above it, instead of spelling out the digest of many computed columns
    # there and in every constraint it derives from them
    still = F.spark_partition_id() * 0
    return df.withColumns(
        {f"__d{i}": c + still for i, c in enumerate(digest(columns))} | {"__nulls": nulls}
    )


def _position() -> Column:
    return F.pmod(F.col("__d0"), F.lit(FILTER_BITS)) + 1  # positions count from 1


def _repeats(repeated: DataFrame) -> Column:
    """Is the row's digest, by its bit, among the repeated ones? (a scalar subquery, which
    runs before the rows are read)"""
    at = _position()
    bitmaps = (
        repeated.groupBy(F.bitmap_bucket_number(at).alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .agg(F.map_from_entries(F.collect_list(F.struct("k", "bits"))).alias("m"))
    )
    bits = F.try_element_at(bitmaps.scalar(), F.bitmap_bucket_number(at))
    place = F.bitmap_bit_position(at).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1))
    return F.coalesce(bit == 1, F.lit(False))


def row_counts(df: DataFrame) -> DataFrame:
    """One row: rows, distinct_rows and ``__null_<i>``, the NULLs of every column."""
    columns = df.columns
    if not columns:
        n = F.count(F.lit(1))
        return df.agg(n.alias("rows"), F.least(n, F.lit(1).cast("long")).alias("distinct_rows"))
    rows = digested(df)
    names = ["__d0", "__d1", "__nulls"]
    groups = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    nulls = [
        F.sum(F.when(F.col("__nulls")[i], F.col("__n"))).alias(f"__null_{i}") for i in range(len(columns))
    ]
    found = groups.agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), *nulls)
    # different rows under one digest: each beyond the first is one more
    repeated = groups.where("__n > 1").select(*names)
    whole = rows.where(_repeats(repeated)).join(repeated, names, "left_semi").distinct()
    more = whole.groupBy(*names).agg((F.count(F.lit(1)) - 1).alias("more"))
    extra = more.agg(F.sum("more").alias("distinct_rows"))
    both = found.unionByName(extra, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in found.columns])
