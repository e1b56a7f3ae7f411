"""Join shapes that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fanout_left_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` for a right side with many rows per key.

    In an outer join only the preserved side of a skewed partition can be split at run
    time, so a key holding a large share of the *right* rows ends up in one task. The
    same result is produced as an inner join (both sides splittable) plus the left rows
    whose key has no match, found by an anti join against the right side's distinct
    keys (at most one row per key after map-side combining).
    """
    matched = left.join(right, on, "inner")
    unmatched = left.join(right.select(on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
