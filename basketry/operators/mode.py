"""The most frequent value of a group, in two map-side combined steps.

``mode()`` keeps a map of all values of a group in one task. Here rows are counted per
(group, value) first, so a group with a third of all rows is spread over tasks by its
values, and then the group's largest count is taken, of which every task sends one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heaviest(weight: str, value: str, where: Column) -> Column:
    """Aggregate: the value with the largest weight (ties: the smallest value) among the
    rows that meet ``where``; NULL without any."""
    best = F.min(F.when(where, F.struct((-F.col(weight)).alias("w"), F.col(value).alias("v"))))
    return best["v"]


def mode_by(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """``by`` and the most frequent value of every group; NULL values do not count, but a
    group that has only those is kept."""
    counted = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    return counted.groupBy(*by).agg(heaviest("__n", value, F.col(value).isNotNull()).alias(out))
