"""Ordered previews: top-k by a measure with deterministic tiebreaks.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps its own n
best rows and only those reach the final merge, so no full sort or shuffle happens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    by: str,
    n: int,
    *,
    descending: bool = True,
    tiebreak: tuple[str, ...] = (),
) -> DataFrame:
    key = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    return df.orderBy(key, *[F.col(c).asc_nulls_first() for c in tiebreak]).limit(n)


def first_n(df: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    """First n rows by a key order, so the selection is repeatable."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
