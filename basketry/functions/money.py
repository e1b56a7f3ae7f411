"""Money arithmetic.

Amounts are stored as double (the cleaned-table contract) but summed as
DECIMAL(28,8): a decimal sum is exact and independent of the order in which a
distributed aggregation adds partial sums, so reruns and other engines agree, and
amounts far under a cent still count. Results are rounded and cast back to double at
the edge only. Amounts that are no finite number, or of 1e20 and more, have no such
decimal: they do not abort a job but are NULL in sums; ``unsummable`` counts them for
a gate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(28, 8)


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast(MONEY)


def money_times(amount: str, count: str) -> Column:
    """An amount times a whole number below 1e9, with all eight digits: a product of wider
    types would be cut to six."""
    return money(amount) * F.col(count).cast("decimal(9,0)")


def unsummable(c: str) -> Column:
    """Aggregate: how many values of ``c`` are present but cannot be summed."""
    return F.count(F.when(F.col(c).isNotNull() & money(c).isNull(), 1))


def money_out(c: Column, digits: int | None = None) -> Column:
    """Decimal aggregate -> double, optionally rounded half-up first."""
    if digits is not None:
        c = F.round(c, digits)
    return c.cast("double")
