"""Quantile scoring: ``ntile(k)`` over global orders, without a single-partition sort.

``ntile(k) OVER (ORDER BY ...)`` with no PARTITION BY moves every row into one task
(Exchange SinglePartition). But its buckets are fixed by the k - 1 rows at which a new
bucket begins, so ``ntile_labels`` *selects* those rows, for several orders at once, and
labels every row by comparing it with them: no row is shuffled or sorted.

Selection works in rounds over the key columns. Every row searched for has an open range
(keys of a row before it, keys of a row after it) and a known number of rows inside:

1. rows inside the ranges are thinned by a hash of their keys to about ``SAMPLE`` a range
   and come to the driver, which narrows each range to two of them that should stand
   closely around the row searched for;
2. one aggregation counts, exactly and for all ranges, the rows before and inside the
   narrowed range; a range that missed its row is replaced by the side that holds it.

A round cuts a range to a few hundredths. Ranges with at most 1.5 * ``SAMPLE`` rows are not
thinned: their rows come whole and the row searched for is picked by its position. So the
number of rounds grows with the logarithm of the row count, all scores share the jobs, and
at most about 1.5 * SAMPLE rows per searched row reach the driver at once. The thinning
decides how fast ranges shrink, never the result. The keys must make an order total (add
unique tiebreak columns).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from math import sqrt
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 4096
_HASHES = 1 << 31
NOT_TOTAL = "rows agree in all sort keys: add unique tiebreak columns"


def ntile_window(df: DataFrame, k: int, order: list[Column], out: str) -> DataFrame:
    """Reference form: one global window (single partition). For small inputs/tests."""
    return df.withColumn(out, F.ntile(k).over(Window.orderBy(*order)))


def first_rows(n: int, k: int) -> list[tuple[int, int]]:
    """(bucket, row number from 1 of its first row) of the buckets 2 to k that have rows:
    the first n mod k buckets hold n div k + 1 rows, the others n div k."""
    size, more = divmod(n, k)
    return [(b + 1, b * size + min(b, more) + 1) for b in range(1, k) if b * size + min(b, more) < n]


@dataclass(frozen=True)
class Key:
    """A sort key: ascending with NULLs first, or descending with NULLs last."""

    name: str
    descending: bool = False

    def order(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()

    def after(self, value: object) -> Column:
        """Does the row come after ``value`` in this key's order?"""
        c = F.col(self.name)
        if self.descending:
            return F.lit(False) if value is None else (c < F.lit(value)) | c.isNull()
        return c.isNotNull() if value is None else F.coalesce(c > F.lit(value), F.lit(False))

    def equal(self, value: object) -> Column:
        return F.col(self.name).eqNullSafe(F.lit(value))


def _from(keys: list[Key], values: tuple, with_equal: bool) -> Column:
    """Does the row come after the row with these key values (or is it that row)?"""
    out = F.lit(with_equal)
    for key, value in reversed(list(zip(keys, values, strict=True))):
        out = key.after(value) | (key.equal(value) & out)
    return out


def _ranked(rows: list[tuple], keys: list[Key]) -> list[tuple]:
    """Key values in Spark's order: NULL before and NaN after all numbers."""

    def place(value: object) -> tuple:
        if value is None:
            return (0,)
        odd = value != value  # NaN
        return (2,) if odd else (1, value)

    for i in range(len(keys) - 1, -1, -1):
        rows = sorted(rows, key=lambda r: place(r[i]), reverse=keys[i].descending)
    return rows


@dataclass(frozen=True)
class _Range:
    """The row searched for is number ``at`` (from 0) of the ``n`` rows after ``low`` and
    before ``high`` (None: no bound)."""

    out: str
    bucket: int
    keys: list[Key] = field(compare=False)
    at: int
    n: int
    low: tuple | None = None
    high: tuple | None = None
    denser: int = 1

    def inside(self) -> Column:
        bounds = [] if self.low is None else [_from(self.keys, self.low, False)]
        if self.high is not None:
            bounds.append(~_from(self.keys, self.high, True))
        return reduce(lambda a, b: a & b, bounds, F.lit(True))

    def narrowed(self, some: list[tuple]) -> _Range:
        """The range between two sampled rows, about four deviations of the sampled rank
        around the row searched for; its numbers are not counted yet."""
        share = (self.at + 0.5) / self.n
        spread = 4 * sqrt(len(some) * share * (1 - share)) + 2
        first, last = int(share * len(some) - spread), int(share * len(some) + spread) + 1
        if first < 0 and last >= len(some):  # few rows: halve the range
            return replace(self, low=some[len(some) // 2])
        return replace(
            self,
            low=some[first] if first >= 0 else self.low,
            high=some[last] if last < len(some) else self.high,
        )

    def settled(self, new: _Range, before: int, inside: int) -> _Range:
        """Of the narrowed range, or of the side of it that holds the row searched for;
        ``before`` rows of this range come before ``new``, ``inside`` lie in it."""
        if self.at < before:  # the sampled lower row itself counts as before
            side = replace(self, high=new.low, n=before - 1) if self.at < before - 1 else None
            return side or replace(self, low=new.low, high=new.low, at=0, n=1)
        if self.at < before + inside:
            return replace(new, at=self.at - before, n=inside)
        if self.at == before + inside:
            return replace(self, low=new.high, high=new.high, at=0, n=1)
        skipped = before + inside + 1
        return replace(self, low=new.high, at=self.at - skipped, n=self.n - skipped)

    def known(self) -> tuple | None:
        """The row itself, where it was one of the sampled rows."""
        return self.low if self.low is not None and self.low == self.high else None


def boundaries(
    df: DataFrame, k: int, orders: dict[str, list[Key]], sample: int = SAMPLE
) -> dict[str, list[tuple[int, tuple]]]:
    """Per order, (bucket, key values) of the first row of each bucket but the first."""
    names = list(dict.fromkeys(key.name for keys in orders.values() for key in keys))
    df = df.select(*names).withColumn("__h", F.pmod(F.xxhash64(*names), F.lit(_HASHES)))
    n = df.count()
    searched = [
        _Range(out, bucket, keys, row - 1, n)
        for out, keys in orders.items()
        for bucket, row in first_rows(n, k)
    ]
    found: dict[str, list[tuple[int, tuple]]] = {out: [] for out in orders}
    while searched:
        searched_now = searched
        rows = _sampled(df, names, searched_now, sample)
        narrowed: list[tuple[_Range, _Range]] = []
        searched = []
        for r, some in zip(searched_now, rows, strict=True):
            some = _ranked(some, r.keys)
            whole = 1.5 * r.denser * sample >= r.n
            if whole and len(some) != r.n:
                raise ValueError(NOT_TOTAL)
            if whole:
                found[r.out].append((r.bucket, some[r.at]))
            elif some:
                narrowed.append((r, r.narrowed(some)))
            else:  # thinned too far
                searched.append(replace(r, denser=r.denser * 4))
        for r in _settled(df, narrowed):
            if (row := r.known()) is not None:
                found[r.out].append((r.bucket, row))
            else:
                searched.append(r)
    return {out: sorted(some, key=lambda x: x[0]) for out, some in found.items()}


def _sampled(df: DataFrame, names: list[str], searched: list[_Range], sample: int) -> list[list[tuple]]:
    """Rows of each range: all of them, or about 1.5 * ``sample`` by their hash."""
    wanted = []
    for i, r in enumerate(searched):
        thin = F.lit(True) if r.n <= sample else F.col("__h") < min(1.5 * r.denser * sample / r.n, 1.0) * _HASHES
        wanted.append((i, r.inside() & thin))
    some = df.where(reduce(or_, [w for _, w in wanted])).select(
        *names, F.array_compact(F.array(*[F.when(w, F.lit(i)) for i, w in wanted])).alias("__in")
    )
    out: list[list[tuple]] = [[] for _ in searched]
    for row in some.collect():
        for i in row["__in"]:
            out[i].append(tuple(row[key.name] for key in searched[i].keys))
    return out


def _settled(df: DataFrame, narrowed: list[tuple[_Range, _Range]]) -> list[_Range]:
    """Counts all narrowed ranges in one aggregation."""
    if not narrowed:
        return []
    sums = []
    for i, (old, new) in enumerate(narrowed):
        before = ~_from(new.keys, new.low, False) if new.low != old.low else F.lit(False)
        sums.append(F.count_if(old.inside() & before).alias(f"b{i}"))
        sums.append(F.count_if(new.inside()).alias(f"i{i}"))
    counts = df.agg(*sums).first()
    return [old.settled(new, counts[f"b{i}"], counts[f"i{i}"]) for i, (old, new) in enumerate(narrowed)]


def ntile_labels(df: DataFrame, k: int, orders: dict[str, list[Key]], sample: int = SAMPLE) -> DataFrame:
    """``df`` with ``ntile(k)`` over every order as a column of that name. ``df`` is read
    a few times, so it should be a table; the keys must make each order total."""
    labels = {}
    for out, rows in boundaries(df, k, orders, sample).items():
        label = F.lit(1)
        for bucket, values in rows:
            label = F.when(_from(orders[out], values, True), F.lit(bucket)).otherwise(label)
        labels[out] = label.cast("int")
    return df.withColumns(labels)
