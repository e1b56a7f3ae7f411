"""Exchange of hashed values between tasks as packed arrays, and a bitmap of ids.

A value costs 4 bytes and an owner number instead of a row, and a bucket meets all its
values in one group, sorted. Buckets are chosen so that each holds a bounded number of
values; an owner counts once under a value, whatever the number of its copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import free_name

FILTER_BITS = 1 << 23
SLOT_BYTES = 16 << 20  # bytes of text whose owners come together in one group
PACKED = "bucket bigint, low binary, owner binary, owners binary"


def packed(values: np.ndarray, owner: np.ndarray, names: np.ndarray, bits: int) -> pa.RecordBatch:
    """Values as one row per bucket: the ``bits`` leading bits name the bucket, the next
    32 are kept (a chance agreement beyond them only adds a candidate). Owners are named
    by ``names``."""
    order = np.argsort(values)
    values, owner = values[order], owner[order]
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(
        len(values), np.int64
    )
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = (values >> np.uint64(32 - bits)).astype("<u4")
    rows: list[list] = [[], [], [], []]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(values)], strict=True):
        used, place = np.unique(owner[a:b], return_inverse=True)
        rows[0].append(int(bucket[a]))
        rows[1].append(_steps(low[a:b]))
        rows[2].append(place.astype("<u4" if len(used) > 65536 else "<u2").tobytes())
        rows[3].append(names[used].astype("<u8").tobytes())
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(r, t) for r, t in zip(rows, types, strict=True)],
        ["bucket", "low", "owner", "owners"],
    )


def _steps(low: np.ndarray) -> bytes:
    """Sorted values: the width of a step, the first value, and the steps, of 3 bytes
    where all fit."""
    step = np.diff(low).astype("<u4")
    wide = len(step) > 0 and int(step.max()) >= 1 << 24
    body = step.tobytes() if wide else step.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return bytes([4 if wide else 3]) + low[:1].tobytes() + body


def _from_steps(raw: bytes) -> np.ndarray:
    body = np.frombuffer(raw, np.uint8, offset=5)
    if raw[0] == 3:
        full = np.zeros((len(body) // 3, 4), np.uint8)
        full[:, :3] = body.reshape(-1, 3)
        body = full.ravel()
    first = np.frombuffer(raw, "<u4", count=1, offset=1)
    return np.cumsum(np.concatenate([first, body.view("<u4")]).astype(np.uint64)).astype(np.uint32)


def unpacked(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """(low, owner number, owner names) of a bucket, sorted by low and owner."""
    low, names = [], []
    for r in rows.select(["low", "owner", "owners"]).to_pylist():
        v = _from_steps(r["low"])
        place = np.frombuffer(r["owner"], "<u4" if len(r["owner"]) == 4 * len(v) else "<u2")
        low.append(v)
        names.append(np.frombuffer(r["owners"], "<u8")[place])
    value, every = np.concatenate(low), np.concatenate(names)
    known, owner = np.unique(every, return_inverse=True)
    # by value, then owner; an owner counts once under a value
    both = np.unique((value.astype(np.uint64) << np.uint64(32)) | owner.astype(np.uint64))
    return (both >> np.uint64(32)), (both & np.uint64(0xFFFFFFFF)).astype(np.int64), known


def slot_count(total: int) -> int:
    """Groups in which what the buckets found comes together per owner, for ``total`` bytes."""
    return max(1, -(-total // SLOT_BYTES))


def dealt(names: np.ndarray, slots: int) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, places of its names) for every slot that some name falls into: a bucket sends a
    row per slot, not per owner, so rows do not multiply with owners and buckets."""
    slot = (names % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    cut = np.flatnonzero(np.diff(slot[order], prepend=-1))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=False):
        yield int(slot[order[a]]), order[a:b]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def id_filter(ids: DataFrame, column: str) -> bytes:
    """A bitmap of FILTER_BITS bits over ids; its size does not grow with their number."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1  # positions count from 1
    out = bytearray(FILTER_BITS // 8)
    rows = (
        ids.select(at.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    )
    for r in rows.collect():  # at most FILTER_BITS / 32768 rows of 4 KB
        at0 = (r["k"] - 1) * 4096
        out[at0 : at0 + 4096] = r["m"]
    return bytes(out)


def spot(column: str) -> Column:
    """The bit of an id in the bitmap."""
    return F.coalesce(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)), F.lit(0))


def unpacked_bits(bitmap: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").astype(bool)


def _by_filter(rows: DataFrame, column: str, bitmap: bytes, inside: bool) -> DataFrame:
    """The rows whose id is (not) in the bitmap, all columns unchanged."""
    marked = rows.withColumn(free_name(rows, "__spot"), spot(column))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = unpacked_bits(bitmap)
        for b in batches:
            last = b.num_columns - 1
            mine = bits[b.column(last).to_numpy()] == inside
            yield b.filter(pa.array(mine)).select(range(last))

    return marked.mapInArrow(keep, rows.schema)


def only_ids(rows: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """``rows`` without most of those whose id is not among ``ids`` (none of them is
    lost); a join has to follow. The bitmap has a fixed size, so with very many ids it
    just filters less."""
    return _by_filter(rows, column, id_filter(ids, id_column), True)


def without_ids(rows: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """``rows`` whose id is not among ``ids``. Rows outside the bitmap stay where they
    are; only the others are shuffled for the exact anti join."""
    bitmap = id_filter(ids, id_column)
    unsure = _by_filter(rows, column, bitmap, True)
    gone = ids.select(F.col(id_column).alias(column)).distinct()
    sure = _by_filter(rows, column, bitmap, False)
    return sure.unionByName(unsure.join(gone, column, "left_anti").select(rows.columns))
