"""Shared helpers of the corpus operators: table access, materialisation, splits.

Python code of this subpackage runs inside Spark tasks (Arrow batches, numpy).
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterator, Sequence
from contextlib import contextmanager, suppress
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; read by Spark only (the path may be any Hadoop URI)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARROW_ROWS = 1000  # rows that a task's Python process gets at once


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    old = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def arrow_rows(spark: SparkSession, most: int):
    """Jobs started inside hand Python at most ``most`` rows at once (for wide rows)."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(most))


def materialize(df: DataFrame, name: str, rows: int = ARROW_ROWS, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor re-reads the table instead of recomputing it. Python
    stages of ``df`` get at most ``rows`` rows at once. ``tidy`` lets Spark delete the
    job's shuffle files as soon as the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with arrow_rows(spark, rows):
        if tidy:
            with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
                df.select("*").write.option("compression", "zstd").parquet(path)
        else:
            df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table that ``materialize`` wrote and no later job reads."""
    spark = df.sparkSession
    relation = df._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation()
    path = relation.location().rootPaths().apply(0)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(modulus))


def task_count(df: DataFrame, bytes_total: int, bytes_per_task: int = 16 << 20) -> int:
    """Partitions for ``bytes_total`` bytes, at least the session's shuffle setting."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-bytes_total // bytes_per_task))


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows (one narrow pass)."""
    row = df.agg(F.sum(F.octet_length(text)).alias("b")).first()
    return int(row["b"] or 0)


def blocks(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` in total (a larger row stands alone)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_blocks(column: pa.Array, most: int) -> Iterator[tuple[int, int, list[str | None]]]:
    """(first row, end row, texts) of consecutive rows with at most ``most`` UTF-8 bytes, so
    that a task holds Python strings of one block only."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for i, j in blocks(sizes, most):
        yield i, j, column.slice(i, j - i).to_pylist()


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker and used by its later tasks. The
    functions of this package are sent by value and have no globals of their own to keep
    it in; a worker keeps one object only."""
    store = sys.modules.setdefault("basketry_kept", types.ModuleType("basketry_kept")).__dict__
    if store.get("key") != key:
        store["value"] = None
        store["key"], store["value"] = key, make()
    return store["value"]


def give_back() -> None:
    """Memory that this Python worker has freed goes back to the system. Spark keeps idle
    workers for a minute; otherwise they keep the memory of their largest block, too."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that gives its memory back when it ends."""

    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return to_the_end


def planes(x: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes byte plane by byte plane: the high planes of small numbers are
    nearly all zero and compress away."""
    return x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def from_planes(raw: bytes, width: int = 4) -> np.ndarray:
    every = np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy()
    return every.view(f"<u{width}").ravel().astype(np.int64)


def squeezed(raw: bytes) -> bytes:
    """zstd with the length in front: a shuffle compresses by lz4 only, which does not make use
    of values that are frequent without being in a row."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
