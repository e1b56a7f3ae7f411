"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. On each level runs of one symbol become one symbol;
deterministic coin tossing (the lowest bit in which a symbol differs from its left
neighbour, and that bit's value) shrinks symbols to labels below 6 in four rounds, so a
label depends on four neighbours only; local maxima of the labels start phrases; a phrase's
name is a hash of its symbols and is a symbol of the next level. Equal stretches of two
texts therefore get equal names everywhere but near their ends, wherever they stand.

The fingerprint keeps the SKETCH smallest hashed names of level LEVEL and above
(bottom-k); likeness is the bottom-k estimate of the Jaccard similarity.

``neighbours`` pairs every document with the next one in descending order of its id,
without a global window: documents are range-partitioned by id once, a task walks its
sorted rows, and only the first and last row of each partition are joined
across partitions, from the table that the tasks have written. A task walks as many
partitions, one after the other, as hold about 8 MB of text, so that a session with many
shuffle partitions does not write as many small files.

Defined results: null text = empty text, whose fingerprint is empty; two empty
fingerprints are alike (1.0), an empty and another are not (0.0). Texts too short for a
phrase of level LEVEL are one phrase. Rows with equal ids are ordered by text; null ids
come last. A single document is its own neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import blocks, materialize, table, task_count, text_bytes

LEVEL = 2  # phrases of about 9 characters and more
TOP_LEVEL = 5
SKETCH = 40
BLOCK_CHARS = 200_000
TASK_BYTES = 8 << 20  # of text that a task walks, in one range or several
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss(symbol: np.ndarray, head: np.ndarray) -> np.ndarray:
    """One round: 2 * (lowest differing bit) + that bit; the first symbol of a text is
    compared with its complement."""
    left = np.empty_like(symbol)
    left[1:] = symbol[:-1]
    left[head] = ~symbol[head]
    differ = symbol ^ left
    low = differ & (~differ + np.asarray(1, symbol.dtype))
    k = np.bitwise_count(low - np.asarray(1, symbol.dtype))
    return (2 * k + ((symbol & low) != 0)).astype(np.uint8)


def _phrases(symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and text numbers of the phrases of one level."""
    head = np.ones(len(symbol), bool)
    np.not_equal(text[1:], text[:-1], out=head[1:])
    new = head.copy()
    new[1:] |= symbol[1:] != symbol[:-1]
    if not new.all():
        at = np.flatnonzero(new)
        run = np.diff(at, append=len(symbol))
        symbol, text, head = symbol[at], text[at], head[at]
        again = np.flatnonzero(run > 1)
        named = _mix(symbol[again] + run[again].astype(np.uint64) * _BASE)
        symbol[again] = (named | np.uint64(1 << 31)).astype(symbol.dtype)
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & ~head[1:]) + 1
        symbol[same] ^= symbol.dtype.type(2)
    first = np.flatnonzero(head)
    label = _toss(symbol, first)
    for _ in range(3):
        label = _toss(label, first)
    start = head.copy()
    up = label[1:] > label[:-1]
    start[1:-1] |= up[:-1] & (label[1:-1] > label[2:]) & ~head[2:]
    # no phrase of a single symbol at the start of a text
    second = first[first + 1 < len(head)] + 1
    start[second[~head[second]]] = False
    begin = np.flatnonzero(start)
    size = np.diff(begin, append=len(symbol))
    place = np.arange(len(symbol), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)
    power = np.array([pow(int(_BASE), i, 1 << 64) for i in range(int(size.max()) + 1)], np.uint64)
    value = (symbol.astype(np.uint64) + _BASE) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    value *= power[place]
    return _mix(np.add.reduceat(value, begin)), text[begin]


def sketches(texts: list[str]) -> np.ndarray:
    """Fingerprints (SKETCH values, padded with 2**32) of texts, one row each."""
    out = np.full((len(texts), SKETCH), 1 << 32, np.uint64)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    if not sizes.sum():
        return out
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    symbol = np.frombuffer(joined, "<u4").copy()
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    kept = []
    for level in range(1, TOP_LEVEL + 1):
        symbol, text = _phrases(symbol, text)
        if level >= LEVEL:
            value = _mix(symbol ^ np.uint64(level)) >> np.uint64(32)
            kept.append((text.astype(np.uint64) << np.uint64(32)) | value)
            more = np.bincount(text)[text] > 1  # a text of one phrase is finished
            symbol, text = symbol[more], text[more]
            if not len(symbol):
                break
    both = np.unique(np.concatenate(kept))
    owner = (both >> np.uint64(32)).astype(np.int64)
    start = np.searchsorted(owner, np.arange(len(texts)))
    rank = np.arange(len(both)) - start[owner]
    low = rank < SKETCH
    out[owner[low], rank[low]] = both[low] & np.uint64(0xFFFFFFFF)
    return out


def pack(sketch: np.ndarray) -> list[bytes]:
    """Sketches as bytes, big-endian, without padding."""
    full = sketch.astype(">u4")
    n = (sketch < (1 << 32)).sum(1).tolist()
    return [row[:k].tobytes() for row, k in zip(full, n, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bottom-k estimate of the Jaccard similarity, row by row."""
    pad = np.uint64(1 << 32)
    every = np.sort(np.concatenate([a, b], 1), 1)
    real = every < pad
    fresh = real.copy()
    fresh[:, 1:] &= every[:, 1:] != every[:, :-1]
    inside = fresh & (np.cumsum(fresh, 1) <= SKETCH)
    twin = np.zeros_like(fresh)
    twin[:, :-1] = every[:, 1:] == every[:, :-1]
    shared, size = (inside & twin).sum(1), inside.sum(1)
    return np.where(size == 0, 1.0, shared / np.maximum(size, 1))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compare(texts: list[str], following: list[str]) -> dict[str, list]:
    """Result columns of texts and the texts that follow them."""
    n = len(texts)
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    # text i's successor is mostly text i + 1: each text is parsed once
    number: dict[str, int] = {}
    place = [number.setdefault(t, len(number)) for t in [*texts, *following, *changed]]
    own = list(number)
    prints = np.concatenate(
        [sketches(own[i:j]) for i, j in blocks([len(t) for t in own], BLOCK_CHARS)]
    )
    mine, nxt, new = (prints[place[k * n : (k + 1) * n]] for k in range(3))
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed],
        "fingerprint": pack(mine),
        "edited_fingerprint": pack(new),
        "near_edited": likeness(mine, new).tolist(),
        "near_next": likeness(mine, nxt).tolist(),
    }


_RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_TYPES = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _rows(ids: list, id_type, texts: list[str], following: list[str]) -> list[pa.Array]:
    columns = _compare(texts, following)
    return [pa.array(ids, id_type)] + [
        pa.array(c, t) for c, t in zip(columns.values(), _TYPES, strict=True)
    ]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (binary) of every row; no shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("t").to_pylist()]
            for i, j in blocks([len(t) for t in texts], BLOCK_CHARS):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(pack(sketches(texts[i:j])))],
                    ["doc_id", "fingerprint"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint binary")


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likenesses."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    in_all = text_bytes(docs, text)
    n = task_count(docs, in_all)
    tasks = min(n, max(spark.sparkContext.defaultParallelism, -(-in_all // TASK_BYTES)))
    order = [F.col("doc_id").desc_nulls_last(), F.col("t")]
    dealt = rows.repartitionByRange(n, order[0]).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id())
    names = ["part", "role", "doc_id", *[c.split()[0] for c in _RESULT.split(", ")], "t"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edge(role: str, i, id_type, t: str) -> pa.RecordBatch:
            filled = [pa.nulls(1, x) for x in _TYPES]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([role]), pa.array([i], id_type), *filled,
                 pa.array([t], pa.string())],
                names,
            )

        last = id_type = part = None  # last: the row whose successor is still to come
        for b in batches:
            id_type = b.column("doc_id").type
            ids = b.column("doc_id").to_pylist()
            texts = [t or "" for t in b.column("t").to_pylist()]
            if not ids:
                continue
            part = b.column("part")[0].as_py()
            if last is None:
                yield edge("head", ids[0], id_type, texts[0])
            else:
                ids.insert(0, last[0])
                texts.insert(0, last[1])
            last = (ids[-1], texts[-1])
            for i, j in blocks([len(t) for t in texts[:-1]], 2 * BLOCK_CHARS):
                done = _rows(ids[i:j], id_type, texts[i:j], texts[i + 1 : j + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(j - i, part, np.int32)),
                        pa.array(["done"] * (j - i)),
                        *done,
                        pa.nulls(j - i, pa.string()),
                    ],
                    names,
                )
        if last is not None:
            yield edge("tail", last[0], id_type, last[1])

    walked = materialize(
        dealt.mapInArrow(
            walk, f"part int, role string, doc_id {kind}, {_RESULT}, t string"
        ).coalesce(tasks),
        "fingerprints",
    )
    # one head and one tail per partition: a window over partition numbers only
    heads = walked.where("role = 'head'")
    everywhere = Window.orderBy("part")
    follows = heads.select(
        "part",
        F.coalesce(
            F.lead("part").over(everywhere),
            F.min("part").over(everywhere.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("next_part"),
    )
    tails = (
        walked.where("role = 'tail'")
        .select("part", "doc_id", "t")
        .join(follows, "part")
        .join(heads.select(F.col("part").alias("next_part"), F.col("t").alias("next_t")), "next_part")
        .select("doc_id", "t", "next_t")
        .coalesce(tasks)  # a row per partition: no task of its own for each
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    _rows(
                        b.column("doc_id").to_pylist(),
                        b.column("doc_id").type,
                        b.column("t").to_pylist(),
                        b.column("next_t").to_pylist(),
                    ),
                    ["doc_id", *names[3:-1]],
                )

    closed = tails.mapInArrow(close, f"doc_id {kind}, {_RESULT}")
    return walked.where("role = 'done'").select(closed.columns).unionByName(closed)


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole document and of its edited text."""
    return neighbours(table(spark, sf_dir, "documents")).withColumns(
        {
            "fingerprint": F.lower(F.hex("fingerprint")),
            "edited_fingerprint": F.lower(F.hex("edited_fingerprint")),
        }
    )
