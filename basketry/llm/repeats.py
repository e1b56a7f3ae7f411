"""Removal of passages that repeat across documents, by merging shard BWTs.

A byte goes when a WINDOW-byte string that covers it also starts in a document with a
smaller id (strings are judged on the input).

1. Copies. Of equal texts only the one with the smallest id is looked at; the others go
   as a whole.
2. Anchors. Every window has one anchor, the K-gram with the smallest hash inside it
   (leftmost of equals) - a function of the window's bytes, so equal windows anywhere
   have equal anchors at the same place. Windows of neighbouring starts share anchors,
   so a text has one anchor in about 16 bytes. Anchors meet in hash buckets as packed
   arrays; an anchor of a single text ends there.
3. Phrases. A shared anchor's windows in one text are one phrase, aligned at the anchor.
   Equal phrases are one, with the smallest id of a document that holds them (combined
   per task and then per key, so a passage in a third of all documents is a row per
   task). An anchor with very many different phrases is taken apart into its windows.
4. Shard BWTs. The phrases of a bucket of anchors are split into shards, and each shard
   keeps, column by column from the right, the characters before its sorted suffixes:
   its Burrows-Wheeler transform in the positional form for aligned strings. The shards
   are merged by refining their interleave: each column's interleave follows from the
   last one by a stable split on the transforms' characters, and the common prefixes of
   neighbours follow from range minima of the last ones. No suffix is sorted again.
   Neighbours with WINDOW common bytes form the repeated intervals; each interval's
   smallest document is its source.
5. The intervals go back to the phrases' occurrences (a join that can be split), become
   byte ranges per document, and only documents that lose bytes are read again.

Defined results: null text = empty text. Texts under WINDOW bytes lose nothing. Rows
with a null id neither lose bytes nor are a source; of rows with equal ids none is
smaller, and an id that stands for several different texts loses bytes only where a
whole text is a copy. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import blocks, materialize, table, text_blocks, text_bytes
from basketry.llm.exchange import PACKED, dealt, only_ids, packed, signed, slot_count, unpacked

WINDOW = 50
K = 20
SPAN = WINDOW - K  # an anchor lies 0..SPAN bytes after its window's start
COLUMNS = SPAN + WINDOW
BLOCK_BYTES = 1 << 17
PART_BYTES = 1 << 22
TEXT_BYTES = 1 << 20  # texts that a task holds as strings at once
BUCKET_VALUES = 1_500_000
TASK_VALUES = 1_500_000
TASK_PHRASES = 100_000
BUCKET_PHRASES = 20_000
MANY_PHRASES = 50_000  # of one anchor
SHARD_PHRASES = 4_096
_ABSENT = 0xFF  # never a byte of UTF-8


# ---- anchors


def anchors(raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the texts at first..first + size of ``raw``: (hash, text, place of the
    anchor, first and last window start) per anchor and run of windows."""
    n = len(raw)
    padded = np.zeros(n + 64, np.uint64)
    padded[:n] = raw
    word = padded
    for shift in (1, 2, 4):
        word = word[:-shift] | (word[shift:] << np.uint64(8 * shift))
    hash_ = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    hash_ ^= hash_ >> np.uint64(31)
    hash_ += word[8 : n + 8]
    hash_ *= np.uint64(0xBF58476D1CE4E5B9)
    hash_ ^= hash_ >> np.uint64(29)
    hash_ += word[16 : n + 16] & np.uint64((1 << 8 * (K - 16)) - 1)
    hash_ *= np.uint64(0x94D049BB133111EB)
    hash_ ^= hash_ >> np.uint64(32)
    # smallest hash of the window's K-grams, leftmost of equals
    best = (hash_ & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN + 1:
        best[: n - width] = np.minimum(best[: n - width], best[width:])
        width *= 2
    rest = SPAN + 1 - width
    best[: n - rest] = np.minimum(best[: n - rest], best[rest:])
    place = (best & np.uint64((1 << 24) - 1)).astype(np.int32)
    valid = np.zeros(n + 1, np.int8)
    windows = np.flatnonzero(size >= WINDOW)
    np.add.at(valid, first[windows], 1)
    np.add.at(valid, first[windows] + size[windows] - WINDOW + 1, -1)
    open_ = np.cumsum(valid[:n], dtype=np.int8) > 0
    change = np.ones(n, bool)
    change[1:] = (place[1:] != place[:-1]) | (open_[1:] != open_[:-1])
    change[first[windows]] = True
    at = np.flatnonzero(change)
    end = np.append(at[1:], n) - 1
    live = open_[at]
    at, end = at[live], end[live]
    text = np.searchsorted(first, at, "right") - 1
    # anchors are small hashes by choice; spread them evenly over the buckets again
    name = hash_[place[at]]
    name = (name ^ (name >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    name = (name ^ (name >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return name ^ (name >> np.uint64(31)), text, place[at], at, end


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """A long text as overlapping parts that hold all its windows."""
    step = PART_BYTES
    for start in range(0, max(1, len(raw) - WINDOW + 1), step):
        yield start, raw[start : start + step + WINDOW - 1]


def _batches(texts: list[bytes]) -> Iterator[tuple]:
    """(bytes, first, size, text number, offset of the part in its text); texts without a
    window are left out."""
    parts = [(i, o, p) for i, t in enumerate(texts) if len(t) >= WINDOW for o, p in _pieces(t)]
    for i, j in blocks([len(p) for _, _, p in parts], BLOCK_BYTES):
        size = np.array([len(p) for _, _, p in parts[i:j]], np.int64)
        raw = np.frombuffer(b"".join(p for _, _, p in parts[i:j]), np.uint8)
        number = np.array([k for k, _, _ in parts[i:j]])
        offset = np.array([o for _, o, _ in parts[i:j]])
        yield raw, np.cumsum(size) - size, size, number, offset


def _text_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


DOCUMENT = "doc_id bigint, a bigint, n_bytes bigint, digest binary, n bigint, anchors binary"


def survey(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of documents (doc_id, text name a, n_bytes, digest) and, with a null digest, for
    every bucket (in ``n_bytes``) and slot ``a`` of the texts' names the shared anchors of its
    ``n`` texts, packed for ``_anchors_of``."""
    total = max(1, text_bytes(docs, text))
    slots = slot_count(total)
    bits = max(0, math.ceil(math.log2(max(1, total / 16 / BUCKET_VALUES))))
    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, owners, names, seen, held = [], [], [], set(), 0

        def flush() -> pa.RecordBatch:
            return packed(
                np.concatenate(values), np.concatenate(owners),
                np.array(names, np.int64).view(np.uint64), bits,
            )

        for b in batches:
            for i, j, texts in text_blocks(b.column("t"), TEXT_BYTES):
                raws = [(t or "").encode() for t in texts]
                digests = [hashlib.sha256(t).digest() for t in raws]
                ids = b.column("i").slice(i, j - i)
                null = np.array(ids.is_null())
                sizes = np.array([len(t) for t in raws], "<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([-1 - (_text_id(digests[0]) & 0x7FFFFFFF)], pa.int64()),
                        pa.array([ids.fill_null(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                        pa.array([null.tobytes()], pa.binary()),
                        pa.array([b"".join(digests) + sizes.tobytes()], pa.binary()),
                    ],
                    ["bucket", "low", "owner", "owners"],
                )
                fresh = []
                for t, d, u in zip(raws, digests, (~null).tolist(), strict=True):
                    if u and d not in seen:  # equal texts of a task are sent once
                        seen.add(d)
                        fresh.append((t, _text_id(d)))
                base = len(names)
                names += [d for _, d in fresh]
                for raw, first, size, number, _ in _batches([t for t, _ in fresh]):
                    hash_, part, _, _, _ = anchors(raw, first, size)
                    values.append(hash_)
                    owners.append(base + number[part])
                    held += len(hash_)
                if held >= TASK_VALUES:
                    yield flush()
                    values, owners, names, seen, held = [], [], [], set(), 0
        if held:
            yield flush()

    def receive(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket < 0:
            out = []
            for r in rows.to_pylist():
                ids, null = np.frombuffer(r["low"], "<i8"), np.frombuffer(r["owner"], "?")
                n = len(ids)
                digests = [r["owners"][32 * i : 32 * i + 32] for i in range(n)]
                out.append(pa.table({
                    "doc_id": pa.array(ids, pa.int64(), mask=null),
                    "a": pa.array([_text_id(d) for d in digests], pa.int64()),
                    "n_bytes": np.frombuffer(r["owners"][32 * n :], "<i8"),
                    "digest": pa.array(digests, pa.binary()),
                    "n": pa.nulls(n, pa.int64()),
                    "anchors": pa.nulls(n, pa.binary()),
                }))
            return pa.concat_tables(out)
        value, owner, known = unpacked(rows)
        twin = np.zeros(len(value) + 1, bool)
        twin[1:-1] = value[1:] == value[:-1]
        shared = np.flatnonzero(twin[:-1] | twin[1:])
        order = shared[np.argsort(owner[shared], kind="stable")]
        cut = np.flatnonzero(np.diff(owner[order], prepend=-1))
        low = value[order].astype("<u4")
        names, counts = known[owner[order[cut]]].astype("<u8"), np.diff(np.append(cut, len(order)))
        parts = list(dealt(names, slots))
        n = len(parts)
        return pa.table({
            "doc_id": pa.nulls(n, pa.int64()),
            "a": pa.array([slot for slot, _ in parts], pa.int64()),
            "n_bytes": pa.array([bucket] * n, pa.int64()),
            "digest": pa.nulls(n, pa.binary()),
            "n": pa.array([len(at) for _, at in parts], pa.int64()),
            "anchors": pa.array(
                [
                    names[at].tobytes() + counts[at].astype("<u4").tobytes()
                    + low[_spread(cut[at], counts[at])].tobytes()
                    for _, at in parts
                ],
                pa.binary(),
            ),
        })

    sent = rows.mapInArrow(send, PACKED)
    found = sent.groupBy("bucket").applyInArrow(receive, DOCUMENT)
    return found.withColumn("bits", F.lit(bits))


# ---- arrays in binary columns


def _column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows hold ``counts`` 8-byte whole numbers each."""
    offsets = np.concatenate([[0], np.cumsum(counts) * 8]).astype("<i4")
    data = np.ascontiguousarray(values, "<i8")
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(counts), buffers)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, numbers per row) of such a column."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "<i4")[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return flat.view("<i8") if len(flat) % 8 == 0 and flat.ctypes.data % 8 == 0 else (
        np.frombuffer(flat.tobytes(), "<i8")
    ), np.diff(at) // 8


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] numbers), and so on."""
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def _anchors_of(rows: pa.Table) -> pa.Table:
    """(a, anchors, bits): all shared anchors of each of a slot's texts."""
    names, counts, values = [], [], []
    for bucket, n, raw in zip(
        *(rows.column(c).to_pylist() for c in ("n_bytes", "n", "anchors")), strict=True
    ):
        names.append(np.frombuffer(raw, "<u8", n))
        counts.append(np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64))
        low = np.frombuffer(raw, "<u4", offset=12 * n)
        values.append(low.astype(np.int64) | (bucket << 32))
    name, count, value = np.concatenate(names), np.concatenate(counts), np.concatenate(values)
    order = np.argsort(name, kind="stable")
    at = _spread((np.cumsum(count) - count)[order], count[order])
    known, first = np.unique(name[order], return_index=True)
    return pa.table({
        "a": signed(known),
        "anchors": _column(value[at], np.add.reduceat(count[order], first)),
        "bits": np.full(len(known), rows.column("bits")[0].as_py(), np.int32),
    })


# ---- phrases

PHRASE = (
    "h bigint, sid bigint, rel int, phrase binary, doc bigint, last bigint, docs binary, "
    "places binary"
)


def phrases(texts: DataFrame) -> DataFrame:
    """Phrases around shared anchors of rows (doc_id, t, anchors, bits), equal ones of a
    task together: the smallest document and all occurrences."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        found: dict[tuple[int, bytes], list] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(found.items())
            for i in range(0, len(rows), 20_000):
                some = rows[i : i + 20_000]
                counts = np.array([len(v[1]) for _, v in some])
                docs = np.array([d for _, v in some for d in v[1]], np.int64)
                places = np.array([p for _, v in some for p in v[2]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k, _ in some], pa.int64()),
                        pa.array([_sid(xxhash, k[1]) for k, _ in some], pa.int64()),
                        pa.array([v[0] for _, v in some], pa.int32()),
                        pa.array([k[1] for k, _ in some], pa.binary()),
                        pa.array(np.minimum.reduceat(docs, np.cumsum(counts) - counts)),
                        pa.array(np.maximum.reduceat(docs, np.cumsum(counts) - counts)),
                        _column(docs, counts),
                        _column(places, counts),
                    ],
                    [c.split()[0] for c in PHRASE.split(", ")],
                )
            found.clear()

        for b in batches:
            shift = np.uint64(32 - b.column("bits")[0].as_py()) if b.num_rows else np.uint64(0)
            for i, j, texts in text_blocks(b.column("t"), TEXT_BYTES):
                raws = [(t or "").encode() for t in texts]
                ids = b.column("doc_id").slice(i, j - i).to_pylist()
                wanted = np.unique(np.concatenate([
                    np.frombuffer(x, "<u8")
                    for x in b.column("anchors").slice(i, j - i).to_pylist()
                ]))
                for raw, first, size, number, offset in _batches(raws):
                    hash_, part, place, at, end = anchors(raw, first, size)
                    name = hash_ >> shift
                    k = np.searchsorted(wanted, name)
                    hit = np.flatnonzero(wanted[np.minimum(k, len(wanted) - 1)] == name)
                    start, stop, own = at[hit], end[hit] + WINDOW, part[hit]
                    data = raw.tobytes()
                    for x, s, e, r, w, d in zip(
                        signed(hash_[hit]).tolist(),
                        start.tolist(),
                        stop.tolist(),
                        (start - place[hit]).tolist(),
                        (start - first[own] + offset[own]).tolist(),
                        number[own].tolist(),
                        strict=True,
                    ):
                        key = (x, data[s:e])
                        row = found.get(key)
                        if row is None:
                            found[key] = [r, [ids[d]], [w]]
                        else:
                            row[1].append(ids[d])
                            row[2].append(w)
                if len(found) >= TASK_PHRASES:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(cut, PHRASE)


def _sid(xxhash, phrase: bytes) -> int:
    return xxhash.xxh3_64_intdigest(phrase, 7) - (1 << 63)


def windows_of(rows: DataFrame) -> DataFrame:
    """Phrases taken apart into their windows; each window is its own anchor."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for r in b.to_pylist():
                p, places = r["phrase"], np.frombuffer(r["places"], "<i8")
                some = [p[i : i + WINDOW] for i in range(len(p) - WINDOW + 1)]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in some], pa.int64()),
                        pa.array([_sid(xxhash, w) for w in some], pa.int64()),
                        pa.array([0] * n, pa.int32()),
                        pa.array(some, pa.binary()),
                        pa.array([r["doc"]] * n, pa.int64()),
                        pa.array([r["last"]] * n, pa.int64()),
                        pa.array([r["docs"]] * n, pa.binary()),
                        pa.array([(places + i).astype("<i8").tobytes() for i in range(n)], pa.binary()),
                    ],
                    [c.split()[0] for c in PHRASE.split(", ")],
                )

    return rows.mapInArrow(take, PHRASE)


# ---- shard transforms and their merge


def _split(group: np.ndarray, char: np.ndarray) -> np.ndarray:
    """Stable order by (group, character); rows are in the order of their groups."""
    order = np.argsort(char, kind="stable")
    some = group[order]
    if len(group) and int(group[-1]) < 65536:
        some = some.astype(np.uint16)
    return order[np.argsort(some, kind="stable")]


class ShardBwts:
    """Positional Burrows-Wheeler transforms of shards of aligned phrases.

    ``bwt[c]`` holds, shard after shard, the character in column c before each suffix
    that starts in column c + 1, suffixes sorted; ``order[c]`` the phrases sorted by
    their suffixes from column c.
    """

    def __init__(self, chars: np.ndarray, block: np.ndarray, shard: np.ndarray):
        n = len(chars)
        group = shard.astype(np.int64) * (int(block.max(initial=0)) + 1) + block
        order = np.argsort(group, kind="stable")
        _, code = np.unique(group, return_inverse=True)
        self.bwt = np.empty((COLUMNS, n), np.uint8)
        self.order = np.empty((COLUMNS, n), np.int32)
        self.first = order
        for c in range(COLUMNS - 1, -1, -1):
            self.bwt[c] = chars[order, c]
            order = order[_split(code[order], self.bwt[c])]
            self.order[c] = order


def merge(bwts: ShardBwts, block: np.ndarray, shard: np.ndarray) -> Iterator[tuple]:
    """Refine the interleave of the shards column by column, from the right.

    Yields (column, phrases in merged order, common prefix of each with the one before,
    within its block) for the columns where a window can start.
    """
    n = len(block)
    at = np.argsort(block[bwts.first], kind="stable")  # shard rows by block, shard by shard
    row_shard = shard[bwts.first]
    own = block[bwts.first][at]  # blocks of merged rows: the same in every column
    few = int(shard.max(initial=0)) < 65536
    common = np.zeros(n + 1, np.int32)
    for c in range(COLUMNS - 1, -1, -1):
        char = bwts.bwt[c][at]
        order = _split(own, char)
        come, going = order[:-1], order[1:]
        char = char[order]
        same = (char[1:] == char[:-1]) & (own[1:] == own[:-1]) & (char[1:] != _ABSENT)
        new = np.zeros(n + 1, np.int32)
        pairs = np.flatnonzero(same)
        if len(pairs):
            ranges = np.stack([come[pairs] + 1, going[pairs] + 1], 1).ravel()
            new[pairs + 1] = 1 + np.minimum.reduceat(common, ranges)[::2]
        common = new
        # the k-th row of a shard in the new interleave is its k-th suffix
        turn = row_shard[at][order]
        back = np.argsort(turn.astype(np.uint16) if few else turn, kind="stable")
        at = np.empty(n, np.int64)
        at[back] = np.arange(n)
        if c <= SPAN:
            yield c, bwts.order[c][at], common[:n]


def sources(chars: np.ndarray, block: np.ndarray, doc: np.ndarray, shard_size: int) -> np.ndarray:
    """For each phrase and start column the smallest document with the same window
    (a large number where no window starts)."""
    n = len(chars)
    shard = np.arange(n) // shard_size
    out = np.full((n, SPAN + 1), np.iinfo(np.int64).max)
    for c, phrase, common in merge(ShardBwts(chars, block, shard), block, shard):
        start = np.flatnonzero(common < WINDOW)  # repeated intervals
        least = np.minimum.reduceat(doc[phrase], start)
        out[phrase, c] = np.repeat(least, np.diff(start, append=n))
    return out


def _resolve(rows: pa.Table) -> pa.Table:
    """(h, sid, runs): runs of (first start, last start, source) of the phrases that some
    document holds after a run's source."""
    h = rows.column("h").to_numpy()
    rel = rows.column("rel").to_numpy()
    doc = rows.column("doc").to_numpy()
    texts = rows.column("phrase").to_pylist()
    n = len(h)
    size = np.array([len(t) for t in texts])
    chars = np.full((n, COLUMNS), _ABSENT, np.uint8)
    first = np.repeat(np.arange(n) * COLUMNS + rel + SPAN, size)
    inside = np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
    chars.ravel()[first + inside] = np.frombuffer(b"".join(texts), np.uint8)
    _, block = np.unique(h, return_inverse=True)
    source = sources(chars, block, doc, SHARD_PHRASES)
    windows = size - WINDOW + 1
    row = np.repeat(np.arange(n), windows)
    place = _spread(np.zeros(n, np.int64), windows)
    line = source[row, place + np.repeat(rel + SPAN, windows)]
    cut = np.ones(len(line), bool)
    cut[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
    cut = np.flatnonzero(cut)
    last = place[np.append(cut[1:], len(line)) - 1]
    end = rows.column("last").to_numpy()
    gone = line[cut] < end[row[cut]]  # runs that take bytes from some document
    cut, last = cut[gone], last[gone]
    some, counts = np.unique(row[cut], return_counts=True)
    runs = np.stack([place[cut], last, line[cut]], 1).ravel()
    return pa.table({
        "h": h[some], "sid": rows.column("sid").to_numpy()[some], "runs": _column(runs, 3 * counts)
    })


def _ranges_of(rows: DataFrame) -> DataFrame:
    """(doc_id, start, stop) of the bytes that go, from phrases joined to their runs."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, n_docs = _values(b.column("docs"))
            place, _ = _values(b.column("places"))
            run, n_runs = _values(b.column("runs"))
            run = run.reshape(-1, 3)
            # every run with every occurrence of its phrase
            row = np.repeat(np.arange(b.num_rows), n_runs // 3)
            first = (np.cumsum(n_docs) - n_docs)[row]
            which = np.repeat(np.arange(len(row)), n_docs[row])
            at = _spread(first, n_docs[row])
            later = doc[at] > run[which, 2]
            at, which = at[later], which[later]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[at]),
                    pa.array(place[at] + run[which, 0]),
                    pa.array(place[at] + run[which, 1] + WINDOW),
                ],
                ["doc_id", "start", "stop"],
            )

    return rows.select("docs", "places", "runs").mapInArrow(
        spread, "doc_id bigint, start bigint, stop bigint"
    )


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _removed(rows: DataFrame) -> DataFrame:
    """Results of documents from (doc_id, t, ranges)."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for i, t, ranges in zip(
                b.column("doc_id"), b.column("t"), b.column("ranges"), strict=True
            ):
                raw = (t.as_py() or "").encode()
                edge = np.zeros(len(raw) + 1, np.int32)
                flat = ranges.values
                np.add.at(edge, flat.field("start").to_numpy(), 1)
                np.add.at(edge, flat.field("stop").to_numpy(), -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out[0].append(i.as_py())
                out[1].append(len(raw))
                out[2].append(len(raw) - len(kept))
                out[3].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                out[4].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in out[:4]] + [pa.array(out[4], pa.string())],
                [c.split()[0] for c in RESULT.split(", ")],
            )

    return rows.mapInArrow(strip, RESULT)


def _distinct(cut: DataFrame) -> DataFrame:
    """Different phrases with the smallest and the largest document that hold them."""
    return cut.groupBy("h", "sid", "rel", "phrase").agg(
        F.min("doc").alias("doc"), F.max("last").alias("last")
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    found = materialize(survey(docs, doc_id, text), "anchors")
    rows = found.where("digest IS NOT NULL").select("doc_id", "a", "n_bytes", "digest")
    first = materialize(
        rows.where("doc_id IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("a").alias("a")
        ),
        "first-copies",
    )
    shared = (
        found.where("digest IS NULL")
        .select(F.col("a").alias("slot"), "n_bytes", "n", "anchors", "bits")
        .groupBy("slot")
        .applyInArrow(_anchors_of, "a bigint, anchors binary, bits int")  # the text's own anchors
        .join(first.select("a", F.col("rep").alias("doc_id")), "a")
        .select("doc_id", "anchors", "bits")
    )
    shared = materialize(shared, "shared-anchors")
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).where(
        "doc_id IS NOT NULL"
    )
    near = only_ids(whole, "doc_id", shared, "doc_id").join(shared, "doc_id")
    cut = materialize(phrases(near), "phrases")
    distinct = materialize(_distinct(cut), "distinct-phrases")
    many = materialize(
        distinct.groupBy("h").count().where(F.col("count") > MANY_PHRASES).select("h"), "many"
    )
    if many.limit(1).count():
        apart = windows_of(cut.join(many, "h", "left_semi"))
        cut = materialize(cut.join(many, "h", "left_anti").unionByName(apart), "phrases")
        distinct = materialize(_distinct(cut), "distinct-phrases")
    n = max(1, -(-distinct.count() // BUCKET_PHRASES))
    runs = (
        distinct.withColumn("bucket", F.pmod("h", F.lit(n)))
        .groupBy("bucket")
        .applyInArrow(_resolve, "h bigint, sid bigint, runs binary")
    )
    runs = materialize(runs, "runs")
    held = only_ids(cut.select("h", "sid", "docs", "places"), "sid", runs, "sid")
    ranges = _ranges_of(held.join(runs, ["h", "sid"]))
    per_doc = ranges.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges")  # the document's own ranges
    )
    per_doc = materialize(per_doc, "ranges")
    unclear = rows.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
    per_doc = per_doc.join(unclear.where("x <> y").select("doc_id"), "doc_id", "left_anti")
    losing = only_ids(whole, "doc_id", per_doc, "doc_id").join(per_doc, "doc_id")
    losing = _removed(losing).dropDuplicates(["doc_id"])  # repeated rows are equal here
    # copies of smaller ids go whole, others lose their ranges
    copies = rows.join(first.select("digest", "rep"), "digest", "left")
    is_copy = F.col("doc_id").isNotNull() & (F.col("doc_id") > F.col("rep"))
    is_copy = F.coalesce(is_copy, F.lit(False)) & (F.col("n_bytes") >= WINDOW)
    changed = losing.select(
        "doc_id", *[F.col(c).alias(f"x_{c}") for c in ("n_removed", "n_spans", "kept_sha256")]
    )
    out = copies.join(changed, "doc_id", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(is_copy, F.col("n_bytes")).otherwise(F.coalesce("x_n_removed", F.lit(0))).alias("n_removed"),
        F.when(is_copy, F.lit(1)).otherwise(F.coalesce("x_n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(is_copy, F.lit(empty))
        .otherwise(F.coalesce("x_kept_sha256", F.lower(F.hex("digest"))))
        .alias("kept_sha256"),
    )


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat passages of documents with smaller ids."""
    return remove_repeats(table(spark, sf_dir, "documents"))
