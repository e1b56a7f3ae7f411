"""Exact n-gram Jaccard join by universe-partition pigeonhole.

A document's set holds its distinct 5-word shingles, as 64-bit hashes. Sets link when
their Jaccard similarity is at least SIMILARITY (in whole numbers: PERCENT).

1. Budget. Sets a <= b that link differ in at most floor((a + b) / 7) shingles, so at
   least three quarters of each set's shingles occur in another set. All shingles are
   dealt to buckets by hash, sorted inside tasks, and counted per set; a set with more
   shingles that no other set has cannot link and goes no further. The exchange keeps the
   leading bits of a hash, so what is counted are a set's distinct leading bits: those
   that no other set has stand for at least as many shingles of its own, and no set that
   links is dropped. Equal sets are one set from here on.
2. Universe partition. Sizes fall into bands (a partner is in the same or the next
   band); each band fixes its error budget H and m segments of the hash space. Every set
   signs the segments of its own and of the previous band's scheme: a segment with
   allowance 0 by its subset, one with allowance 1 also by its one-deletion
   neighbourhood. Allowances cover the budget (sum of allowance + 1 > H), and a cost
   model (signatures + expected chance agreements) picks m and the number of segments
   with allowance 1. A set whose empty or single-shingle segments leave the budget
   uncovered also signs the shingles of its prefix, so that two such sets still meet.
3. Verification. Sets under one signature are candidates. Each is compared first with the
   smallest set it shares most signatures with; verified links make components. Only
   pairs under one signature whose components still differ remain, so a group of thousands
   of near copies costs a comparison per copy, not per pair. Of those, a sketch of each set
   (the parity of its shingles in cells of the hash space) rules out the pairs that differ
   in more shingles than linked sets do; only the others leave the task and are compared. All
   comparisons are exact on the shingle sets, nothing is sampled or capped. A signature with
   over GROUP_SETS sets is dealt to tasks by pairs of blocks of its sets.

Signatures travel as packed arrays (4 bytes of hash and a set number), rows carry no
texts; a text is read again only for the sets that passed step 1, found through a
bitmap filter of fixed size and then joined exactly.

Defined results: null or blank text is the empty set, linked with nothing. Fewer than
five words are one shingle. Copies and repeated rows share a component. A null doc_id
gets no component. Extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import blocks, from_planes, give_back, materialize, planes, table
from basketry.llm.common import text_blocks, text_bytes, tidied
from basketry.llm.exchange import PACKED, dealt, id_filter, only_ids, packed, signed, slot_count
from basketry.llm.exchange import spot, unpacked, unpacked_bits, without_ids
from basketry.llm.graph import components

WORDS = 5
PERCENT = 75
BUCKET_VALUES = 2_000_000  # shingles or signatures of a bucket
TASK_VALUES = 1_500_000  # values a task holds before it sends them
BLOCK_BYTES = 1_000_000
COMPARISON = 60  # cost of a needless comparison, in signatures
GROUP_SETS = 2048  # sets of a signature whose pairs one bucket looks at
BLOCK_SETS = 8192  # sets of a block, for a signature with more
PAIRS_AT_ONCE = 1_000_000  # pairs whose sketches are compared together
SKETCH_BITS = 512, 8192  # least and most bits of a sketch
PAIR_ROWS = 256  # pairs of sets in one Arrow batch: a set may be large
KNOWN_WORDS = 300_000  # word hashes a task remembers
_UPPER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# ---- shingles


class Shingler:
    """Shingle sets of texts; remembers word hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct shingle hashes of every text, one after the other; sizes)."""
        import xxhash

        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known, hashed = self.known, xxhash.xxh3_64_intdigest
        words = [(t or "").encode().translate(_UPPER).split() for t in texts]
        flat = [w for ws in words for w in ws]
        for w in set(flat).difference(known):
            known[w] = hashed(w)
        code = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
        n = np.fromiter((len(ws) for ws in words), np.int64, len(words))
        start = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(n)), n)
        left = n[owner] - (np.arange(len(code)) - start[owner])  # words from here to the end
        value = np.zeros(len(code), np.uint64)
        for j in range(min(WORDS, len(code))):
            value[: len(code) - j] = value[: len(code) - j] * _STEP + _mix(code[j:] + np.uint64(j))
        whole = left >= WORDS
        # a short text is one shingle of all its words
        for short in np.flatnonzero((n > 0) & (n < WORDS)).tolist():
            v = np.uint64(n[short])
            with np.errstate(over="ignore"):
                for c in code[start[short] : start[short] + n[short]]:
                    v = v * _STEP + _mix(np.array([c]))[0]
            value[start[short]], whole[start[short]] = v, True
        value, owner = _mix(value[whole]), owner[whole]
        order = np.argsort(value)
        order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")] if len(
            n
        ) < 65536 else order[np.argsort(owner[order], kind="stable")]
        value, owner = value[order], owner[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        return value[fresh], np.bincount(owner[fresh], minlength=len(n))


def set_ids(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (0 for the empty set)."""
    import xxhash

    ends = np.cumsum(sizes).tolist()
    raw, out, at = memoryview(values).cast("B"), [], 0
    for e in ends:
        out.append(xxhash.xxh3_64_intdigest(raw[8 * at : 8 * e]) if e > at else 0)
        at = e
    return np.array(out, np.uint64)


def leading_counts(values: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """Distinct values of every set among the leading ``32 + bits`` bits that the exchange
    keeps (the values of a set are sorted)."""
    lead = values >> np.uint64(32 - bits)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    fresh = np.ones(len(lead), bool)
    fresh[1:] = (lead[1:] != lead[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[fresh], minlength=len(sizes))


# of n shingles with ``lead`` distinct leading bits, ``shared`` of those in other sets too:
# at least lead - shared shingles are the set's own
MAY_LINK = f"100 * (n - lead + coalesce(shared, 0)) >= {PERCENT} * n"


def _shared_counts(rows: pa.Table) -> pa.Table:
    """Per set, how many of a bucket's leading bits some other set has too."""
    value, owner, names = unpacked(rows)
    twin = np.zeros(len(value) + 1, bool)
    twin[1:-1] = value[1:] == value[:-1]
    n = np.bincount(owner[twin[:-1] | twin[1:]], minlength=len(names))
    some = np.flatnonzero(n)
    return pa.table({"a": signed(names[some]), "n": n[some]})


def _by_slot(counts: pa.Table, slots: int) -> pa.Table:
    """The numbers of a bucket's sets as a row per slot of their names, packed."""
    names, n = counts["a"].to_numpy().astype("<i8"), counts["n"].to_numpy()
    parts = list(dealt(names.view("<u8"), slots))
    return pa.table({
        "a": pa.array([slot for slot, _ in parts], pa.int64()),
        "n": pa.array([len(at) for _, at in parts], pa.int64()),
        "lead": pa.nulls(len(parts), pa.int64()),
        "doc_id": pa.nulls(len(parts), pa.int64()),
        "shared": pa.array([names[at].tobytes() + planes(n[at]) for _, at in parts], pa.binary()),
    })


def _shared_totals(rows: pa.Table) -> pa.Table:
    """(a, shared): the numbers of a slot's sets, summed over the buckets."""
    names, counts = [], []
    for n, raw in zip(rows.column("n").to_pylist(), rows.column("shared").to_pylist(), strict=True):
        names.append(np.frombuffer(raw, "<i8", n))
        counts.append(from_planes(raw[8 * n :]))
    known, at = np.unique(np.concatenate(names), return_inverse=True)
    total = np.bincount(at, np.concatenate(counts)).astype(np.int64)
    return pa.table({"a": known, "shared": total})


def _document_rows(rows: pa.Table) -> pa.Table:
    out = []
    for r in rows.to_pylist():
        ids = np.frombuffer(r["low"], "<i8")
        null = np.frombuffer(r["owner"], "?")
        both = np.frombuffer(r["owners"], "<i8").reshape(3, -1)
        out.append(pa.table({
            "a": both[0], "n": both[1], "lead": both[2],
            "doc_id": pa.array(ids, pa.int64(), mask=null), "shared": pa.nulls(len(ids), pa.binary()),
        }))
    return pa.concat_tables(out)


def survey(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(a, n, lead, doc_id) for every row, marked by ``kind`` 1: its set's name, size and
    number of distinct leading bits. With ``kind`` 0, for every bucket and slot ``a``: how many
    of those leading bits the slot's sets share with others (packed in ``shared``, for
    ``_shared_totals``).
    """
    total = max(1, text_bytes(docs, text))
    slots = slot_count(total)
    bits = max(0, math.ceil(math.log2(max(1, total / 6 / BUCKET_VALUES))))
    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        values, sizes, names, seen = [], [], [], set()
        held = flushed = 0

        def flush() -> pa.RecordBatch:
            n = np.concatenate(sizes)
            return packed(
                np.concatenate(values), np.repeat(np.arange(len(n)), n), np.concatenate(names), bits
            )

        for b in batches:
            for i, j, texts in text_blocks(b.column("t"), BLOCK_BYTES):
                value, size = shingler.sets(texts)
                name, lead = set_ids(value, size), leading_counts(value, size, bits)
                ids = b.column("i").slice(i, j - i)
                null = np.array(ids.is_null())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([-1 - (int(name[0]) >> 1)], pa.int64()),  # any task
                        pa.array([ids.fill_null(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                        pa.array([null.tobytes()], pa.binary()),
                        pa.array([np.stack([signed(name), size, lead]).astype("<i8").tobytes()], pa.binary()),
                    ],
                    ["bucket", "low", "owner", "owners"],
                )
                # equal sets of a task are sent once
                new = np.array([x not in seen and not seen.add(x) for x in name.tolist()])
                new &= size > 0
                values.append(value[np.repeat(new, size)])
                sizes.append(size[new])
                names.append(name[new])
                held += int(size[new].sum())
                if held >= TASK_VALUES:
                    yield flush()
                    values, sizes, names, seen, held = [], [], [], set(), 0
                    flushed += 1
        if held:
            yield flush()

    def receive(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        kind = int(key[0].as_py() < 0)
        made = _document_rows(rows) if kind else _by_slot(_shared_counts(rows), slots)
        if not kind:
            give_back()
        return made.append_column("kind", pa.array(np.full(len(made), kind, np.int32)))

    sent = rows.mapInArrow(tidied(send), PACKED)
    return sent.groupBy("bucket").applyInArrow(
        receive, "a bigint, n bigint, lead bigint, doc_id bigint, shared binary, kind int"
    )


# ---- signatures


def _bands(most: int = 1 << 40) -> list[int]:
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * 100 // PERCENT + 1)
    return out


# first size of each band: partners are in the same or the next band
BANDS = _bands()


def budget(a: int, b: int) -> int:
    """Most shingles in which linked sets of sizes a and b differ."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def _scheme(band: int) -> tuple[int, int, int]:
    """(budget H, segments m, how many of them allow one error) for pairs whose smaller
    set is in the band, by least cost."""
    first, most = BANDS[band], BANDS[band + 1] - 1
    h = budget(most, most * 100 // PERCENT)
    need = math.ceil(1.05 * (h + 1)) + 1  # some slack for empty segments
    best = None
    for m in sorted({max(1, math.ceil(need * f / 40)) for f in range(20, 41)}):
        ones = max(0, need - m)
        if ones > m:
            continue
        per = first / m
        # signatures, and the comparisons that segments of common shingles only lead to;
        # a comparison moves two whole sets, so it weighs as much as many signatures
        cost = m + ones * per + first * COMPARISON * math.exp(-0.8 * per)
        if best is None or cost < best[0]:
            best = (cost, m, ones)
    return h, best[1], best[2]


SCHEMES = [_scheme(band) for band in range(len(BANDS) - 1)]


def signatures(values: np.ndarray) -> np.ndarray:
    """All signatures of one set (sorted distinct hashes)."""
    n = len(values)
    band = bisect_right(BANDS, n) - 1
    mixed = _mix(values ^ _M2)
    out, covered = [], True
    for k in (band - 1, band):
        if k < 0:
            continue
        h, m, ones = SCHEMES[k]
        if h == 0:
            continue  # only equal sets link
        segment = ((values >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        start = np.flatnonzero(np.diff(segment, prepend=-1))
        size = np.diff(start, append=n)
        which = segment[start]
        total = np.add.reduceat(mixed, start)
        salt = _mix(np.uint64(k * 1_000_003) + which.astype(np.uint64) * _STEP)
        out.append(_mix(total ^ salt))
        wide = (which < ones) & (size >= 2)
        member = np.repeat(wide, size)
        place = np.repeat(np.arange(len(start)), size)[member]
        out.append(_mix((total[place] - mixed[member]) ^ salt[place]))
        covered &= len(start) + int(wide.sum()) > h
    if not covered:
        prefix = values[: n - -(-n * PERCENT // 100) + 1]
        out.append(_mix(prefix ^ _M1))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _group_starts(value: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(value.astype(np.int64), prepend=-1))


def _stars(rows: pa.Table) -> pa.Table:
    """(a, b, n): the smallest set under a signature with every other set under it."""
    value, owner, names = unpacked(rows)
    start = _group_starts(value)
    center = np.repeat(owner[start], np.diff(start, append=len(value)))
    rest = owner != center
    pair, n = np.unique(center[rest] * (1 << 32) + owner[rest], return_counts=True)
    del value, owner, start, center, rest
    give_back()
    real = signed(names)
    return pa.table({"a": real[pair >> 32], "b": real[pair & 0xFFFFFFFF], "n": n})


def sketch(values: np.ndarray) -> np.ndarray:
    """A bit per cell of the hash space: whether the set has an odd number of its shingles
    there. Sets differ in at least as many shingles as their sketches differ in bits. There
    are as many cells as shingles, or up to twice as many; the halves of a sketch, one XOR the other, are the
    sketch of half as many cells."""
    least, most = SKETCH_BITS
    cells = min(most, max(least, 1 << (len(values) - 1).bit_length()))
    odd = np.bincount((values & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def _sign(sets: DataFrame, bits: int) -> DataFrame:
    """Packed signatures of (rep, shingles) rows."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, names, held = [], [], 0

        def flush() -> pa.RecordBatch:
            n = np.array([len(v) for v in values])
            return packed(
                np.concatenate(values), np.repeat(np.arange(len(n)), n),
                np.array(names, np.int64).view(np.uint64), bits,
            )

        for b in batches:
            for rep, raw in zip(b.column("rep").to_pylist(), b.column("shingles"), strict=True):
                made = signatures(np.frombuffer(raw.as_py(), "<u8"))
                if len(made):
                    values.append(made)
                    names.append(rep)
                    held += len(made)
                if held >= TASK_VALUES:
                    yield flush()
                    values, names, held = [], [], 0
        if held:
            yield flush()

    return sets.select("rep", "shingles").mapInArrow(tidied(send), PACKED)


def _sign_described(sets: DataFrame, bits: int) -> DataFrame:
    """Packed signatures of (a, rep, label, shingles) rows under the sets' names; ``about``
    has each owner's rep, label, size and length of sketch, then the sketches."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, about, sketches, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            n = np.array([len(v) for v in values])
            each = np.array(about, "<i8")
            number = {name: i for i, name in enumerate(each[:, 0].tolist())}
            rows = packed(
                np.concatenate(values), np.repeat(np.arange(len(n)), n),
                each[:, 0].astype(np.int64).view(np.uint64), bits,
            )
            told = []
            for raw in rows.column("owners").to_pylist():
                at = [number[name] for name in np.frombuffer(raw, "<i8").tolist()]
                told.append(each[at, 1:].tobytes() + b"".join([sketches[i] for i in at]))
            return rows.append_column("about", pa.array(told, pa.binary()))

        for b in batches:
            shingles = (np.frombuffer(x.as_py(), "<u8") for x in b.column("shingles"))
            ends = (b.column(c).to_pylist() for c in ("a", "rep", "label"))
            for a, rep, label, value in zip(*ends, shingles, strict=True):
                made = signatures(value)
                if len(made):
                    drawn = sketch(value)
                    values.append(made)
                    about.append((a, rep, label, len(value), len(drawn)))
                    sketches.append(drawn.tobytes())
                    held += len(made)
                if held >= TASK_VALUES:
                    yield flush()
                    values, about, sketches, held = [], [], [], 0
        if held:
            yield flush()

    return sets.select("a", "rep", "label", "shingles").mapInArrow(
        tidied(send), PACKED + ", about binary"
    )


class _Described:
    """Sets with their reps, labels, sizes and sketches (one after the other in ``flat``)."""

    def __init__(self, rep, label, n, length, flat):
        self.rep, self.label, self.n, self.length, self.flat = rep, label, n, length, flat
        self.start = np.cumsum(length) - length
        self.drawn: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, rows: pa.Table) -> _Described:
        """The owners of a bucket, ordered by name."""
        names, about, flat = [], [], []
        for r in rows.select(["owners", "about"]).to_pylist():
            names.append(np.frombuffer(r["owners"], "<u8"))
            k = len(names[-1])
            about.append(np.frombuffer(r["about"], "<i8", 4 * k).reshape(k, 4))
            flat.append(np.frombuffer(r["about"], "<u8", offset=32 * k))
        every = cls(*np.concatenate(about).T, np.concatenate(flat))
        first = np.unique(np.concatenate(names), return_index=True)[1]
        kept = cls(every.rep[first], every.label[first], every.n[first], every.length[first], every.flat)
        kept.start = every.start[first]
        return kept

    def sketch_of(self, i: int) -> bytes:
        return self.flat[self.start[i] : self.start[i] + self.length[i]].tobytes()

    def _folded(self, some: np.ndarray, length: int) -> np.ndarray:
        """Sketches of ``length`` numbers of sets with that length or twice it."""
        place = self.start[some][:, None] + np.arange(length)
        out = self.flat[place]
        twice = self.length[some] > length
        out[twice] ^= self.flat[place[twice] + length]
        return out

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs (a, b) fit in size and differ in no more shingles, as far as
        their sketches tell, than linked sets do."""
        low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
        keep = 100 * low >= PERCENT * high
        length = np.minimum(self.length[a], self.length[b])
        for k in np.unique(length[keep]).tolist():
            same, most = np.flatnonzero(keep & (length == k)), max(1, 2 * PAIRS_AT_ONCE // k)
            for i in range(0, len(same), most):
                at = same[i : i + most]
                odd = np.bitwise_count(self._folded(a[at], k) ^ self._folded(b[at], k)).sum(1, np.int64)
                keep[at] = odd * (100 + PERCENT) <= (low[at] + high[at]) * (100 - PERCENT)
        return keep

    def pairs(self, owner: np.ndarray, begin: np.ndarray, count: np.ndarray) -> pa.Table:
        """(a, b), as reps, of the pairs that may link and have different labels, among those
        of every member with the ``count`` members from place ``begin`` on."""
        found = [np.zeros(0, np.int64)]
        for i, j in blocks(count.tolist(), PAIRS_AT_ONCE):
            n = count[i:j]
            left = np.repeat(owner[i:j], n)
            right = owner[np.repeat(begin[i:j] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            across = self.label[left] != self.label[right]
            left, right = left[across], right[across]
            pair = np.unique(np.minimum(left, right) << 32 | np.maximum(left, right))
            found.append(pair[self.may_link(pair >> 32, pair & 0xFFFFFFFF)])
        pair = np.unique(np.concatenate(found))
        ends = self.rep[pair >> 32], self.rep[pair & 0xFFFFFFFF]
        return pa.table({"a": np.minimum(*ends), "b": np.maximum(*ends)})


def _verify(pairs: DataFrame, sets: DataFrame, few: bool = True) -> DataFrame:
    """The pairs (a, b) whose sets link, compared exactly; with ``few`` most sets are
    expected to be in no pair and are left out before the join."""
    if few:
        pairs = materialize(pairs.select("a", "b"), "pairs", tidy=True)
        ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
        sets = only_ids(sets.select("rep", "shingles"), "rep", ends, "rep")
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"]
            )

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return materialize(joined.mapInArrow(compare, "a bigint, b bigint"), "links", PAIR_ROWS, tidy=True)


def _fitting(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sizes allow a link."""
    for end in ("a", "b"):
        size = sets.groupBy(F.col("rep").alias(end)).agg(
            F.min("n").alias(f"lo_{end}"), F.max("n").alias(f"hi_{end}")
        )
        pairs = pairs.join(size, end)
    fits = (100 * F.col("hi_a") >= PERCENT * F.col("lo_b")) & (
        100 * F.col("hi_b") >= PERCENT * F.col("lo_a")
    )
    return pairs.where(fits).drop("lo_a", "hi_a", "lo_b", "hi_b")


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the components la, lb of their ends (a set without links is its own)."""
    for end in ("a", "b"):
        name = labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
        pairs = pairs.join(name, end, "left").withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    return pairs


_WIDE = "a bigint, b bigint, g bigint, block int, blocks int, label bigint, n bigint, sketch binary"


def _wide_members(sets: _Described, owner: np.ndarray, start: np.ndarray, size: np.ndarray,
                  bucket: int) -> pa.Table:
    """The members of the groups (their sets come from ``start`` on), dealt to blocks."""
    out = []
    for i, m in zip(start.tolist(), size.tolist(), strict=True):
        some, parts = owner[i : i + m], -(-m // BLOCK_SETS)
        out.append(pa.table({
            "a": sets.rep[some],
            "b": pa.nulls(m, pa.int64()),
            "g": np.full(m, (bucket << 32) + i),
            "block": (np.arange(m) % parts).astype(np.int32),
            "blocks": np.full(m, parts, np.int32),
            "label": sets.label[some],
            "n": sets.n[some],
            "sketch": pa.array([sets.sketch_of(x) for x in some.tolist()], pa.binary()),
        }))
    return pa.concat_tables(out)


def _block_pairs(rows: pa.Table) -> pa.Table:
    """The pairs that may link within one block, or between two blocks, of a wide group."""
    rows = rows.sort_by("block")
    drawn = rows["sketch"].to_pylist()
    sets = _Described(
        *(rows[c].to_numpy() for c in ("a", "label", "n")),
        np.array([len(x) // 8 for x in drawn]), np.frombuffer(b"".join(drawn), "<u8"),
    )
    block, every = rows["block"].to_numpy(), np.arange(len(rows))
    first = int((block == block[0]).sum())
    if first == len(rows):
        return sets.pairs(every, every + 1, len(rows) - 1 - every)
    count = np.where(every < first, len(rows) - first, 0)
    return sets.pairs(every, np.full(len(rows), first), count)


def _across_pairs(sets: DataFrame, bits: int) -> DataFrame:
    """All pairs (a, b) of (a, rep, label, shingles) rows that are under one signature, have
    different labels, and may link by their sizes and sketches."""

    def groups(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        value, owner, _ = unpacked(rows)
        known = _Described.of(rows)
        start = _group_starts(value)
        size = np.diff(start, append=len(value))
        label = known.label[owner]
        mixed = np.minimum.reduceat(label, start) != np.maximum.reduceat(label, start)
        wide = mixed & (size > GROUP_SETS)
        end = np.repeat(start + size, size)
        place = np.arange(len(owner))
        count = np.where(np.repeat(mixed & ~wide, size), end - 1 - place, 0)
        out = known.pairs(owner, place + 1, count)
        for name, kind in (x.split() for x in _WIDE.split(", ")[2:]):
            out = out.append_column(name, pa.nulls(len(out), kinds[kind]))
        if wide.any():
            bucket = key[0].as_py()
            out = pa.concat_tables([out, _wide_members(known, owner, start[wide], size[wide], bucket)])
        del value, owner, known, label, end, place, count
        give_back()
        return out

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    found = _sign_described(sets, bits).groupBy("bucket").applyInArrow(groups, _WIDE)
    found = materialize(found, "across", tidy=True)
    pairs, wide = found.where("b IS NOT NULL").select("a", "b"), found.where("b IS NULL")
    if wide.limit(1).count():
        # each block meets itself and every other block of its group
        other = wide.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = other.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        more = met.groupBy("g", "i", "j").applyInArrow(_block_pairs, "a bigint, b bigint")
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _sets_of(docs: DataFrame, reps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rep, n, shingles) of the sets in ``reps`` (rep, a)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("t")).where(
        "rep IS NOT NULL"
    ).withColumn("spot", spot("rep"))
    bitmap = id_filter(reps, "rep")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # most rows go here already (in one Python process with what follows), the rest in
        # the join
        shingler, bits = Shingler(), unpacked_bits(bitmap)
        for b in batches:
            b = b.filter(pa.array(bits[b.column("spot").to_numpy()]))
            for i, j, texts in text_blocks(b.column("t"), BLOCK_BYTES):
                value, size = shingler.sets(texts)
                raw, at, out = value.astype("<u8").tobytes(), 0, []
                for n in size.tolist():
                    out.append(raw[8 * at : 8 * (at + n)])
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [b.column("rep").slice(i, j - i), pa.array(signed(set_ids(value, size))),
                     pa.array(size.astype(np.int64)), pa.array(out, pa.binary())],
                    ["rep", "a", "n", "shingles"],
                )

    made = rows.mapInArrow(tidied(read), "rep bigint, a bigint, n bigint, shingles binary")
    # an id may be repeated with other texts: its sets are then one node with all links
    return made.join(reps, ["rep", "a"], "left_semi").dropDuplicates(["rep", "a"])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row (see the module text)."""
    found = materialize(survey(docs, doc_id, text), "shingles", tidy=True)
    rows = found.where("kind = 1").select("doc_id", "a", "n", "lead")
    shared = (
        found.where("kind = 0").select(F.col("a").alias("slot"), "n", "shared")
        .groupBy("slot").applyInArrow(_shared_totals, "a bigint, shared bigint")
    )
    named = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("a").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("lead").alias("lead")
    )
    named = materialize(named, "sets", tidy=True)
    reps = named.join(shared, "a", "left").where(MAY_LINK).select("rep", "a")
    reps = materialize(reps, "candidates", tidy=True)
    sets = materialize(_sets_of(docs, reps, doc_id, text), "candidate-sets", tidy=True)
    total = sets.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = max(0, math.ceil(math.log2(max(1, 2.5 * total / BUCKET_VALUES))))
    stars = (
        _sign(sets, bits)
        .groupBy("bucket")
        .applyInArrow(_stars, "a bigint, b bigint, n bigint")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )
    stars = materialize(stars, "stars", tidy=True)
    near = materialize(_fitting(stars, sets), "near-stars", tidy=True)
    # first each set with the one it shares most signatures with
    first = near.groupBy("b").agg(
        F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("m")
    ).select((-F.col("m.a")).alias("a"), "b")
    links = _verify(first, sets, few=False)
    labels = components(links)
    # then the other stars that still lead from one component to another
    rest = _labelled(near.select("a", "b"), labels).where("la <> lb")
    more = _verify(rest.join(first, ["a", "b"], "left_anti"), sets)
    links = materialize(links.unionByName(more), "links", tidy=True)
    labels = components(links)
    # a signature whose star is in one component has no pair left; of the others, all
    # pairs that lead across components are compared
    open_ = materialize(_labelled(stars.select("a", "b"), labels).where("la <> lb"), "open", tidy=True)
    if open_.limit(1).count():
        touched = open_.select(F.col("la").alias("label")).union(open_.select("lb")).distinct()
        own = sets.join(labels, sets["rep"] == labels["node"], "left").withColumn(
            "label", F.coalesce("label", "rep")
        )
        some = own.join(touched, "label", "left_semi").select("a", "rep", "n", "shingles", "label")
        some = materialize(some, "open-sets", tidy=True)
        pairs = _across_pairs(some, bits).join(stars.select("a", "b"), ["a", "b"], "left_anti")
        labels = components(links.unionByName(_verify(pairs, some)))
    final = named.join(labels, named["rep"] == labels["node"], "left").select(
        "a", F.coalesce("label", "rep").alias("component_id")
    )
    linked = rows.join(final, "a", "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return linked.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (of rows
    that repeat that id, one). Empty texts and null ids have no component and stay."""
    found = materialize(near_duplicates(docs, doc_id, text), "components", tidy=True)
    gone = found.where("component_id <> doc_id").select("doc_id")
    again = (
        found.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id")
    )
    kept = without_ids(docs, doc_id, materialize(gone.union(again), "gone", tidy=True), "doc_id")
    single = docs.join(again.withColumnRenamed("doc_id", doc_id), doc_id, "left_semi")
    if again.limit(1).count():
        first = single.join(gone.withColumnRenamed("doc_id", doc_id), doc_id, "left_anti")
        kept = kept.unionByName(first.dropDuplicates([doc_id]).select(docs.columns))
    return kept


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
