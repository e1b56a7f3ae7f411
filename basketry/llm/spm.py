"""Subword encoding and decoding with a given piece vocabulary.

Encoding works on batches: a text is cut at its spaces (no piece runs over a space), the
distinct units of a batch that are new to the task are concatenated and matched against
the vocabulary through a suffix array (see ``lattice``), and the edges, sorted by
position, are relaxed:

* a merge vocabulary (BPE) is relaxed in merge order: in each round every unit applies
  its best-scored edge that joins two neighbouring symbols, leftmost first;
* a unigram vocabulary is relaxed left to right to the best-scored path.

Both give exactly the ids of the vocabulary's own library. Characters without a piece
become byte pieces. Decoding turns ids back into bytes and drops the prefix space.

Plan: one narrow pass; no shuffle. Units over LONG characters are merged with a heap,
so a text without spaces costs n log n. Units are remembered per task up to a bound.

Defined results: null text = empty text = no ids, decoded to the empty text. The
visible space character is a space to the vocabulary, so a text that holds it does not
come back unchanged (``round_trip`` is false). Repeated rows repeat; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import blocks, table, text_blocks, tidied
from basketry.llm.lattice import DEFAULT_MODEL, SPACE, Matcher, Vocabulary, code_points
from basketry.llm.lattice import load_vocabulary

LONG = 64
BLOCK_CHARS = 400_000  # characters that are indexed at once
DOC_CHARS = 500_000  # characters of documents that are put together at once
REMEMBERED = 600_000  # units
_NONE = np.int64(1) << 40

_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_UNITS_LINES = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


class Encoder:
    """Encodes units (strings without inner spaces) to ids, a block at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.matcher = Matcher(vocabulary)
        # 0 is the best score; equal scores are equal
        self.priority = np.unique(-vocabulary.scores, return_inverse=True)[1].astype(np.int64)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units one after the other, number of ids of each unit)."""
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i, j in blocks([len(u) + 1 for u in units], BLOCK_CHARS):
            a, b = self._block(units[i:j])
            ids.append(a)
            counts.append(b)
        return np.concatenate(ids), np.concatenate(counts)

    def _block(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = code_points("\0".join(units) + "\0")
        sizes = np.fromiter((len(u) for u in units), np.int64, len(units))
        # a NUL inside a unit is a character without a piece: it separates as well
        offsets = np.cumsum(sizes + 1) - sizes - 1
        edge = self.matcher.sorted_edges(text)
        relax = self._merge if self.v.bpe else self._best_path
        unit, first, last, found = relax(edge, offsets, sizes)
        return self._ids(text, unit, first, last, found, len(units))

    def _ids(self, text, unit, first, last, found, n) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments; a segment without a piece is spelled in byte pieces."""
        out = np.ones(len(found), np.int64)
        spelled = {}
        for i in np.flatnonzero(found < 0).tolist():
            raw = text[first[i] : last[i]].astype("<u4").tobytes().decode("utf-32-le")
            ids = [self.v.unknown]
            if self.v.byte_ids is not None:
                ids = [int(self.v.byte_ids[b]) for b in raw.encode()]
            spelled[i] = ids
            out[i] = len(ids)
        at = np.cumsum(out) - out
        ids = np.zeros(int(out.sum()), np.int32)
        plain = found >= 0
        ids[at[plain]] = found[plain]
        for i, more in spelled.items():
            ids[at[i] : at[i] + len(more)] = more
        return ids, np.bincount(unit, out, minlength=n).astype(np.int64)

    # ---- merge vocabularies

    def _merge(self, edge, offsets, sizes):
        short = np.flatnonzero((sizes <= LONG) & (sizes > 0))
        done = []
        unit = np.repeat(short, sizes[short])
        first = _ranges(offsets[short], sizes[short])
        last = first + 1
        if len(unit):
            key = self._pair_keys(edge, unit, first, last)
        while len(unit):
            heads = np.flatnonzero(np.diff(unit, prepend=-1))
            order = np.arange(len(unit))
            best = np.minimum.reduceat((key << 22) | order, heads)
            joins = best < (_NONE << 22)
            if not joins.all():  # units without an edge between neighbours are finished
                stay = np.repeat(joins, np.diff(heads, append=len(unit)))
                done.append((unit[~stay], first[~stay], last[~stay]))
                moved = np.cumsum(stay) - 1
                at = moved[best[joins] & ((1 << 22) - 1)]
                unit, first, last, key = unit[stay], first[stay], last[stay], key[stay]
            else:
                at = best & ((1 << 22) - 1)
            if not len(unit):
                break
            last[at] = last[at + 1]
            keep = np.ones(len(unit), bool)
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            unit, first, last, key = unit[keep], first[keep], last[keep], key[keep]
            for changed in (at, at[at > 0] - 1):
                key[changed] = self._pair_keys(edge, unit, first, last, changed)
        for u in np.flatnonzero(sizes > LONG).tolist():
            a, b = self._merge_long(edge, int(offsets[u]), int(sizes[u]))
            done.append((np.full(len(a), u), a, b))
        if not done:
            z = np.zeros(0, np.int64)
            return z, z, z, z
        unit, first, last = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(first, kind="stable")
        unit, first, last = unit[order], first[order], last[order]
        return unit, first, last, edge[first, last - first].astype(np.int64)

    def _pair_keys(self, edge, unit, first, last, at=None):
        """Priority of joining symbol i with its right neighbour."""
        at = np.arange(len(unit)) if at is None else at
        right = np.minimum(at + 1, len(unit) - 1)
        size = last[right] - first[at]
        fits = (at + 1 < len(unit)) & (unit[right] == unit[at]) & (size < edge.shape[1])
        piece = edge[first[at], np.where(fits, size, 0)]
        return np.where(fits & (piece >= 0), self.priority[piece], _NONE)

    def _merge_long(self, edge, lo: int, n: int):
        """The same rounds for one long unit, with a heap of joins."""
        span = edge.shape[1]
        end = list(range(lo + 1, lo + n + 1))  # end of the symbol that starts at i
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i] - lo
            if j < n and (size := end[j] - lo - i) < span:
                piece = int(edge[lo + i, size])
                if piece >= 0:
                    heapq.heappush(heap, (int(self.priority[piece]), i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] - lo
            if not alive[i] or j >= n or end[j] != stop:
                continue
            end[i], alive[j] = stop, False
            if stop - lo < n:
                before[stop - lo] = i
            offer(i)
            if i:
                offer(before[i])
        first = np.flatnonzero(alive)
        return first + lo, np.array([end[i] for i in first.tolist()], np.int64)

    # ---- unigram vocabularies

    def _best_path(self, edge, offsets, sizes):
        n = len(edge)
        span = self.matcher.longest
        unk = float(self.v.scores[self.v.usable].min()) - 10.0
        score = np.where(edge >= 0, self.v.scores[edge], -np.inf)
        score[edge[:, 1] < 0, 1] = unk
        by_size = np.argsort(-sizes, kind="stable")
        best = np.full(n + 1, -np.inf)
        back = np.ones(n + 1, np.int64)
        best[offsets] = 0.0
        live = len(sizes)
        ascending = sizes[by_size][::-1]
        for k in range(1, int(sizes.max(initial=0)) + 1):
            live = len(sizes) - int(np.searchsorted(ascending, k))
            at = offsets[by_size[:live]] + k
            reach = np.arange(1, min(k, span) + 1)
            total = best[at[:, None] - reach] + score[at[:, None] - reach, reach]
            pick = total.argmax(1)
            best[at], back[at] = total[np.arange(live), pick], reach[pick]
        done = []
        unit = np.flatnonzero(sizes > 0)
        at = offsets[unit] + sizes[unit]
        while len(unit):
            done.append((unit, at - back[at], at))
            at = at - back[at]
            more = at > offsets[unit]
            unit, at = unit[more], at[more]
        if not done:
            z = np.zeros(0, np.int64)
            return z, z, z, z
        unit, first, last = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(first, kind="stable")
        unit, first, last = unit[order], first[order], last[order]
        return unit, first, last, edge[first, last - first].astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for every (start, size)."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


class TextEncoder:
    """Encodes whole texts; remembers the ids of units it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.encoder = Encoder(vocabulary)
        # without a longer piece that holds a line break, units end at line breaks
        self.lines = not any(
            "\n" in p and len(p) > 1 and u
            for p, u in zip(vocabulary.pieces, vocabulary.usable, strict=True)
        )
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str | bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.at: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.n: list[np.ndarray] = [np.zeros(0, np.int64)]

    def units(self, text: str) -> list[str | bytes]:
        """The units of a text, without their first space; a unit that has none (only
        without a prefix space) is a bytes key."""
        if not text:
            return []
        plain = self.v.dummy_prefix and SPACE not in text and "  " not in text
        if plain and text[0] != " " and text[-1] != " ":
            if "\n" not in text or not self.lines:
                return text.split(" ")  # each stands for a space and a word
            first, *lines = text.split("\n")
            out: list[str | bytes] = first.split(" ")
            for line in lines:
                out.append(b"\n")
                if line:
                    head, *words = line.split(" ")
                    if head:
                        out.append(head.encode())
                    out += words
            return out
        whole = (SPACE if self.v.dummy_prefix else "") + text.replace(" ", SPACE)
        found = (_UNITS_LINES if self.lines else _UNITS).findall(whole)
        return [u[1:] if u[0] == SPACE else u.encode() for u in found]

    def _learn(self, new: list[str | bytes]) -> None:
        ids, counts = self.encoder.encode(
            [u.decode() if isinstance(u, bytes) else SPACE + u for u in new]
        )
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.at.append(self.used + np.cumsum(counts) - counts)
        self.n.append(counts)
        self.used += len(ids)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        units = [self.units(t) for t in texts]
        every = [u for us in units for u in us]
        if len(self.known) > REMEMBERED:
            self._forget()
        new = list(dict.fromkeys(u for u in every if u not in self.known))
        if new:
            self._learn(new)
        self.at, self.n = [np.concatenate(self.at)], [np.concatenate(self.n)]
        which = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        at, n = self.at[0][which], self.n[0][which]
        owner = np.repeat(np.arange(len(texts)), [len(us) for us in units])
        counts = np.bincount(owner, n, minlength=len(texts)).astype(np.int64)
        return self.ids[_ranges(at, n)], counts


class Decoder:
    """Turns ids into texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        spelled = [
            p.replace(SPACE, " ").encode() if u else b""
            for p, u in zip(vocabulary.pieces, vocabulary.usable, strict=True)
        ]
        if vocabulary.byte_ids is not None:
            for b, i in enumerate(vocabulary.byte_ids):
                spelled[i] = bytes([b])
        spelled[vocabulary.unknown] = " ⁇ ".encode()
        self.n = np.array([len(s) for s in spelled])
        self.at = np.cumsum(self.n) - self.n
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        n = self.n[ids]
        raw = self.bytes[_ranges(self.at[ids], n)].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)].tolist()
        out, start = [], 0
        for end in ends:
            t = raw[start:end].decode("utf-8", "replace")
            start = end
            out.append(t[1:] if self.v.dummy_prefix and t[:1] == " " else t)
        return out


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "token_ids"
) -> DataFrame:
    """``docs`` with the ids of ``text`` as a column."""
    result = docs.withColumn(out, F.array().cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(vocabulary)
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            for i, j in blocks([len(t) for t in texts], DOC_CHARS):
                ids, counts = encoder.encode(texts[i:j])
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                yield b.slice(i, j - i).set_column(b.schema.get_field_index(out), out, column)

    return result.mapInArrow(run, result.schema)


def decode(
    rows: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """``rows`` with the text of their ids as a column."""
    result = rows.withColumn(out, F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for b in batches:
            column = b.column(b.schema.get_field_index(ids))
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in blocks(counts.tolist(), DOC_CHARS):
                part = column.slice(i, j - i)
                texts = decoder.decode(part.flatten().to_numpy(), counts[i:j].astype(np.int64))
                yield b.slice(i, j - i).set_column(
                    b.schema.get_field_index(out), out, pa.array(texts, pa.string())
                )

    return result.mapInArrow(run, result.schema)


def encode_digest(docs: DataFrame, vocabulary: Vocabulary, keep_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (of the comma-joined ids) and round_trip (are
    the ids decoded to exactly the text?); with ``keep_ids`` also token_ids."""
    result = docs.withColumns(
        {
            "n_tokens": F.lit(0).cast("long"),
            "ids_sha256": F.lit(""),
            "round_trip": F.lit(True),
            **({"token_ids": F.array().cast("array<int>")} if keep_ids else {}),
        }
    )
    shape = result.drop("text")
    run = digest_batches(vocabulary, shape.columns, keep_ids)
    return result.mapInArrow(tidied(run), shape.schema)


def digest_batches(
    vocabulary: Vocabulary, columns_out: list[str], keep_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What ``encode_digest`` does with a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = TextEncoder(vocabulary), Decoder(vocabulary)
        names = np.array([str(i) for i in range(len(vocabulary.pieces))], dtype=object)
        for b in batches:
            # a batch may hold 64 MB of text: strings are made of one block at a time
            for i, j, some in text_blocks(b.column(b.schema.get_field_index("text")), DOC_CHARS):
                texts = [t or "" for t in some]
                ids, counts = encoder.encode(texts)
                same = [x == y for x, y in zip(decoder.decode(ids, counts), texts, strict=True)]
                ends = np.concatenate([[0], np.cumsum(counts)])
                digests = [
                    hashlib.sha256(",".join(names[ids[s:e]]).encode()).hexdigest()
                    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                columns = {
                    "n_tokens": pa.array(counts),
                    "ids_sha256": pa.array(digests, pa.string()),
                    "round_trip": pa.array(same, pa.bool_()),
                }
                if keep_ids:
                    columns["token_ids"] = pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(ids)
                    )
                part = b.slice(i, j - i)
                arrays = [
                    columns[f] if f in columns else part.column(part.schema.get_field_index(f))
                    for f in columns_out
                ]
                yield pa.RecordBatch.from_arrays(arrays, columns_out)

    return run


def op9_sentencepiece(
    spark: SparkSession, sf_dir: str, model: str = DEFAULT_MODEL
) -> DataFrame:
    """Ids of every whole text, as digests, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_digest(docs, load_vocabulary(model))
