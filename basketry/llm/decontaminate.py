"""Benchmark decontamination by pigeonhole edit matching.

A text is contaminated by an item when some stretch of it is within ``e`` edits of the
whole item, ``e = floor(ERROR_RATE * item length)``, both normalised (lower case,
everything but letters and digits is one space).

Each item is split into e + 1 pieces, so a stretch within e edits holds one piece
unchanged. One Aho-Corasick pass finds all exact piece hits in a text; hits of an item
on nearby diagonals become one window, and Myers' bit-parallel algorithm verifies the
window (one machine-independent big-integer step per character). No pair of rows is
formed and nothing is shuffled: documents are scanned where they lie.

The items are the stated query set. They travel to the tasks in blocks of at most
ITEM_BLOCK_BYTES of text (measured before the first block is read); a larger benchmark
takes more passes over the documents, each appending its hits.

Defined results: null text or text without letters and digits has no hits. Null or empty
items match nothing. Items under SHORT normalised characters must occur exactly and as
whole words. Repeated items are reported each. Repeated documents repeat their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import free_name, table, text_bytes, tidied

ERROR_RATE = 0.06
SHORT = 20
ITEM_BLOCK_BYTES = 2 << 20

_ASCII = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def normalise(text: str | None) -> str:
    """Lower case; every run of anything but letters and digits is one space."""
    t = (text or "").lower()
    if not t.isascii():
        for c in set(t):
            if c > "\x7f" and not c.isalnum():
                t = t.replace(c, " ")
    return b" ".join(t.encode().translate(_ASCII).split()).decode()


def budget(pattern: str) -> int:
    """Edits allowed; the border spaces of a short item are no part of its length."""
    return 0 if len(pattern.strip(" ")) < SHORT else int(ERROR_RATE * len(pattern))


def pieces(pattern: str) -> list[tuple[int, str]]:
    """(offset, piece) of the e + 1 near-equal pieces."""
    n = budget(pattern) + 1
    cuts = [len(pattern) * i // n for i in range(n + 1)]
    return [(a, pattern[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def best_distance(masks: dict[str, int], m: int, text: str) -> int:
    """Fewest edits between the pattern and any stretch of ``text`` (Myers 1999)."""
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = every, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | (~(diagonal | up) & every)
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best = score
        plus = (plus << 1) & every
        minus = (minus << 1) & every
        up = minus | (~(vertical | plus) & every)
        down = plus & vertical
    return best


class Matcher:
    """Piece automaton and verifier of one block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items: list[tuple[list, str, int]] = []
        found: dict[str, list] = {}
        for item_id, text in items:
            if pattern := normalise(text):
                if len(pattern) < SHORT:
                    pattern = f" {pattern} "
                found.setdefault(pattern, []).append(item_id)
        places: dict[str, list[tuple[int, int]]] = {}
        for pattern, ids in sorted(found.items()):
            for offset, piece in pieces(pattern):
                places.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((sorted(ids), pattern, budget(pattern)))
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def hits(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, fewest edits) of every item found in the text, by item id."""
        if self.empty or not text:
            return []
        t = f" {normalise(text)} "
        diagonals: dict[int, set[int]] = {}
        for end, (size, at) in self.automaton.iter(t):
            for item, offset in at:
                diagonals.setdefault(item, set()).add(end + 1 - size - offset)
        out = []
        for item, starts in diagonals.items():
            ids, pattern, e = self.items[item]
            best = self._verify(item, pattern, e, sorted(starts), t)
            if best <= e:
                out += [(i, best) for i in ids]
        return sorted(out)

    def _verify(self, item: int, pattern: str, e: int, starts: list[int], t: str) -> int:
        m = len(pattern)
        for s in starts:
            if s >= 0 and t.startswith(pattern, s):
                return 0
        if e == 0:
            return m
        if item not in self.masks:
            self.masks[item] = letter_masks(pattern)
        best, lo, hi = m, None, None
        for s in [*starts, None]:
            if lo is not None and (s is None or s - e > hi):
                best = min(best, best_distance(self.masks[item], m, t[max(0, lo) : hi]))
                lo = None
            if s is not None:
                lo = s - e if lo is None else lo
                hi = s + m + e
        return best


HITS = "array<struct<item_id: bigint, edits: bigint>>"


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size."""
    total = text_bytes(items, text)
    n = -(-total // ITEM_BLOCK_BYTES)
    for i in range(n):
        mine = items.where(F.pmod(F.xxhash64(text), F.lit(n)) == i) if n > 1 else items
        rows = mine.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t"))
        yield [(r["i"], r["t"]) for r in rows.where("t IS NOT NULL AND i IS NOT NULL").collect()]


def mark(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "hits",
) -> DataFrame:
    """``docs`` with a column of (item_id, edits) hits, by item id."""
    marked = docs.withColumn(out, F.array().cast(HITS))
    for block in item_blocks(items, item_id, item_text):

        def find(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block)
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64())]))
            for b in batches:
                at = b.schema.get_field_index(out)
                texts, old = b.column(b.schema.get_field_index(text)), b.column(at)
                new = []
                for t, o in zip(texts, old, strict=True):
                    more = [{"item_id": i, "edits": e} for i, e in matcher.hits(t.as_py())]
                    new.append((o.as_py() or []) + more)
                yield b.set_column(at, out, pa.array(new, kind))

        marked = marked.mapInArrow(tidied(find), marked.schema)
    return marked


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    hits = free_name(docs, "__hits")
    return mark(docs, items, out=hits).where(F.size(hits) == 0).drop(hits)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark(docs, table(spark, sf_dir, "benchmark"))
    ids = F.sort_array(F.transform("hits", lambda h: h["item_id"]))
    return marked.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.size("hits").cast("long").alias("n_items"),
        ids.alias("item_ids"),
        F.array_min(F.transform("hits", lambda h: h["edits"])).alias("fewest_edits"),
    )
