"""Phrase collocations by relational mining (SETM), per language.

Texts are cut into pieces and words. Occurrences are kept as relations sorted by place:
(place, phrase), where places count on inside a piece and skip one between pieces, so two
occurrences at adjacent places lie in the same piece. Starting with words, each round

1. merge-joins the relation with itself at adjacent places: phrases of k words that start
   at p and p + 1 make the phrase of k + 1 words at p;
2. group-counts the new phrases over all documents, overlaps included;
3. semi-joins the relation with the frequent ones, which alone are extended further.

A phrase of k + 1 words is named by the names of its first and its last k words, so
counting is exact and no phrase text is shuffled after the words. The relations are
written as tables of chunks (about CHUNK_CHARS characters); a chunk sends a phrase once
with its count, so the most frequent phrase is a row per chunk, and one shuffle by phrase
gives both the count and the chunks that hold it (a window per phrase). Frequent names go
back to the chunks by a co-group on the chunk number, packed into a row per task and chunk,
which writes the next relation: one table a round. A table goes when the next one is written.

Most phrases of two words and more are rare, and their rows would be most of a shuffle. So
they are ruled out first, as in Park, Chen and Yu's DHP: phrases are hashed into slots, chunks
send what they count in each of theirs (about a byte and a half a phrase), and a phrase whose
slot has fewer than ``least`` occurrences in all cannot be frequent. This never drops a
frequent phrase; one that shares its slot with others is counted as before. The slots follow
the number of words up to MOST_SLOTS (a bitmap of 16 MB), so in a very large table more rare
phrases stay.

What follows works on frequent phrases only: prefixes and suffixes, with their counts, come
by joins on names, the score is exact in DECIMAL(38, 0) and integer division, a candidate
goes if a candidate one word longer holds it with the same count (a count never grows with
the phrase, so longer ones in between have that count too), and the best of each language
are the best of SALTS parts of it, ranked again.

Defined results: null or empty text has no words. A null language is ``und``. Repeated
rows count each. A text over CHUNK_CHARS is read in slices cut at white space. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import (
    discard, from_planes, materialize, planes, setting, squeezed, table, text_blocks, unsqueezed,
)

CHUNK_CHARS = 4_000_000
SLICE_CHARS = 1_000_000
BLOCK_BYTES = 1_000_000
LONGEST = 5
LEAST = 100
TOP = 2000
SALTS = 32  # parts of a language that are ranked on their own first
SLOT_WORDS = 16  # words of the table for which there is a slot
LEAST_SLOTS, MOST_SLOTS, RANGE_SLOTS = 1 << 16, 1 << 27, 1 << 18  # a range is a group
PACK_ROWS = 500_000  # frequent phrases that a task packs at once
_AT_BITS = 28  # of a phrase's number in its chunk
_SEQ_BITS = 15  # of a chunk's number in its task
_MARK = b"\n"  # stands between pieces
_FOLD = bytes(
    32 if c == 9 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)

RELATION = "chunk bigint, place binary, item binary"
WORDS = RELATION + ", words binary, sizes binary, langs array<string>, " \
    "totals array<bigint>, lang_of binary, n binary"
KEYS = "lang string, word binary, left bigint, right bigint"  # of a word; of a longer phrase
FOUND = f"name bigint, a bigint, {KEYS}"
_FOUND = "found array<struct<{}>>".format(", ".join(":".join(x.split()) for x in FOUND.split(", ")))
PHRASES = RELATION + ", names binary, left binary, right binary, n binary, " + _FOUND
NAMES = "chunk bigint, at binary, name binary, " + _FOUND
SKETCH = "part int, slot binary, n binary"


def slices(text: str, most: int) -> Iterator[str]:
    """The text in slices that end at a space, tab or newline where there is one."""
    at = 0
    while len(text) - at > most:
        cut = max(text.rfind(c, at, at + most) for c in " \t\n")
        if cut < 0:
            later = [x for x in (text.find(c, at + most) for c in " \t\n") if x >= 0]
            if not later:
                break
            cut = min(later)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


class _Words:
    """A chunk's words and their occurrences."""

    def __init__(self):
        self.langs: dict[str, tuple[int, dict[bytes, int]]] = {}
        self.names: list[bytes] = []
        self.lang_of: list[int] = []
        self.parts: list[np.ndarray] = []
        self.chars = 0

    def add(self, lang: str, text: str) -> None:
        """Occurrences of a text; -1 stands between pieces and texts."""
        code, known = self.langs.setdefault(lang, (len(self.langs), {_MARK: -1, b"": -2}))
        for s in slices(text, SLICE_CHARS):
            some = s.encode().translate(_FOLD).replace(_MARK, b" \n ").split(b" ")
            for w in set(some).difference(known):
                known[w] = len(self.names)
                self.names.append(w)
                self.lang_of.append(code)
            found = np.fromiter(map(known.__getitem__, some), np.int64, len(some))
            self.parts.append(found[found != -2])
        self.parts.append(np.array([-1]))
        self.chars += len(text)

    def row(self, chunk: int) -> pa.RecordBatch:
        every = np.concatenate(self.parts)
        gap = every < 0
        # a piece starts one place further on, whatever number of marks stands before it
        place = np.arange(len(every))[~gap]
        item = every[~gap]
        n = np.bincount(item, minlength=len(self.names))
        # frequent words get small numbers
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        names, n, lang_of = [self.names[i] for i in order], n[order], np.array(self.lang_of)[order]
        values = {
            "chunk": [chunk],
            "place": [_steps(place)],
            "item": [squeezed(planes(rank[item]))],
            "words": [b"".join(names)],
            "sizes": [np.array([len(w) for w in names], "<u4").tobytes()],
            "langs": [list(self.langs)],
            "totals": [np.bincount(lang_of, n, len(self.langs)).astype(np.int64)],
            "lang_of": [lang_of.astype("<u4").tobytes()],
            "n": [n.astype("<i8").tobytes()],
        }
        kinds = {"chunk": pa.int64(), "langs": pa.list_(pa.string()), "totals": pa.list_(pa.int64())}
        return pa.RecordBatch.from_pydict(
            {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in values.items()}
        )


def _steps(place: np.ndarray) -> bytes:
    return squeezed(planes(np.diff(place, prepend=0)))


def _from_steps(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(unsqueezed(raw)))


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The relation of words, a row per chunk, with the chunk's words."""
    rows = docs.select(
        F.col(text).alias("t"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, chunk = TaskContext.get().partitionId(), 0, _Words()
        for b in batches:
            for i, j, texts in text_blocks(b.column("t"), BLOCK_BYTES):
                for t, name in zip(texts, b.column("l").slice(i, j - i).to_pylist(), strict=True):
                    if t:
                        chunk.add(name, t)
                if chunk.chars >= CHUNK_CHARS:
                    yield chunk.row((part << _SEQ_BITS) + seq)
                    seq, chunk = seq + 1, _Words()
        if chunk.names:
            yield chunk.row((part << _SEQ_BITS) + seq)

    return rows.mapInArrow(read, WORDS)


def _word_rows(words: DataFrame) -> DataFrame:
    """(chunk, at, lang, word, n) of all chunks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ends = np.cumsum(np.frombuffer(r["sizes"], "<u4").astype(np.int64))
                names, of = pa.array(r["langs"], pa.string()), np.frombuffer(r["lang_of"], "<u4")
                n = np.frombuffer(r["n"], "<i8")
                for i in range(0, len(ends), 50_000):
                    j = min(len(ends), i + 50_000)
                    edge = np.concatenate([[0 if i == 0 else ends[i - 1]], ends[i:j]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(j - i, r["chunk"], np.int64)),
                            pa.array(np.arange(i, j, dtype=np.int32)),
                            names.take(pa.array(of[i:j])),
                            pa.array([r["words"][x:y] for x, y in zip(edge, edge[1:], strict=False)], pa.binary()),
                            pa.array(n[i:j]),
                        ],
                        ["chunk", "at", "lang", "word", "n"],
                    )

    return words.select("chunk", "words", "sizes", "langs", "lang_of", "n").mapInArrow(
        unpack, "chunk bigint, at int, lang string, word binary, n bigint"
    )


def _phrases(r: dict) -> tuple[np.ndarray, ...]:
    """Names of the parts, and counts, of a chunk's phrases."""
    name = np.frombuffer(r["names"], "<i8")
    return name[from_planes(r["left"])], name[from_planes(r["right"])], from_planes(r["n"])


def _slot(left: np.ndarray, right: np.ndarray, slots: int) -> np.ndarray:
    x = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(slots)).astype(np.int64)


def slot_count(words: int) -> int:
    """Slots for a table of so many words, a power of 2."""
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (words // SLOT_WORDS).bit_length()))


def crowded(relation: DataFrame, least: int, slots: int) -> bytes:
    """A bitmap of the slots with at least ``least`` occurrences of phrases in all chunks."""
    size = min(slots, RANGE_SLOTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                left, right, n = _phrases(r)
                slot, of = np.unique(_slot(left, right, slots), return_inverse=True)
                n = np.minimum(np.bincount(of, n, len(slot)), least)
                part = slot // size
                cut = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
                some = list(zip(cut, [*cut, len(slot)][1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[cut].astype(np.int32)),
                        pa.array([_steps(slot[i:j] - part[i] * size) for i, j in some], pa.binary()),
                        pa.array([squeezed(planes(n[i:j])) for i, j in some], pa.binary()),
                    ],
                    ["part", "slot", "n"],
                )

    def total(rows: pa.Table) -> pa.Table:
        every = np.zeros(size, np.int64)
        for slot, n in zip(rows["slot"], rows["n"], strict=True):
            every[_from_steps(slot.as_py())] += from_planes(unsqueezed(n.as_py()))  # once a row
        bits = np.packbits(every >= least, bitorder="little").tobytes()
        return pa.table({"part": rows["part"].slice(0, 1), "bits": pa.array([bits], pa.binary())})

    rows = relation.select("names", "left", "right", "n").mapInArrow(count, SKETCH)
    parts = rows.groupBy("part").applyInArrow(total, "part int, bits binary")
    out = bytearray(slots // 8)
    with setting(relation.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        for r in parts.collect():  # at most MOST_SLOTS bits
            out[r["part"] * size // 8 : (r["part"] + 1) * size // 8] = r["bits"]
    return bytes(out)


def _phrase_rows(relation: DataFrame, least: int, slots: int) -> DataFrame:
    """(chunk, at, left, right, n) of all chunks, without phrases whose slot is not crowded."""
    shared = relation.sparkSession.sparkContext.broadcast(crowded(relation, least, slots))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            for r in b.to_pylist():
                left, right, n = _phrases(r)
                slot = _slot(left, right, slots)
                at = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                for i in range(0, len(at), 50_000):
                    some = at[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), r["chunk"], np.int64)),
                            pa.array(some.astype(np.int32)),
                            pa.array(left[some]),
                            pa.array(right[some]),
                            pa.array(n[some]),
                        ],
                        ["chunk", "at", "left", "right", "n"],
                    )

    return relation.select("chunk", "names", "left", "right", "n").mapInArrow(
        unpack, "chunk bigint, at int, left bigint, right bigint, n bigint"
    )


def frequent(rows: DataFrame, key: list[str], least: int) -> DataFrame:
    """The chunks' phrases with at least ``least`` occurrences in all: where they are and their
    name, which is the smallest (chunk, at) that holds the phrase; there (``first``) also
    count and key."""
    same = Window.partitionBy(*key)
    place = F.shiftleft(F.col("chunk"), _AT_BITS).bitwiseOR(F.col("at").cast("long"))
    first = F.col("name") == place
    keys = [x.split() for x in KEYS.split(", ")]
    return (
        rows.withColumn("a", F.sum("n").over(same))
        .withColumn("name", F.min(place).over(same))
        .where(F.col("a") >= least)
        .select(
            "chunk", "at", first.alias("first"), "name", F.when(first, F.col("a")).alias("a"),
            *[F.when(first, F.col(c)).alias(c) if c in key else F.lit(None).cast(kind).alias(c)
              for c, kind in keys],
        )
    )


def packed_names(found: DataFrame) -> DataFrame:
    """Frequent phrases packed into a row per task and chunk that holds some of them."""
    columns = [x.split()[0] for x in FOUND.split(", ")]

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        t = t.take(np.lexsort((t["at"].to_numpy(), t["chunk"].to_numpy()))).combine_chunks()
        chunk, at, name = (t[c].to_numpy() for c in ("chunk", "at", "name"))
        first = np.flatnonzero(t["first"].to_numpy(zero_copy_only=False))
        named = t.select(columns).take(first).combine_chunks().to_batches()
        named = named[0].to_struct_array() if named else pa.array([], pa.struct(t.select(columns).schema))
        cut = np.flatnonzero(np.diff(chunk, prepend=-1))
        edge = [*cut.tolist(), len(chunk)]
        some = list(zip(edge, edge[1:], strict=False))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunk[cut]),
                pa.array([_steps(at[i:j]) for i, j in some], pa.binary()),
                pa.array([squeezed(planes(name[i:j], 8)) for i, j in some], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(first, edge), pa.int32()), named),
            ],
            ["chunk", "at", "name", "found"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held, n = [*held, b], n + b.num_rows
            if n >= PACK_ROWS:
                yield rows(held)
                held, n = [], 0
        if n:
            yield rows(held)

    return found.mapInArrow(pack, NAMES)


def extend(relation: DataFrame, names: DataFrame) -> DataFrame:
    """Semi-joins a relation with the (packed) frequent phrases of its chunk and merge-joins it
    with itself at adjacent places. ``found`` lists the frequent phrases that are named after
    this chunk, so that over all chunks each is listed once."""

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():  # one row
            item, place = from_planes(unsqueezed(r["item"])), _from_steps(r["place"])
            none = [np.empty(0, np.int64)]
            at = np.concatenate(none + [_from_steps(x.as_py()) for x in right["at"]])
            name = np.concatenate(none + [from_planes(unsqueezed(x.as_py()), 8) for x in right["name"]])
            order = np.argsort(at)
            at, name = at[order], name[order]
            rank = np.full(int(item.max(initial=0)) + 1, -1, np.int64)
            rank[at] = np.arange(len(at))
            mine = rank[item]
            place, mine = place[mine >= 0], mine[mine >= 0]
            start = np.flatnonzero(np.diff(place) == 1)
            pair = mine[start] * len(at) + mine[start + 1]
            found, item, n = np.unique(pair, return_inverse=True, return_counts=True)
            first, last = np.divmod(found, max(1, len(at)))
            values = {
                "place": _steps(place[start]),
                "item": squeezed(planes(item)),
                "names": name.astype("<i8").tobytes(),
                "left": planes(first),
                "right": planes(last),
                "n": planes(n),
            }
            named = right["found"].combine_chunks().flatten()
            out.append(pa.table(
                {"chunk": pa.array([r["chunk"]], pa.int64())}
                | {k: pa.array([v], pa.binary()) for k, v in values.items()}
                | {"found": pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named)}
            ))
        return pa.concat_tables(out)

    return (
        relation.select("chunk", "place", "item").groupBy("chunk")
        .cogroup(names.groupBy("chunk"))
        .applyInArrow(step, PHRASES)
    )


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text",
         lang: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1 to ``longest`` words, a table for each length, and (lang, n).

    Columns: name, lang, phrase, last (word), a, heads and tails (counts of the first and of
    the last 1, 2, ... words), left and right (names of the parts one word shorter).
    """
    words = materialize(occurrences(docs, text, lang), "phrases-words", tidy=True)
    rows = _word_rows(words)
    totals = materialize(
        words.select(F.inline(F.arrays_zip("langs", "totals"))).groupBy(F.col("langs").alias("lang"))
        .agg(F.sum("totals").alias("n")), "phrases-totals", tidy=True,
    )
    slots = slot_count(totals.agg(F.sum("n")).first()[0] or 0)
    found = frequent(rows, ["lang", "word"], least)
    relation, levels = words, []
    for k in range(1, longest + 1):
        if k < longest:
            # a table of their own: the counted rows are off the disk before the relation is shuffled
            names = materialize(packed_names(found), "phrases-names", tidy=True)
            longer = materialize(extend(relation, names), "phrases-relation", tidy=True)
            discard(names)
            discard(relation)
            relation = longer
            named = relation.select(F.inline("found"))
            found = frequent(_phrase_rows(relation, least, slots), ["left", "right"], least)
        else:
            named = found.where("first")
        level = _words(named) if k == 1 else _described(named, levels[-1])
        levels.append(materialize(level.hint("rebalance"), "phrases-level", tidy=True))
    if longest > 1:
        discard(relation)
    return levels, totals


def _words(found: DataFrame) -> DataFrame:
    none, word = F.array().cast("array<bigint>"), F.col("word").cast("string")
    return found.select(
        "name", "lang", word.alias("phrase"), word.alias("last"), "a", none.alias("heads"),
        none.alias("tails"), "left", "right",
    )


def _described(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """New frequent phrases with their words and the counts of their parts."""
    head = shorter.select(
        F.col("name").alias("left"), "lang", F.col("phrase").alias("start"),
        F.concat("heads", F.array("a")).alias("heads"),
    )
    tail = shorter.select(
        F.col("name").alias("right"), "last", F.concat("tails", F.array("a")).alias("tails")
    )
    return (
        found.select("name", "a", "left", "right").join(head, "left").join(tail, "right")
        .select("name", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "a",
                "heads", "tails", "left", "right")
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    levels, totals = mine(docs, least, longest, text, lang)
    # a name is unique among the phrases of its length
    of_k = [df.withColumn("k", F.lit(k)) for k, df in enumerate(levels, 1)]
    candidates = reduce(DataFrame.unionByName, of_k[1:])
    inside = (
        candidates.select(
            F.explode(F.array("left", "right")).alias("name"), (F.col("k") - 1).alias("k"),
            F.col("a").alias("longer"),
        )
        .groupBy("name", "k").agg(F.max("longer").alias("longer"))
    )
    kept = (
        candidates.join(inside, ["name", "k"], "left")
        .where(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * 100))
        .join(totals, "lang")
        .withColumn("top", (_wide("a") * _wide("n") * F.lit(1000).cast("decimal(4,0)")))
    )

    def cut(k: Column) -> Column:
        first, rest = F.get("heads", k - 1), F.get("tails", F.size("tails") - k)
        under = (_wide(first) * _wide(rest)).alias("under")
        return F.struct(F.call_function("div", F.col("top"), under).alias("score"), k.alias("k"),
                        first.alias("l"), rest.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), F.size("heads")), cut))
    rows = kept.withColumn("best", best).select(
        "lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"), F.pmod(F.xxhash64("name"), F.lit(SALTS)).alias("salt"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]

    def first(df: DataFrame, *by: str) -> DataFrame:
        same = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn("rank", F.row_number().over(same).cast("long")).where(F.col("rank") <= top)

    ranked = first(first(rows, "lang", "salt").drop("rank", "salt"), "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language, over all whole texts."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), lengths AS (
  SELECT unnest(range(1, 6)) AS k
), starts AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, lengths WHERE len(w) >= k
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM starts GROUP BY 1, 2, 3
), totals AS (
  SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM f WHERE k >= 2 AND a >= 100
), cuts AS (
  SELECT c.*, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM candidates c
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.j, p.a AS l, s.a AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (p.a::HUGEINT * s.a) AS score
  FROM cuts c
  JOIN f p ON p.lang = c.lang AND p.k = c.j AND p.phrase = array_to_string(c.w[1:c.j], ' ')
  JOIN f s ON s.lang = c.lang AND s.k = c.k - c.j AND s.phrase = array_to_string(c.w[c.j + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = b.lang AND c.k > b.k AND 100 * c.a >= 100 * b.a
      AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
