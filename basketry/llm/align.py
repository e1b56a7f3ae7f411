"""Alignment of two tokenizers' tokens over the same bytes.

A text, with a space before it, is encoded by a byte-level vocabulary (A) and by a
SentencePiece vocabulary (B, which adds that space itself). Offsets where tokens of both
end cut the tokens into groups; the two tokens that end there are linked.

Inside a task everything is Arrow arrays of a block of texts: the id lists are flattened
with their parents' indices, a cumulative sum of token byte lengths per segment gives every
token's end in its part, an Acero hash join on (part, end) finds the common ends, and
``Table.group_by`` counts the linked id pairs per document. At a single space between two
other characters both vocabularies start a new token (A's words begin with a space, no
piece of B holds one inside), so a text is the chain of its units between such cuts: a
worker encodes a unit once and keeps its ids, and a very long text is aligned in parts.

Plan, linear in the corpus:

1. ``chunks``: one narrow pass; each task writes rows of about CHUNK_PAIRS (document, id
   pair) counts: the chunk's distinct pairs with their counts, its documents' pairs as
   numbers into them, and the finished columns. The table is in the checkpoint folder.
2. the chunks' pair counts are merged by Spark (a chunk sends a pair once, so the most
   frequent pair is a row per chunk); the best count of a B id is a window over its pairs,
   of which there are at most as many as A has ids.
3. counts go back to the chunks' pairs (plain shuffles) and are summed per document.

Defined results: texts that are null or empty, or whose tokens do not spell the space and
the text, have zeros and the empty string. Repeated rows and null ids are answered each,
and count each. Other columns are not read. An empty table gives no rows. A unit without a
cut inside is encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import blocks, from_planes, kept, materialize, planes, table, text_blocks
from basketry.llm.tokencache import read_tokenizer

TOKENIZER_A = "byte_bpe_50k.json"
MODEL_B = "piece_bpe_32k.model"
BLOCK_BYTES = 1_000_000  # texts that are split at once
BLOCK_UNITS = 200_000  # units that are aligned at once
BATCH_CHARS = 200_000  # characters that a library encodes at once
REMEMBERED = 300_000  # units that a worker keeps
REMEMBERED_CHARS = 8_000_000
CHUNK_PAIRS = 2_000_000
CUT = re.compile(r"(?<=\S) (?=\S)")

CHUNK = (
    "chunk bigint, pairs binary, n binary, rows binary, number binary, times binary, "
    "doc_ids array<{id}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, sha array<string>"
)
RESULT = (
    "doc_id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def byte_level_alphabet() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable Latin-1 bytes are
    themselves, the others follow from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """Token bytes of a vocabulary by id, and its encoder of texts."""

    def __init__(self, spelled: list[bytes]):
        self.bytes = pa.array(spelled, pa.binary())
        self.length = pa.array([len(x) for x in spelled], pa.int64())

    def encode(self, some: list[str]) -> list[list[int]]:
        raise NotImplementedError


class ByteLevel(Side):
    """A vocabulary of the tokenizers library; its texts get the space here."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_level_alphabet()
        spelled = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in self.tokenizer.get_vocab().items():
            spelled[i] = bytes(alphabet[c] for c in piece if c in alphabet)
        super().__init__(spelled)

    def encode(self, some):
        found = self.tokenizer.encode_batch_fast([" " + t for t in some], add_special_tokens=False)
        return [e.ids for e in found]


class Pieces(Side):
    """A SentencePiece vocabulary, which adds the space itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.pieces = p = SentencePieceProcessor(model_proto=model)
        super().__init__([
            bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i)
            else p.id_to_piece(i).replace("▁", " ").encode()
            for i in range(p.get_piece_size())
        ])

    def encode(self, some):
        return self.pieces.encode(some, num_threads=1)


class Units:
    """Token ids of units, each encoded once: a unit is what lies between two cuts and
    stands for a space and itself, as the whole text does."""

    def __init__(self, a: Side, b: Side):
        self.sides = (a, b)
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids = [np.zeros(0, np.int32)] * 2
        self.offsets = [np.zeros(1, np.int64)] * 2

    def numbers(self, some: list[str]) -> np.ndarray:
        """Numbers of units; new ones are encoded."""
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.__init__(*self.sides)
        new = list(set(some).difference(self.known))
        found: tuple[list, list] = ([], [])
        for i, j in blocks([len(u) for u in new], BATCH_CHARS):
            for side, out in zip(self.sides, found, strict=True):
                out += side.encode(new[i:j])
        for k, out in enumerate(found):
            sizes = np.fromiter(map(len, out), np.int64, len(out))
            flat = np.fromiter(chain.from_iterable(out), np.int32, int(sizes.sum()))
            self.ids[k] = np.concatenate([self.ids[k], flat])
            self.offsets[k] = np.concatenate([self.offsets[k], self.offsets[k][-1] + np.cumsum(sizes)])
        first = len(self.known)
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        self.chars += sum(map(len, new))
        return np.fromiter(map(self.known.__getitem__, some), np.int64, len(some))

    def tokens(self, units: np.ndarray, cut: np.ndarray, k: int) -> pa.ListArray:
        """Token ids of vocabulary ``k``, a list per part; ``cut`` bounds the parts' units."""
        first, size = self.offsets[k][units], np.diff(self.offsets[k])[units]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)
        return pa.ListArray.from_arrays(pa.array(ends[cut], pa.int32()), pa.array(self.ids[k][at]))


def token_ends(lists: pa.ListArray, side: Side) -> pa.Table:
    """(part, end, id) of all tokens: end counts the part's bytes up to the token's last."""
    flat = pc.list_flatten(lists)
    part = pc.list_parent_indices(lists)
    running = pc.cumulative_sum(side.length.take(flat))
    before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(lists.offsets[:-1])
    return pa.table({"part": part, "end": pc.subtract(running, before.take(part)), "id": flat})


def spells(tokens: pa.Table, side: Side, want: list[bytes]) -> np.ndarray:
    """Which parts' token bytes, joined, are the wanted bytes."""
    joined = _data(side.bytes.take(tokens["id"].combine_chunks()))
    if joined == b"".join(want):
        ends = np.bincount(tokens["part"].to_numpy(), side.length.take(tokens["id"]).to_numpy(), len(want))
        if np.array_equal(ends, [len(w) for w in want]):
            return np.ones(len(want), bool)
    size = np.zeros(len(want), np.int64)
    np.add.at(size, tokens["part"].to_numpy(), side.length.take(tokens["id"]).to_numpy())
    end = np.cumsum(size)
    return np.array(
        [joined[e - s : e] == w for e, s, w in zip(end.tolist(), size.tolist(), want, strict=True)], bool
    )


def _data(column: pa.Array) -> bytes:
    if not len(column):
        return b""
    first, last = column.buffers()[1], len(column)
    offsets = np.frombuffer(first, np.int32, last + 1)
    return column.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()


class Aligner:
    def __init__(self, tokenizer_json: str, model: bytes):
        self.a, self.b = ByteLevel(tokenizer_json), Pieces(model)
        self.units = Units(self.a, self.b)
        self.ids = max(len(self.a.bytes), len(self.b.bytes))
        self.shown = pa.array(
            [f"{i}{mark}".encode() for mark in ",|;" for i in range(self.ids)], pa.binary()
        )

    def align(self, some: list[list[str]]) -> tuple[np.ndarray, dict[str, np.ndarray], pa.Table, list[bytes]]:
        """Of each part (its units): whether both vocabularies spell it, its numbers of A
        and B tokens and of groups, and its groups as text; and all links as (part, id_a,
        id_b)."""
        units = self.units.numbers(list(chain.from_iterable(some)))
        cut = np.concatenate([[0], np.cumsum([len(u) for u in some])])
        want = [(" " + " ".join(u)).encode() for u in some]
        a, b = (token_ends(self.units.tokens(units, cut, k), s) for k, s in enumerate((self.a, self.b)))
        good = spells(a, self.a, want) & spells(b, self.b, want)
        if not good.all():
            a, b = (t.filter(pa.array(good).take(t["part"])) for t in (a, b))
        a, b = (t.append_column("at", pa.array(np.arange(len(t)))) for t in (a, b))
        linked = a.join(
            b, ["part", "end"], join_type="inner", left_suffix="_a", right_suffix="_b", use_threads=False
        ).sort_by([("at_a", "ascending"), ("at_b", "ascending")])
        of = {k: np.bincount(t["part"].to_numpy(), minlength=len(some)) for k, t in
              (("n_a", a), ("n_b", b), ("n_groups", linked))}
        return good, of, linked.select(["part", "id_a", "id_b"]), self._groups(a, b, linked, of)

    def _groups(self, a: pa.Table, b: pa.Table, linked: pa.Table, of: dict) -> list[bytes]:
        """Every part's groups, ``a1,a2|b1;a3|b2``."""
        if not len(linked):
            return [b""] * len(of["n_a"])
        last_a, last_b = linked["at_a"].to_numpy(), linked["at_b"].to_numpy()
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        group_a, group_b = np.searchsorted(last_a, at_a), np.searchsorted(last_b, at_b)
        place = np.empty(len(a) + len(b), np.int64)
        before_b = np.concatenate([[0], last_b + 1])
        to_a, to_b = at_a + before_b[group_a], at_b + last_a[group_b] + 1
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = self.ids, 2 * self.ids
        place[to_a] = a["id"].to_numpy() + mark_a
        place[to_b] = b["id"].to_numpy() + mark_b
        shown = self.shown.take(pa.array(place))
        raw = _data(shown)
        offsets = np.frombuffer(shown.buffers()[1], np.int32, len(shown) + 1)
        cut = offsets[np.concatenate([[0], np.cumsum(of["n_a"] + of["n_b"])])].tolist()
        return [raw[i : max(i, j - 1)] for i, j in zip(cut, cut[1:], strict=False)]


class _Chunk:
    """Documents gathered until they hold CHUNK_PAIRS pairs."""

    def __init__(self):
        self.ids, self.sha, self.tables = [], [], []
        self.of = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links")}
        self.bad: list[bool] = []
        self.size = 0

    def row(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        every = pa.concat_tables(self.tables) if self.tables else pa.table(
            {"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())}
        )
        every = every.filter(pa.array([not x for x in self.bad], pa.bool_()).take(every["doc"]))
        owned = every.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
        distinct = owned.group_by("pair", use_threads=False).aggregate([("times_sum", "sum")]).sort_by("pair")
        owned = owned.append_column(
            "number", pc.index_in(owned["pair"], distinct["pair"].combine_chunks())
        ).sort_by([("doc", "ascending"), ("number", "ascending")])
        rows = np.bincount(owned["doc"].to_numpy(), minlength=len(self.ids))
        held = owned["number"].to_numpy().astype(np.int64)
        step = np.diff(held, prepend=0)
        first = (np.cumsum(rows) - rows)[rows > 0]
        step[first] = held[first]  # each document counts its steps from 0
        kept = np.array([not x for x in self.bad], bool)
        values = {
            "chunk": pa.array([number], pa.int64()),
            "pairs": pa.array([distinct["pair"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "n": pa.array([distinct["times_sum_sum"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "rows": pa.array([rows.astype("<i8").tobytes()], pa.binary()),
            "number": pa.array([planes(step)], pa.binary()),
            "times": pa.array([planes(owned["times_sum"].to_numpy())], pa.binary()),
            "doc_ids": pa.array([self.ids], pa.list_(id_type)),
        }
        for k, v in self.of.items():
            values[k] = pa.array([(np.array(v, np.int64) * kept).tolist()], pa.list_(pa.int64()))
        sha = [s.hexdigest() if s and not x else "" for s, x in zip(self.sha, self.bad, strict=True)]
        values["sha"] = pa.array([sha], pa.list_(pa.string()))
        return pa.RecordBatch.from_pydict(values)


def chunks(docs: DataFrame, tokenizer_json: str, model: bytes, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"))
    schema = CHUNK.format(id=rows.schema["i"].dataType.simpleString())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        aligner = kept(("aligner", tokenizer_json, model), lambda: Aligner(tokenizer_json, model))
        task, seq, chunk, id_type = TaskContext.get().partitionId(), 0, _Chunk(), None
        for batch in batches:
            id_type = batch.column("i").type
            for i, j, texts in text_blocks(batch.column("t"), BLOCK_BYTES):
                first = len(chunk.ids)
                chunk.ids += batch.column("i").slice(i, j - i).to_pylist()
                chunk.sha += [None] * (j - i)
                chunk.bad += [False] * (j - i)
                for v in chunk.of.values():
                    v += [0] * (j - i)
                some = [(first + k, CUT.split(t)) for k, t in enumerate(texts) if t]
                for x, y in blocks([len(u) for _, u in some], BLOCK_UNITS):
                    for part in range(0, max(len(u) for _, u in some[x:y]), BLOCK_UNITS):
                        these = [(d, u[part : part + BLOCK_UNITS]) for d, u in some[x:y] if part < len(u)]
                        _gather(chunk, aligner, these)
                if chunk.size >= CHUNK_PAIRS:
                    yield chunk.row((task << 32) + seq, id_type)
                    seq, chunk = seq + 1, _Chunk()
        if chunk.ids:
            yield chunk.row((task << 32) + seq, id_type)

    return rows.mapInArrow(pack, schema)


def _gather(chunk: _Chunk, aligner: Aligner, some: list[tuple[int, list[str]]]) -> None:
    """Adds aligned parts to their documents."""
    good, of, linked, groups = aligner.align([p for _, p in some])
    for k, (doc, _) in enumerate(some):
        if not good[k]:
            chunk.bad[doc] = True
            continue
        for name in ("n_a", "n_b", "n_groups"):
            chunk.of[name][doc] += int(of[name][k])
        # every token has a byte, so one token of each side ends at a common end
        chunk.of["n_links"][doc] += int(of["n_groups"][k])
        if chunk.sha[doc] is None:
            chunk.sha[doc] = hashlib.sha256()
        else:
            chunk.sha[doc].update(b";")
        chunk.sha[doc].update(groups[k])
    owner = pa.array([doc for doc, _ in some], pa.int64())
    pair = (linked["id_a"].to_numpy().astype(np.int64) << 32) | linked["id_b"].to_numpy()
    counted = pa.table({"doc": owner.take(linked["part"].combine_chunks()), "pair": pair}).group_by(
        ["doc", "pair"], use_threads=False
    ).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "times"])
    chunk.tables.append(counted)
    chunk.size += len(counted)


def _pair_rows(packed: DataFrame) -> DataFrame:
    """(chunk, number in the chunk, pair, links) of all chunks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, pairs, n in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                pairs, n = np.frombuffer(pairs, "<i8"), np.frombuffer(n, "<i8")
                for i in range(0, len(pairs), 50_000):
                    some = pairs[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), chunk, np.int64)),
                            pa.array(np.arange(i, i + len(some), dtype=np.int32)),
                            pa.array(some),
                            pa.array(n[i : i + 50_000]),
                        ],
                        ["chunk", "at", "pair", "n"],
                    )

    return packed.select("chunk", "pairs", "n").mapInArrow(
        unpack, "chunk bigint, at int, pair bigint, n bigint"
    )


def pair_counts(packed: DataFrame) -> DataFrame:
    """(pair, c, best): links of an id pair over all chunks, and whether no other A id has
    more links with the same B id."""
    counted = _pair_rows(packed).groupBy("pair").agg(F.sum("n").alias("c"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counted.withColumn("best", F.col("c") == F.max("c").over(same_b))


def align(
    docs: DataFrame, tokenizer_json: str, model: bytes, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    packed = materialize(chunks(docs, tokenizer_json, model, doc_id, text), "align-chunks")
    counts = materialize(pair_counts(packed), "align-counts")
    answers = _pair_rows(packed).drop("n").join(counts, "pair").drop("pair")
    kind = docs.schema[doc_id].dataType.simpleString()

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right["at"].to_numpy()
        c, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        c[at], best[at] = right["c"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        out = []
        for r in left.to_pylist():  # one row
            rows, times = np.frombuffer(r["rows"], "<i8"), from_planes(r["times"])
            cut = np.concatenate([[0], np.cumsum(rows)])
            run = np.cumsum(from_planes(r["number"]))
            base = np.concatenate([[0], run])[cut[:-1]]
            number = run - np.repeat(base, rows)

            def per_document(x, cut=cut):
                total = np.concatenate([[0], np.cumsum(x)])
                return total[cut[1:]] - total[cut[:-1]]

            out.append(pa.table({
                "doc_id": pa.array(r["doc_ids"], left.schema.field("doc_ids").type.value_type),
                **{k: pa.array(r[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")},
                "n_best": per_document(times * best[number]),
                "count_sum": per_document(times * c[number]),
                "groups_sha256": pa.array(r["sha"], pa.string()),
            }))
        return pa.concat_tables(out)

    return (
        packed.drop("pairs", "n")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(finish, RESULT.format(id=kind))
    )


def read_model(name: str) -> bytes:
    """A SentencePiece file, read by the driver and sent to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op13_alignment(
    spark: SparkSession, sf_dir: str, a: str = TOKENIZER_A, b: str = MODEL_B
) -> DataFrame:
    """Alignment of both vocabularies over every whole text."""
    return align(table(spark, sf_dir, "documents"), read_tokenizer(a), read_model(b))
