"""Language-model scores: marginal likelihood over all subword segmentations.

The model is a unigram over pieces: an existing vocabulary's scores give the first
weights, one round of expectation-maximisation over the training words (every
segmentation of a word counts with its posterior) fits them to the corpus. A word's
probability is the sum over all its segmentations, by forward recursion in log space on
its piece lattice; a text's is the product over its words and one end token. Pieces never
run over a space, so the text's lattice is exactly the chain of its words' lattices.

Beside it stands the plain word unigram with add-one smoothing (``base_score``).

Plan, all of it linear in the corpus:

1. ``chunks``: a pass over the documents where they lie; each task writes chunks of about
   CHUNK_CHARS characters as one row: the distinct words, their training counts, and the
   documents as (word number, count) pairs. The table is in the shared checkpoint folder.
2. words of all chunks -> counts per word (a chunk sends a word once, so a frequent word
   is a row per chunk), written as a table; expected piece counts are summed per task
   before they are shuffled; only piece counts (vocabulary-sized) reach the driver.
3. every distinct word gets its lattice probability once; word rows are joined back to
   the chunks' words (two plain shuffles, so a hot word's partition can be split) and
   grouped by chunk, which scores its documents.

Defined results: null text = empty text: the end token alone. Characters without a
piece are spelled in byte pieces. Repeated rows count and are scored each. Without
training rows the counts are zero and the first weights stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import blocks, id_remainder, materialize, table
from basketry.llm.lattice import DEFAULT_MODEL, SPACE, Matcher, Vocabulary, code_points
from basketry.llm.lattice import load_vocabulary

CHUNK_CHARS = 16_000_000
BLOCK_CHARS = 300_000
_UPPER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, cut at ASCII white space."""
    return (text or "").encode().translate(_UPPER).split()


def first_weights(v: Vocabulary) -> np.ndarray:
    """Log probabilities of pieces from the vocabulary's scores.

    Scores that are ranks (merge vocabularies) become a Zipf law; log probabilities are
    normalised. Byte pieces share the weight of the last rank; others have none.
    """
    usable = np.flatnonzero(v.usable)
    out = np.full(len(v.pieces), -np.inf)
    if v.bpe:
        rank = np.unique(-v.scores[usable], return_inverse=True)[1]
        out[usable] = -np.log(rank + 2.7)
    else:
        out[usable] = v.scores[usable]
    if v.byte_ids is not None:
        out[v.byte_ids] = out[usable].min()
    elif v.unknown >= 0:
        out[v.unknown] = out[usable].min() - 10
    return out - np.logaddexp.reduce(out[np.isfinite(out)])


class Lattices:
    """Forward (and backward) sums over the lattices of many words."""

    def __init__(self, v: Vocabulary, weights: np.ndarray):
        self.v, self.weights = v, weights
        self.matcher = Matcher(v)

    def _layout(self, some: list[str]) -> tuple:
        """Edges and log weights by (position, length), and words by length."""
        text = code_points("\0".join(some) + "\0")
        size = np.fromiter((len(w) for w in some), np.int64, len(some))
        offset = np.cumsum(size + 1) - size - 1
        edge = self.matcher.sorted_edges(text)
        weight = np.where(edge >= 0, self.weights[edge], -np.inf)
        inside = np.ones(len(edge), bool)
        inside[offset + size] = inside[-1] = False
        for at in np.flatnonzero((edge[:, 1] < 0) & inside).tolist():
            weight[at, 1] = self.weights[self.spelling(chr(text[at]))].sum()
        order = np.argsort(-size, kind="stable")
        return edge, weight, size, offset, order

    def spelling(self, character: str) -> list[int]:
        """Pieces of a character without a piece of its own."""
        if self.v.byte_ids is None:
            return [self.v.unknown]
        return [int(self.v.byte_ids[b]) for b in character.encode()]

    def _forward(self, weight, size, offset, order) -> np.ndarray:
        alpha = np.full(len(weight), -np.inf)
        alpha[offset] = 0.0
        ascending = size[order][::-1]
        for k in range(1, int(size.max(initial=0)) + 1):
            live = len(size) - int(np.searchsorted(ascending, k))
            at = offset[order[:live]] + k
            reach = np.arange(1, min(k, self.matcher.longest) + 1)
            back = at[:, None] - reach
            total = alpha[back] + weight[back, reach]
            top = total.max(1)
            alpha[at] = top + np.log(np.exp(total - top[:, None]).sum(1))
        return alpha

    def log_probabilities(self, some: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for i, j in blocks([len(w) + 1 for w in some], BLOCK_CHARS):
            _, weight, size, offset, order = self._layout(some[i:j])
            out.append(self._forward(weight, size, offset, order)[offset + size])
        return np.concatenate(out)

    def expected(self, some: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected piece counts over all segmentations of counted words."""
        mass = np.zeros(len(self.v.pieces))
        for i, j in blocks([len(w) + 1 for w in some], BLOCK_CHARS):
            edge, weight, size, offset, order = self._layout(some[i:j])
            alpha = self._forward(weight, size, offset, order)
            beta = np.full(len(weight), -np.inf)
            beta[offset + size] = 0.0
            ascending = size[order][::-1]
            for k in range(1, int(size.max(initial=0)) + 1):  # k characters before the end
                live = len(size) - int(np.searchsorted(ascending, k))
                at = (offset + size)[order[:live]] - k
                reach = np.arange(1, min(k, self.matcher.longest) + 1)
                total = beta[at[:, None] + reach] + weight[at[:, None], reach]
                top = total.max(1)
                beta[at] = top + np.log(np.exp(total - top[:, None]).sum(1))
            owner = np.repeat(np.arange(len(size)), size + 1)
            whole, n = alpha[offset + size], counts[i:j]
            start, length = np.nonzero(np.isfinite(weight[: len(owner)]))
            word = owner[start]
            post = alpha[start] + weight[start, length] + beta[start + length] - whole[word]
            part = np.exp(post) * n[word]
            piece = edge[start, length]
            own = piece >= 0
            mass += np.bincount(piece[own], part[own], minlength=len(mass))
            text = code_points("\0".join(some[i:j]) + "\0")
            for at, m in zip(start[~own].tolist(), part[~own].tolist(), strict=True):
                for p in self.spelling(chr(text[at])):
                    mass[p] += m
        return mass


CHUNK = (
    "chunk bigint, words binary, trained binary, doc_ids array<{id}>, held_out array<boolean>, "
    "n_tokens binary, pairs binary, word_of binary, count_of binary"
)


def chunks(docs: DataFrame, doc_id: str, text: str, held_out: str) -> DataFrame:
    """The corpus as chunks of counted words (see the module text)."""
    rows = docs.select(
        F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(held_out).alias("h")
    )
    schema = CHUNK.format(id=rows.schema["i"].dataType.simpleString())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, chars = TaskContext.get().partitionId(), 0, 0
        number: dict[bytes, int] = {}
        trained: list[int] = []
        ids: list = []
        held: list[bool] = []
        tokens: list[int] = []
        pairs: list[int] = []
        word_of: list[np.ndarray] = []
        count_of: list[np.ndarray] = []
        id_type = None

        def row() -> pa.RecordBatch:
            def i32(x):
                return np.asarray(x, "<i4").tobytes()

            values = {
                "chunk": pa.array([(part << 32) + seq], pa.int64()),
                "words": pa.array([b" ".join(number)], pa.binary()),
                "trained": pa.array([np.asarray(trained, "<i8").tobytes()], pa.binary()),
                "doc_ids": pa.array([ids], pa.list_(id_type)),
                "held_out": pa.array([held], pa.list_(pa.bool_())),
                "n_tokens": pa.array([i32(tokens)], pa.binary()),
                "pairs": pa.array([i32(pairs)], pa.binary()),
                "word_of": pa.array([b"".join(a.tobytes() for a in word_of)], pa.binary()),
                "count_of": pa.array([b"".join(a.tobytes() for a in count_of)], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(values)

        for b in batches:
            id_type = b.column("i").type
            for i, t, h in zip(b.column("i"), b.column("t"), b.column("h"), strict=True):
                t, h = t.as_py(), h.as_py()
                found = Counter(words(t))
                which = [number.setdefault(w, len(number)) for w in found]
                n = list(found.values())
                trained += [0] * (len(number) - len(trained))
                if not h:
                    for w, c in zip(which, n, strict=True):
                        trained[w] += c
                ids.append(i.as_py())
                held.append(h)
                tokens.append(sum(n) + 1)
                pairs.append(len(n))
                word_of.append(np.asarray(which, "<i4"))
                count_of.append(np.asarray(n, "<i4"))
                chars += len(t or "")
                if chars >= CHUNK_CHARS:
                    yield row()
                    seq, chars = seq + 1, 0
                    number, trained, ids, held = {}, [], [], []
                    tokens, pairs, word_of, count_of = [], [], [], []
        if ids:
            yield row()

    return rows.mapInArrow(pack, schema)


def _word_rows(packed: DataFrame) -> DataFrame:
    """(chunk, number in the chunk, word, training count) of all chunks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                some = r["words"].split(b" ") if r["words"] else []
                n = np.frombuffer(r["trained"], "<i8")
                for i in range(0, len(some), 50_000):
                    part = some[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), r["chunk"], np.int64)),
                            pa.array(np.arange(i, i + len(part), dtype=np.int32)),
                            pa.array(part, pa.binary()),
                            pa.array(n[i : i + len(part)]),
                        ],
                        ["chunk", "at", "word", "n"],
                    )

    return packed.select("chunk", "words", "trained").mapInArrow(
        unpack, "chunk bigint, at int, word binary, n bigint"
    )


def fit(counted: DataFrame, v: Vocabulary, train_docs: int) -> tuple[np.ndarray, float]:
    """Piece log weights after one EM round over the counted words, and that of the end."""
    start = first_weights(v)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices, mass = Lattices(v, start), np.zeros(len(v.pieces))
        for b in batches:
            some = [SPACE + w.as_py().decode("utf-8", "replace") for w in b.column("word")]
            mass += lattices.expected(some, b.column("c").to_numpy().astype(float))
        at = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(mass[at])], ["piece", "mass"])

    mass = np.zeros(len(v.pieces))
    summed = (
        counted.where("c > 0").select("word", "c").mapInArrow(expect, "piece bigint, mass double")
    )
    # a row per piece of the vocabulary
    for r in summed.groupBy("piece").agg(F.sum("mass").alias("mass")).collect():
        mass[r["piece"]] = r["mass"]
    # the first weights stay as a prior worth one count per piece
    prior = np.exp(start) * np.isfinite(start).sum()
    total = mass.sum() + prior.sum() + train_docs + 1
    with np.errstate(divide="ignore"):
        return np.log(mass + prior) - np.log(total), float(np.log((train_docs + 1) / total))


def score(
    docs: DataFrame,
    v: Vocabulary,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: str = "held_out",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)
    of every row; rows that are not ``held_out`` are learned from."""
    packed = materialize(chunks(docs, doc_id, text, held_out), "lm-chunks")
    rows = _word_rows(packed)
    counted = materialize(rows.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    size = counted.where("c > 0").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_docs = (
        packed.select(F.sum(F.size(F.filter("held_out", lambda h: ~h))).alias("d")).first()["d"] or 0
    )
    n = (size["n"] or 0) + train_docs
    types = size["v"] + (train_docs > 0)
    weights, end = fit(counted, v, train_docs)

    def lattice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(v, weights)
        for b in batches:
            some = [SPACE + w.as_py().decode("utf-8", "replace") for w in b.column("word")]
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), b.column("c"), pa.array(lattices.log_probabilities(some))],
                ["word", "c", "lp"],
            )

    scored = materialize(
        counted.mapInArrow(lattice, "word binary, c bigint, lp double"), "lm-scored"
    )
    answers = rows.select("chunk", "at", "word").join(scored, "word").select("chunk", "at", "c", "lp")
    kind = docs.schema[doc_id].dataType.simpleString()
    base_floor = np.log10(n + types + 1)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        at = right.column("at").to_numpy()
        c, lp = np.zeros(len(at), np.int64), np.zeros(len(at))
        c[at], lp[at] = right.column("c").to_numpy(), right.column("lp").to_numpy()
        known, base = (c > 0).astype(np.int64), np.log10(c + 1.0) - base_floor
        for r in left.to_pylist():
            pairs = np.frombuffer(r["pairs"], "<i4")
            which, times = np.frombuffer(r["word_of"], "<i4"), np.frombuffer(r["count_of"], "<i4")
            doc = np.repeat(np.arange(len(pairs)), pairs)

            def total(x, doc=doc, which=which, times=times, m=len(pairs)):
                return np.bincount(doc, x[which] * times, minlength=m)

            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(r["doc_ids"], left.schema.field("doc_ids").type.value_type),
                        "held_out": pa.array(r["held_out"], pa.bool_()),
                        "n_tokens": np.frombuffer(r["n_tokens"], "<i4").astype(np.int64),
                        "n_known": np.rint(total(known)).astype(np.int64) + int(train_docs > 0),
                        "train_tokens": np.full(len(pairs), n, np.int64),
                        "base_score": total(base) + np.log10(train_docs + 1) - base_floor,
                        "score": (total(lp) + end) / np.log(10),
                    }
                )
            )
        return pa.concat_tables(out)

    return (
        packed.drop("words", "trained")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            finish,
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double",
        )
    )


def op10_lm_score(spark: SparkSession, sf_dir: str, model: str = DEFAULT_MODEL) -> DataFrame:
    """Score of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_remainder("doc_id", 7) == 2)
    return score(docs, load_vocabulary(model))
