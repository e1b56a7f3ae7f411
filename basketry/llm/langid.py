"""Language identification with hyperdimensional n-gram profiles.

Every letter owns a random vector of +1/-1 (seeded by its code point, so any script is
covered without a fitted alphabet). An n-gram binds its letters' vectors, each permuted
by its place: ``roll(a, 2) * roll(b, 1) * c``. A text bundles (adds) the vectors of all
its trigrams; a language prototype bundles all its training texts. A text gets the
language with the largest cosine.

Case folding: letters are lower-cased, every run of other characters is one boundary
symbol. Bundles are whole numbers, so the sums do not depend on the order of rows.

Plan: training is one pass that sums per task before it shuffles (languages x DIM
longs a task); only the prototypes come to the driver (DIM longs per distinct label).
Prediction is one narrow pass without a shuffle.

Defined results: null text, empty text or text without a letter -> ``und``, score 0.
Rows with a null label or null text are not learned from. Without any learned label
every text is ``und``. Ties go to the smaller label. Repeated rows are repeated in the
output; extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import ARROW_ROWS, arrow_rows, blocks, id_remainder, table, tidied

DIM = 1024
SEED = 20_011
UNKNOWN = "und"
# ``keep_languages`` drops a document whose cosine with every language is under LEAST_SCORE,
# the level of unrelated vectors (deviation 1 / sqrt(DIM) = 0.031 at every length), but only
# from LEAST_TRIGRAMS different trigrams on: shorter clean texts can be at that level too
LEAST_SCORE = 0.05
LEAST_TRIGRAMS = 60
SLICE_ROWS = 500  # rows whose vectors are held in memory at once
# a label set larger than this is no list of languages; prototypes must stay small
MAX_LABELS = 4096
_BLOCK_CELLS = 4_000_000
_BLOCK_CHARS = 1 << 20  # characters whose n-grams are held in memory at once

_letters: dict[int, np.ndarray] = {}
_folds: list[np.ndarray] = []


def letter_vector(code: int) -> np.ndarray:
    """The +1/-1 vector of a letter; 0 is the boundary symbol."""
    if code not in _letters:
        rng = np.random.default_rng([SEED, code])
        _letters[code] = (rng.integers(0, 2, DIM) * 2 - 1).astype(np.int8)
    return _letters[code]


def _folded(codes: np.ndarray) -> np.ndarray:
    """Lower-case letter code of each code point, 0 for anything but a letter."""
    if not _folds:
        _folds.append(np.full(0x110000, -1, dtype=np.int32))
    fold = _folds[0]
    out = fold[codes]
    if (out < 0).any():
        for c in np.unique(codes[out < 0]).tolist():
            ch = chr(c)
            fold[c] = ord(ch.lower()[0]) if ch.isalpha() else 0
        out = fold[codes]
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram number) of each trigram, and the letter codes of each gram (g x 3)."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), "<u4")
    rows = np.concatenate([[0], np.repeat(np.arange(len(texts)), sizes + 1)])
    sym = _folded(codes)
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    sym, rows = sym[keep], rows[keep]
    alphabet = np.unique(np.concatenate([[0], sym]))
    k = len(alphabet)
    place = np.zeros(int(alphabet[-1]) + 1, np.int64)
    place[alphabet] = np.arange(k)
    s = place[sym]
    code = (s[:-2] * k + s[1:-1]) * k + s[2:]
    inner = s[1:-1] != 0
    code, row = code[inner], rows[1:-1][inner]
    if k**3 <= 1 << 22:
        grams = np.flatnonzero(np.bincount(code, minlength=1))
        number = np.zeros(k**3, np.int64)
        number[grams] = np.arange(len(grams))
        gram = number[code]
    else:
        grams, gram = np.unique(code, return_inverse=True)
    return row, gram, alphabet[np.stack([grams // (k * k), grams // k % k, grams % k], 1)]


def _cut(text: str) -> Iterator[str]:
    """A long text in pieces that end with a space, where no trigram is lost."""
    start = 0
    while len(text) - start > _BLOCK_CHARS:
        end = text.find(" ", start + _BLOCK_CHARS) + 1
        if not end:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices of SLICE_ROWS, whatever Spark puts into a batch: a row is DIM
    numbers, a few times over."""
    for b in batches:
        for i in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(i, SLICE_ROWS)


def bundle(texts: list[str]) -> np.ndarray:
    """Bundled trigram vectors, one row per text (zero for texts without letters)."""
    out = np.zeros((len(texts), DIM), np.float64)
    for i, j in blocks([len(t) for t in texts], _BLOCK_CHARS):
        if j == i + 1:
            for piece in _cut(texts[i]):
                out[i] += _bundle([piece])[0]
        else:
            out[i:j] = _bundle(texts[i:j])
    return out


def _bundle(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), DIM), np.float64)
    row, gram, letters = trigrams(texts)
    if not len(row):
        return out
    order = np.argsort(row, kind="stable")
    row, gram = row[order], gram[order]
    for g0 in range(0, len(letters), 4096):
        some = letters[g0 : g0 + 4096]
        used, at = np.unique(some, return_inverse=True)
        base = np.stack([letter_vector(c) for c in used.tolist()])
        at = at.reshape(some.shape)
        bound = np.roll(base, 2, 1)[at[:, 0]] * np.roll(base, 1, 1)[at[:, 1]] * base[at[:, 2]]
        bound = bound.astype(np.float32)
        step = max(1, _BLOCK_CELLS // len(some))
        for r0 in range(0, len(texts), step):
            lo, hi = np.searchsorted(row, [r0, r0 + step])
            g = gram[lo:hi] - g0
            mine = (g >= 0) & (g < len(some))
            n = min(step, len(texts) - r0)
            cell = (row[lo:hi][mine] - r0) * len(some) + g[mine]
            counts = np.bincount(cell, minlength=n * len(some)).reshape(n, len(some))
            out[r0 : r0 + n] += counts.astype(np.float32) @ bound
    return out


def _many_trigrams(text: str) -> bool:
    """Whether the text has at least LEAST_TRIGRAMS different trigrams."""
    found: set[tuple[int, ...]] = set()
    for piece in _cut(text):
        found.update(map(tuple, trigrams([piece])[2].tolist()))
        if len(found) >= LEAST_TRIGRAMS:
            return True
    return False


def train(labelled: DataFrame, text: str = "text", label: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of every label: the sum of its texts' bundles."""
    rows = labelled.select(F.col(text).alias("t"), F.col(label).alias("l")).where(
        "t IS NOT NULL AND l IS NOT NULL"
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in _slices(batches):
            labels = np.asarray(b.column("l").to_pylist(), dtype=object)
            vectors = bundle(b.column("t").to_pylist())
            for one in set(labels.tolist()):
                v = np.rint(vectors[labels == one].sum(0)).astype(np.int64)
                total[one] = total.get(one, 0) + v
        for one, v in total.items():
            yield pa.RecordBatch.from_pydict({"l": [one], "v": [v.tolist()]})

    summed = (
        rows.mapInArrow(tidied(sums), "l string, v array<bigint>")
        .select("l", F.posexplode("v").alias("d", "x"))
        .groupBy("l", "d")
        .agg(F.sum("x").alias("x"))
        .groupBy("l")
        .agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("v"))
        .orderBy("l")
    )
    with arrow_rows(labelled.sparkSession, ARROW_ROWS):
        found = summed.limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: not a list of languages")
    return {r["l"]: np.array([p["x"] for p in r["v"]], np.float64) for r in found}


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score (cosine with the winning prototype, 0 to 1)."""
    names = sorted(prototypes)
    unit = [prototypes[n] / max(1e-12, float(np.linalg.norm(prototypes[n]))) for n in names]
    matrix = np.stack(unit).T if unit else np.zeros((DIM, 0))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            vectors = bundle([t or "" for t in b.column("t").to_pylist()])
            size = np.sqrt((vectors * vectors).sum(1))
            known = (size > 0) & bool(names)
            best, score = np.zeros(len(size), int), np.zeros(len(size))
            if names:
                cosine = (vectors @ matrix) / np.maximum(size, 1e-12)[:, None]
                best = cosine.argmax(1)
                score = np.where(known, np.clip(cosine.max(1), 0, 1), 0.0)
            said = [names[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(said, pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(tidied(label), f"doc_id {kind}, lang_pred string, score double")


def keep_languages(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    least: float = LEAST_SCORE,
    text: str = "text",
) -> DataFrame:
    """``docs`` without the documents in no language: no letter, or at least LEAST_TRIGRAMS
    different trigrams and a cosine under ``least`` with every prototype. Without any
    prototype nothing speaks against a document with a letter. Columns are unchanged."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] / max(1e-12, float(np.linalg.norm(prototypes[n]))) for n in names]
                      or [np.zeros(DIM)]).T

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            at = b.schema.get_field_index(text)
            texts = [t or "" for t in b.column(at).to_pylist()]
            vectors = bundle(texts)
            size = np.sqrt((vectors * vectors).sum(1))
            cosine = (vectors @ matrix) / np.maximum(size, 1e-12)[:, None]
            stays = size > 0
            if names:
                for i in np.flatnonzero(stays & (cosine.max(1) < least)).tolist():
                    stays[i] = not _many_trigrams(texts[i])
            yield b.filter(pa.array(stays))

    return docs.mapInArrow(tidied(keep), docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    prototypes = train(docs.where(id_remainder("doc_id", 5) != 0))
    return predict(docs, prototypes).select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"
    )
