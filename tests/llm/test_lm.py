import collections
import math
import zlib

import llm_tables as T
import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import lattice, lm
from basketry.llm.common import id_remainder

SF = "/root/testdata/sf0.001"
WORDS = ["▁the", "▁thing", "▁é☃a", "▁", "▁x\x00y", "▁ationing"]


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load_vocabulary()


def segmentations(v, lattices, s):
    ids = {p: i for i, p in enumerate(v.pieces) if v.usable[i]}

    def walk(i):
        if i == len(s):
            yield []
            return
        for j in range(i + 1, min(len(s), i + v.longest) + 1):
            if s[i:j] in ids:
                for rest in walk(j):
                    yield [ids[s[i:j]], *rest]
            elif j == i + 1:
                for rest in walk(j):
                    yield lattices.spelling(s[i:j]) + rest

    return list(walk(0))


def test_forward_sums_all_segmentations(vocabulary):
    w = lm.first_weights(vocabulary)
    assert abs(np.exp(w[np.isfinite(w)]).sum() - 1) < 1e-9
    lattices = lm.Lattices(vocabulary, w)
    for word, p in zip(WORDS, lattices.log_probabilities(WORDS)):
        every = [w[x].sum() for x in segmentations(vocabulary, lattices, word)]
        assert abs(np.logaddexp.reduce(every) - p) < 1e-9


def test_expected_counts(vocabulary):
    w = lm.first_weights(vocabulary)
    lattices = lm.Lattices(vocabulary, w)
    counts = np.arange(1.0, len(WORDS) + 1)
    want = np.zeros(len(w))
    for word, n in zip(WORDS, counts):
        paths = segmentations(vocabulary, lattices, word)
        z = np.array([w[x].sum() for x in paths])
        for path, p in zip(paths, np.exp(z - np.logaddexp.reduce(z))):
            np.add.at(want, path, n * p)
    assert np.allclose(lattices.expected(WORDS, counts), want)


def plain_base(rows):
    """Base scores by counting tokens; rows are (id, text, held out)."""
    tokens = [(i, [*lm.words(t), None], h) for i, t, h in rows]
    seen = collections.Counter(w for _, ws, h in tokens if not h for w in ws)
    n, v = sum(seen.values()), len(seen)
    return n, [
        (i, len(ws), sum(seen[w] > 0 for w in ws),
         sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws, _ in tokens
    ]


def compare(got, rows):
    n, want = plain_base(rows)
    got = sorted(got, key=lambda r: (r.doc_id, r.n_tokens))
    assert len(got) == len(want)
    for r, (i, tokens, known, base) in zip(got, sorted(want)):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_query_against_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_CHARS", 40_000)  # several chunks a task
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in docs]
    got = lm.op10_lm_score(spark, SF).collect()
    compare(got, rows)
    assert {r.doc_id for r in got if r.held_out} == {i for i, _, h in rows if h}


def test_text_score_is_the_product_of_its_words(spark, vocabulary):
    docs = T.plain(spark, ["the thing", "the", "thing", "", "The\tTHE the"])
    docs = docs.withColumn("held_out", F.lit(False))
    s = {r.doc_id: r.score for r in lm.score(docs, vocabulary).collect()}
    assert s[0] + s[3] == pytest.approx(s[1] + s[2])
    assert s[4] - s[3] == pytest.approx(3 * (s[1] - s[3]))


def test_learning_raises_the_score_of_what_was_seen(spark, vocabulary):
    def mean(training):
        docs = T.plain(spark, ["zuke itpf teach"] + training)
        docs = docs.withColumn("held_out", F.col("doc_id") == 0)
        return next(r.score for r in lm.score(docs, vocabulary).collect() if r.doc_id == 0)

    assert mean(["zuke itpf itpf teach zuke"] * 200) > mean(["completely other words"] * 200)


def test_awkward_rows(spark, vocabulary):
    docs = T.documents(spark).withColumn("held_out", id_remainder("doc_id", 7) == 2)
    rows = [(r.doc_id, r.text, r.held_out) for r in docs.collect()]
    compare(lm.score(docs, vocabulary).collect(), rows)
    nothing = T.empty(spark).withColumn("held_out", F.lit(False))
    assert lm.score(nothing, vocabulary).count() == 0
    untrained = lm.score(docs.withColumn("held_out", F.lit(True)), vocabulary).collect()
    assert {r.train_tokens for r in untrained} == {0} and {r.n_known for r in untrained} == {0}
