import random

import llm_tables as T
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_format

from basketry.llm import lattice, spm

SF = "/root/testdata/sf0.001"


def awkward_texts():
    rnd = random.Random(5)
    parts = ["the", "in", " ", "  ", "\n", "a", "é", "中", "☃", "ing", "0", ".", "er", "\r", "\x00",
             "▁", "T", "--", "\n\n", " \n"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return [*out, "", " ", "   ", "a", "\x00", "\n", "x" * 300 + " " + "the" * 90, "of.\nThe", T.LONG]


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """The same pieces read as a unigram vocabulary."""
    model = model_format.ModelProto()
    with open(lattice.DEFAULT_MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.score < -1e8:
            p.score = -40_000
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def split(ids, counts):
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_ids_of_the_merge_vocabulary():
    texts = awkward_texts()
    own = sentencepiece.SentencePieceProcessor(model_file=lattice.DEFAULT_MODEL)
    v = lattice.load_vocabulary()
    ids, counts = spm.TextEncoder(v).encode(texts)
    assert split(ids, counts) == own.encode(texts)
    back = spm.Decoder(v).decode(ids, counts)
    assert back == [t.replace("▁", " ") for t in texts]


def test_long_units_use_the_heap(monkeypatch):
    texts = awkward_texts()[:200]
    own = sentencepiece.SentencePieceProcessor(model_file=lattice.DEFAULT_MODEL)
    monkeypatch.setattr(spm, "LONG", 3)
    monkeypatch.setattr(spm, "BLOCK_CHARS", 100)
    ids, counts = spm.TextEncoder(lattice.load_vocabulary()).encode(texts)
    assert split(ids, counts) == own.encode(texts)


def test_best_path_of_the_unigram_vocabulary(unigram_path):
    texts = awkward_texts()[:400]
    v = lattice.load_vocabulary(unigram_path)
    own = sentencepiece.SentencePieceProcessor(model_file=unigram_path)
    encoder = spm.TextEncoder(v)
    for t in texts:
        ids, _ = encoder.encode([t])
        want = own.encode(t)
        mine, best = v.scores[ids].sum(), v.scores[want].sum()
        assert ids.tolist() == want or abs(mine - best) <= 1e-5 * abs(best)


def test_matcher_finds_every_occurrence():
    v = lattice.load_vocabulary()
    text = "▁the▁thing\0▁no ing é\0"
    start, size, piece = lattice.Matcher(v).edges(lattice.code_points(text))
    found = set(zip(start.tolist(), size.tolist(), piece.tolist()))
    want = set()
    for i, p in enumerate(v.pieces):
        if v.usable[i]:
            at = text.find(p)
            while at >= 0:
                want.add((at, len(p), i))
                at = text.find(p, at + 1)
    assert found == want


def test_operators_and_awkward_rows(spark):
    docs = T.documents(spark)
    v = lattice.load_vocabulary()
    own = sentencepiece.SentencePieceProcessor(model_file=lattice.DEFAULT_MODEL)
    rows = spm.decode(spm.encode(docs, v), v).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.token_ids == own.encode(r.text or "")
        assert r.decoded == (r.text or "").replace("▁", " ")
        assert (r.t, r.hits) == ("t", "h")
    digests = spm.encode_digest(docs, v).collect()
    assert {r.doc_id for r in digests if not r.round_trip} == {12}
    assert spm.encode(T.empty(spark), v).count() == 0
    assert spm.encode_digest(T.empty(spark), v).count() == 0


def test_query_gives_texts_back(spark):
    got = spm.op9_sentencepiece(spark, SF).toPandas()
    assert got.round_trip.all() and (got.n_tokens >= 0).all()


def test_a_large_batch_is_encoded_in_small_blocks():
    """Before, all texts of a batch were strings at once and 2 MB of them were encoded
    together: 122 MB at the peak here, now 24."""
    import tracemalloc

    import pyarrow as pa

    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rnd.choices(words, k=1500)) for _ in range(40)] * 100
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"]
    )
    columns = ["doc_id", "n_tokens", "ids_sha256", "round_trip", "token_ids"]
    run = spm.digest_batches(lattice.load_vocabulary(), columns, True)
    tracemalloc.start()
    first = next(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 1 < first.num_rows < 100 and all(first["round_trip"].to_pylist())
    assert peak < 60e6
