import llm_tables as T
import numpy as np

from basketry.llm import langid

SF = "/root/testdata/sf0.001"


def by_hand(text):
    """Bundle of a text, one trigram at a time."""
    symbols = [0]
    for ch in text:
        code = ord(ch.lower()[0]) if ch.isalpha() else 0
        if code or symbols[-1]:
            symbols.append(code)
    symbols.append(0)
    total = np.zeros(langid.DIM)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        if b:
            va, vb, vc = (langid.letter_vector(x).astype(int) for x in (a, b, c))
            total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def test_bundle_is_the_sum_of_bound_trigrams(monkeypatch):
    texts = ["The fox!", "", "über  Öl 12 x", "a", "..", "中文 ab"]
    assert (langid.bundle(texts) == np.stack([by_hand(t) for t in texts])).all()
    monkeypatch.setattr(langid, "_BLOCK_CHARS", 10)  # long texts are cut at spaces
    text = "one two three four five"
    assert (langid.bundle([text])[0] == by_hand(text)).all()


def test_held_out_accuracy(spark):
    got = langid.op7_language_id(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs)
    held = both[both.held_out]
    assert len(held) and (held.lang == held.lang_pred).mean() >= 0.97
    assert both.score.between(0, 1).all()


def test_awkward_rows(spark):
    docs = T.documents(spark)
    prototypes = langid.train(docs)
    assert sorted(prototypes) == ["de", "en"]
    got = langid.predict(docs, prototypes).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for i in (3, 4, 5, 7):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    kept = langid.keep_languages(docs, prototypes)
    assert kept.columns == docs.columns
    assert not {3, 4, 5, 7} & {r.doc_id for r in kept.collect()}


def test_nothing_learned_and_empty(spark):
    got = langid.predict(T.documents(spark), langid.train(T.empty(spark))).collect()
    assert {r.lang_pred for r in got} == {"und"}
    assert langid.predict(T.empty(spark), {}).count() == 0
    assert langid.keep_languages(T.empty(spark), {}).count() == 0


def test_short_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    prototypes = langid.train(docs)
    words = sorted({w for r in docs.collect() for w in (r.text or "").split()} | {"Avec.", "A."})
    one = [w for w in words if any(c.isalpha() for c in w)]
    vectors = langid.bundle(one)
    unit = np.stack([p / np.linalg.norm(p) for p in prototypes.values()])
    cosine = (vectors @ unit.T).max(1) / np.linalg.norm(vectors, axis=1)
    assert (cosine < langid.LEAST_SCORE).any()
    one.append(" ".join(["Hm."] * 500))  # long, but of three trigrams
    other = "".join(chr(0x4E00 + 7 * i) for i in range(300))  # in no learned language
    kept = langid.keep_languages(T.plain(spark, [*one, other, "12 !", None]), prototypes)
    assert sorted(r.text for r in kept.collect()) == sorted(one)
    kept = langid.keep_languages(T.plain(spark, ["Avec.", other, "12 !"]), {})
    assert sorted(r.text for r in kept.collect()) == sorted(["Avec.", other])
