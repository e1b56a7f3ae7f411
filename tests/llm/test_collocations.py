import collections
import pathlib
import re

import duckdb
import llm_tables as T
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import collocations as co

SF = "/root/testdata/sf0.01"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, least, top=2000, longest=5):
    """The contract by counting every phrase; rows are (text, lang)."""
    f = collections.Counter()
    n = collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", fold(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = [(lang, p) for (lang, p), a in f.items() if len(p) > 1 and a >= least]
    out = collections.defaultdict(list)
    for lang, p in candidates:
        a = f[lang, p]
        if any(
            x == lang and len(q) > len(p) and 100 * f[x, q] >= 100 * a
            and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for x, q in candidates
        ):
            continue
        score, k = min(
            (1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))
        )
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -score)
        for lang, some in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(some)[:top], 1)
    )


def compare(docs, least, **more):
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    got = co.collocations(docs, least, **more)
    assert [d for _, d in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(map(tuple, got.collect())) == plain(rows, least, **more)


TEXTS = [
    ("The big cat. the big cat, the BIG dog! a b a b a b a b", "en"),
    ("the big cat\vthe big\tcat\rsat; on the mat: the mat?", "en"),
    ("the big cat the big cat", None), ("the big cat the big cat", "und"), (None, "en"), ("", None),
    ("a a a a a a a a", "de"), ("le chat é\x00 le chat é\x00 le chat", "fr"), (" . , ; ", "fr"),
    ("das Haus ist groß " * 4, "de"), (" x y  x y", "en"), ("x y x y", "en"),
]


def test_against_counting(spark):
    docs = spark.createDataFrame(TEXTS * 2, "text string, lang string").repartition(3)
    for least in (2, 3, 5):
        compare(docs, least)
    compare(docs, 2, top=3)
    compare(docs, 2, longest=3)


def test_awkward_table(spark):
    compare(T.documents(spark), 4)
    assert co.collocations(T.empty(spark)).collect() == []


def test_chunks_and_slices_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "CHUNK_CHARS", 60)
    monkeypatch.setattr(co, "SLICE_CHARS", 11)
    monkeypatch.setattr(co, "BLOCK_BYTES", 50)
    docs = spark.createDataFrame(TEXTS * 3, "text string, lang string").repartition(3)
    assert co.occurrences(docs).count() > 9
    compare(docs, 3)


def test_slices_end_at_white_space():
    text = "one two\tthree\nfour fivesixseven eight"
    some = list(co.slices(text, 9))
    assert "".join(some) == text and len(some) > 3
    assert all(s[-1] in " \t\n" for s in some[:-1])
    assert list(co.slices("x" * 50, 9)) == ["x" * 50]


def test_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000
    rows = spark.createDataFrame([(big, big - 1, 3 * big)], "a long, l long, n long")
    top = co._wide("a") * co._wide("n") * 1000
    from pyspark.sql import functions as F

    got = rows.select(F.call_function("div", top, co._wide("l") * co._wide("l")).alias("s")).first().s
    assert got == 1000 * big * 3 * big // (big - 1) ** 2


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aAb .\t\n,é", max_size=40), st.sampled_from(["en", None])), min_size=1, max_size=12))
def test_random_texts(spark, rows):
    compare(spark.createDataFrame(rows, "text string, lang string"), 2)


def test_query_against_sql(spark):
    got = sorted(map(tuple, co.op11_collocations(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.execute(co.ORACLE_SQL).fetchall()) and len(got) > 50


def rare_and_frequent(spark):
    texts = [f"the big cat {' '.join(f'w{i * j % 40}' for j in range(200))}" for i in range(60)]
    return spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(3)


def test_rare_phrases_are_not_shuffled(spark):
    docs = rare_and_frequent(spark)
    words = co.materialize(co.occurrences(docs), "words")
    names = co.packed_names(co.frequent(co._word_rows(words), ["lang", "word"], 50))
    assert names.count() <= 9 and sum(len(r.found) for r in names.collect()) == 43
    relation = co.materialize(co.extend(words, names), "relation")
    every = sum(len(r.n) // 4 for r in relation.select("n").collect())
    rows = co._phrase_rows(relation, 50, co.slot_count(60 * 203))
    assert rows.count() < every // 3
    pairs = collections.Counter(
        p for r in docs.collect() for p in zip(r.text.split(), r.text.split()[1:], strict=False)
    )
    kept = co.frequent(rows, ["left", "right"], 50).where("first").select("a").collect()
    assert sorted(r.a for r in kept) == sorted(n for n in pairs.values() if n >= 50)


def test_crowded_slots_change_nothing(spark, monkeypatch):
    for most in (16, 64, 1 << 20):
        monkeypatch.setattr(co, "LEAST_SLOTS", 16)
        monkeypatch.setattr(co, "MOST_SLOTS", most)
        monkeypatch.setattr(co, "RANGE_SLOTS", 16)
        monkeypatch.setattr(co, "PACK_ROWS", 10)
        compare(spark.createDataFrame(TEXTS * 2, "text string, lang string").repartition(3), 3)


def test_used_tables_are_deleted(spark):
    root = co.materialize(spark.range(1), "phrases-root").inputFiles()[0].split("/phrases-root")[0]
    before = {p.name for p in pathlib.Path(root.removeprefix("file:")).iterdir()}
    levels, totals = co.mine(rare_and_frequent(spark), 50)
    kept = {p.name for p in pathlib.Path(root.removeprefix("file:")).iterdir()} - before
    assert {x.rsplit("-", 1)[0] for x in kept} == {"phrases-level", "phrases-totals"}
    assert all(df.count() for df in [*levels[:2], totals])
