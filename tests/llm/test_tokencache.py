import os

import llm_tables as T
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import tokencache as tc

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer_json():
    return tc.read_tokenizer(tc.TOKENIZER)


@pytest.fixture(scope="module")
def library(tokenizer_json):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer_json)


def plain(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


ODD = [
    "H̱ and ẖ ẖ T̈", "İ İ i", "A <|endoftext|> B", "<|ENDOFTEXT|> x <|StartOfText|>",
    "a b c\u0085d", " ́abc  ́", "it's IT'S we'LL", "a\x0b\x0cb\x1cc\x00d", "<| endoftext|>", "ＡＢＣ ſt",
]


def test_counts_equal_the_library(spark, tokenizer_json, library, tmp_path):
    docs = T.documents(spark)
    odd = T.plain(spark, ODD, [100 + i for i in range(len(ODD))])
    docs = docs.unionByName(odd, allowMissingColumns=True)
    got = tc.count_tokens(docs, tokenizer_json, str(tmp_path), limit=100).collect()
    want = [
        (r.doc_id, len((r.text or "").encode()), n := plain(library, r.text), n > 100)
        for r in docs.collect()
    ]
    assert sorted(map(tuple, got)) == sorted(want)


def test_cache_holds_each_form_once_and_only_misses_are_encoded(spark, tokenizer_json, tmp_path):
    texts = ["The cat", "the  CAT\n", "the cat", None, "", "a dog"]
    first = tc.count_tokens(T.plain(spark, texts), tokenizer_json, str(tmp_path))
    stored = tc.stored_counts(spark, str(tmp_path), tokenizer_json)
    assert first.count() == 6
    assert stored.count() == 3  # the cat, a dog, nothing
    # a stored count is used as it is, a new text is added
    again = tc.count_tokens(T.plain(spark, ["THE cat", "new words"]), tokenizer_json, str(tmp_path))
    assert sorted(r.n_tokens for r in again.collect()) == [2, 2]
    assert tc.stored_counts(spark, str(tmp_path), tokenizer_json).count() == 4
    digest = F.unhex(F.sha2(F.lit("never seen"), 256)).alias("digest")
    path = tc._folder(str(tmp_path), tokenizer_json)
    spark.range(1).select(digest, F.lit(99).cast("long").alias("n_tokens")).write.mode("append").parquet(path)
    seen = tc.count_tokens(T.plain(spark, ["Never\tseen"]), tokenizer_json, str(tmp_path))
    assert [r.n_tokens for r in seen.collect()] == [99]


def test_versions_do_not_mix(spark, tokenizer_json, tmp_path):
    other = tokenizer_json + "\n"
    tc.count_tokens(T.plain(spark, ["one two"]), tokenizer_json, str(tmp_path))
    assert tc.stored_counts(spark, str(tmp_path), other).count() == 0
    tc.count_tokens(T.plain(spark, ["three"]), other, str(tmp_path))
    assert tc.stored_counts(spark, str(tmp_path), tokenizer_json).count() == 1


def test_empty_table_and_null_ids(spark, tokenizer_json, tmp_path):
    assert tc.count_tokens(T.empty(spark), tokenizer_json, str(tmp_path)).collect() == []
    got = tc.count_tokens(T.plain(spark, ["a b", "a b"], [None, None]), tokenizer_json, str(tmp_path))
    assert [tuple(r) for r in got.collect()] == [(None, 3, 2, False)] * 2


def test_units_are_counted_once_and_forgotten(tokenizer_json, library, monkeypatch):
    monkeypatch.setattr(tc, "BATCH_CHARS", 10)
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    counter = tc.Counter(tokenizer_json, True)
    texts = ["some words, with 12 marks! and it's <|endoftext|> é", "x" * 300, "", *ODD] * 2
    for _ in range(2):
        assert counter.counts(texts) == [plain(library, t) for t in texts]
    assert tc.Counter(tokenizer_json, False).counts(texts) == [plain(library, t) for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aA bB\t\n'sS<|>1é́̈İ", max_size=20), min_size=1, max_size=30))
def test_normal_form_keeps_the_count(spark, library, texts):
    rows = tc.spaces_and_case(T.plain(spark, texts).withColumn("content", F.col("text"))).collect()
    for r in rows:
        assert plain(library, r.text) == plain(library, r.content)


def test_query_against_the_library(spark, library):
    got = {r.doc_id: r for r in tc.op12_token_counts(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = plain(library, d.text)
        assert (got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (n, n > 2048)
        assert got[d.doc_id].n_bytes == len((d.text or "").encode())
