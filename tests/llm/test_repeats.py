import hashlib
import random

import llm_tables as T
import numpy as np
import pytest

from basketry.llm import repeats as R


def by_hand(ids, texts):
    """Removal by looking up every 50-byte string."""
    seen = {}
    rows = sorted(zip(ids, texts), key=lambda x: x[0])
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            seen.setdefault(raw[k : k + 50], i)
    out = {}
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - 49):
            if seen[raw[k : k + 50]] < i:
                gone[k : k + 50] = True
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone[:-1]].tobytes()
        out[i] = (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def passages(seed=4):
    rnd = random.Random(seed)
    parts = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.randint(30, 150))) for _ in range(12)]
    out = []
    for _ in range(120):
        text = ""
        for _ in range(rnd.randint(0, 6)):
            if rnd.random() < 0.6:
                text += rnd.choice(parts)[: rnd.randint(20, 200)]
            else:
                text += "".join(rnd.choice("xyz ") for _ in range(rnd.randint(0, 80)))
            if rnd.random() < 0.1:
                text += "a" * rnd.randint(40, 130)
        out.append(text)
    out += ["", None, "a" * 49, "a" * 50, "a" * 120, out[3], out[3], "ab" * 100, "ab" * 60]
    ids = list(range(len(out)))
    rnd.shuffle(ids)
    return ids, out


@pytest.mark.parametrize("many", [50_000, 3])
def test_same_as_every_window_looked_up(spark, monkeypatch, many):
    ids, texts = passages()
    monkeypatch.setattr(R, "SHARD_PHRASES", 32)  # many shards to merge
    monkeypatch.setattr(R, "MANY_PHRASES", many)  # 3: anchors are taken apart
    got = result(R.remove_repeats(T.plain(spark, texts, ids)))
    want = by_hand(ids, texts)
    assert got == want
    assert sum(r[1] for r in want.values()) > 5000


def test_survey_rows_do_not_multiply_with_the_buckets(spark, monkeypatch):
    """Before, a text was a row in each of the buckets of its anchors."""
    from basketry.llm import exchange

    ids, texts = passages(11)
    monkeypatch.setattr(R, "BUCKET_VALUES", 20)
    total = sum(len((t or "").encode()) for t in texts)
    monkeypatch.setattr(exchange, "SLOT_BYTES", total // 3)
    docs = T.plain(spark, texts, ids)
    found = R.survey(docs, "doc_id", "text").cache()
    packed = found.where("digest IS NULL").select("a", "n_bytes", "n").collect()
    assert found.where("digest IS NOT NULL").count() == len(texts)
    assert {r.a for r in packed} == {0, 1, 2, 3} and len({r.n_bytes for r in packed}) > 8
    assert sum(r.n for r in packed) > 2 * len(packed)  # texts, by bucket
    assert result(R.remove_repeats(docs)) == by_hand(ids, texts)


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(R, "PART_BYTES", 300)
    monkeypatch.setattr(R, "BLOCK_BYTES", 500)
    rnd = random.Random(9)
    a = "".join(rnd.choice("abcd ") for _ in range(3000))
    texts = [a, "x" + a[100:2900] + "yyyy", a[1000:1100] + "q" * 60, "q" * 200]
    ids = [2, 1, 0, 3]
    assert result(R.remove_repeats(T.plain(spark, texts, ids))) == by_hand(ids, texts)


def test_merged_shards_equal_one_sort():
    rnd = np.random.default_rng(5)
    n = 300
    chars = rnd.integers(97, 99, (n, R.COLUMNS)).astype(np.uint8)
    chars[rnd.random((n, R.COLUMNS)) < 0.9] = 97  # long common prefixes
    block = rnd.integers(0, 7, n)
    shard = np.arange(n) // 40
    for c, phrase, common in R.merge(R.ShardBwts(chars, block, shard), block, shard):
        keys = [(block[p], chars[p, c:].tobytes()) for p in phrase]
        assert keys == sorted(keys)
        for j in range(1, n):
            a, b = chars[phrase[j - 1], c:], chars[phrase[j], c:]
            same = 0
            if block[phrase[j - 1]] == block[phrase[j]]:
                differ = np.flatnonzero(a != b)
                same = differ[0] if len(differ) else len(a)
            assert common[j] == same


def test_awkward_rows(spark):
    docs = T.documents(spark)
    got = R.remove_repeats(docs).collect()
    assert len(got) == docs.count()
    rows = T.rows()[: len(T.TEXTS)]
    want = by_hand([r[0] for r in rows], [r[1] for r in rows])
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert R.remove_repeats(T.empty(spark)).count() == 0


def test_null_and_repeated_ids(spark):
    s = T.SENTENCE * 2
    docs = spark.createDataFrame(
        [(None, s), (1, s), (1, s + "tail"), (2, s + "other")], "doc_id long, text string"
    )
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in R.remove_repeats(docs).collect())
    assert got == [(0, len(s), 0), (1, len(s), 0), (1, len(s) + 4, 0), (2, len(s) + 5, len(s))]


@pytest.mark.parametrize("n", [3, 10, 50])
def test_a_short_text_alone(spark, n):
    texts = ["", "abcdefghijklmno"[:n] + "y" * (n - 15), None]
    got = result(R.remove_repeats(T.plain(spark, texts).coalesce(1)))
    assert got == by_hand(range(3), texts)
