import random

import llm_tables as T
import numpy as np
import pytest

from basketry.llm import jaccard as J
from basketry.llm.graph import components


def family_texts(seed=2):
    """Families of edited copies of many sizes, and short texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for n in (5, 6, 7, 8, 9, 11, 14, 18, 25, 33, 47, 64, 110):
        for _ in range(5):
            base = [rnd.choice(words) for _ in range(n)]
            for _ in range(6):
                x = list(base)
                for _ in range(rnd.randint(0, max(1, n // 22))):
                    x[rnd.randrange(n)] = rnd.choice(words)
                if rnd.random() < 0.4:
                    x = x[: max(1, int(n * rnd.uniform(0.7, 1)))]
                out.append(" ".join(x))
    shared = " ".join(rnd.choice(words) for _ in range(60))  # a passage in unlike texts
    for _ in range(25):
        own = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        out.append(" ".join(own) + " " + shared)
    return [*out, "", None, " \t ", "a", "A", "a b", "A\nb C d", "a b c d", "é É", "x y z w v"]


def test_same_components_as_all_pairs(spark):
    texts = family_texts()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    got = J.near_duplicates(T.plain(spark, texts, ids)).collect()
    want = T.near_components(ids, texts)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(ids) - 100
    sizes = {i: len(T.shingles(t)) for i, t in zip(ids, texts)}
    assert {r.doc_id: r.n_shingles for r in got} == sizes


def test_small_buckets_give_the_same(spark, monkeypatch):
    texts = family_texts(5)[:160]
    ids = list(range(len(texts)))
    want = T.near_components(ids, texts)
    monkeypatch.setattr(J, "BUCKET_VALUES", 200)
    monkeypatch.setattr(J, "TASK_VALUES", 500)
    got = J.near_duplicates(T.plain(spark, texts, ids)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_survey_rows_do_not_multiply_with_the_buckets(spark, monkeypatch):
    """Before, a set was a row in each of its buckets."""
    from basketry.llm import exchange

    texts = family_texts(7)
    monkeypatch.setattr(J, "BUCKET_VALUES", 50)
    total = sum(len((t or "").encode()) for t in texts)
    monkeypatch.setattr(exchange, "SLOT_BYTES", total // 3)
    found = J.survey(T.plain(spark, texts), "doc_id", "text").cache()
    packed = found.where("kind = 0").select("a", "n", "shared").collect()
    assert found.where("kind = 1").count() == len(texts)
    assert {r.a for r in packed} == {0, 1, 2, 3}
    assert sum(r.n for r in packed) > 4 * len(packed)  # sets, by bucket
    got = J.near_duplicates(T.plain(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == T.near_components(list(range(len(texts))), texts)


def test_chain_is_one_component(spark):
    # each text links with the next only; the ends have little in common
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 8 : i * 8 + 100]) for i in range(30)]
    got = J.near_duplicates(T.plain(spark, texts)).collect()
    assert {r.component_id for r in got} == {0}


def test_signatures_meet_for_linked_sets():
    rnd = np.random.default_rng(3)
    for n in [3, 4, 5, 6, 7, 8, 10, 13, 20, 40, 90, 300, 1000]:
        for _ in range(40):
            a = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
            b = a.copy()
            while True:  # edit b as long as the sets link
                c = b[rnd.random(len(b)) > 0.5 / len(b)]
                if rnd.random() < 0.5:
                    c = np.unique(np.append(c, rnd.integers(0, 2**64, 1, dtype=np.uint64)))
                both = len(np.intersect1d(a, c))
                if 100 * both < 75 * (len(a) + len(c) - both):
                    break
                b = c
            if not np.array_equal(a, b):
                assert len(np.intersect1d(J.signatures(a), J.signatures(b))), (n, len(a), len(b))


def test_components(spark):
    links = [(5, 3), (3, 9), (9, 12), (20, 21), (30, 30), (12, 40), (40, 1)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {
        1: 1, 3: 1, 5: 1, 9: 1, 12: 1, 40: 1, 20: 20, 21: 20
    }


def test_awkward_rows(spark):
    docs = T.documents(spark)
    got = J.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r.component_id for r in got}
    assert by_id[1] == by_id[2] == 0 and by_id[10] == 9
    assert all(by_id[i] == i for i in (3, 4, 5, 6, 7, 8, 9, 11))
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(3, 10), *range(11, 15)]
    assert J.near_duplicates(T.empty(spark)).count() == 0
    assert J.keep_one(T.empty(spark)).count() == 0


def test_null_id_has_no_component(spark):
    docs = spark.createDataFrame(
        [(None, T.SENTENCE), (4, T.SENTENCE), (None, None)], "doc_id long, text string"
    )
    got = J.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (4, 4)]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_a_short_text_alone(spark, n):
    text = " ".join("abcde"[:n])
    for texts in ([text], ["", text, None]):
        ids = list(range(len(texts)))
        df = T.plain(spark, texts).coalesce(1)
        got = J.near_duplicates(df).collect()
        assert {r.doc_id: r.component_id for r in got} == T.near_components(ids, texts)
        assert {r.doc_id: r.n_shingles for r in got} == {i: len(T.shingles(t)) for i, t in zip(ids, texts)}
    assert J.keep_one(T.plain(spark, [text]).coalesce(1)).count() == 1


def test_shingles_that_agree_in_their_leading_bits(spark):
    """Two sets hold the same shingles, some of which differ in their last bits only: the
    exchange counts those once, and neither set may be dropped for it."""
    import pyarrow as pa

    from basketry.llm.exchange import packed

    one = np.array([5 << 32 | 1, 5 << 32 | 2, 5 << 32 | 3, 9 << 32], np.uint64)
    values, sizes = np.concatenate([one, one, [np.uint64(7 << 32)]]), np.array([4, 4, 1])
    rows = packed(values, np.repeat(np.arange(3), sizes), np.array([11, 12, 13], np.uint64), 0)
    shared = {r["a"]: r["n"] for r in J._shared_counts(pa.Table.from_batches([rows])).to_pylist()}
    lead = J.leading_counts(values, sizes, 0)
    assert shared == {11: 2, 12: 2} and lead.tolist() == [2, 2, 1]
    sets = [(i, int(n), int(t), shared.get(i)) for i, n, t in zip((11, 12, 13), sizes, lead)]
    # a set at exactly three quarters stays, one under it goes
    sets += [(21, 100, 100, 75), (22, 100, 100, 74), (23, 100, 99, 74), (24, 100, 99, None)]
    kept = spark.createDataFrame(sets, "a long, n long, lead long, shared long").where(J.MAY_LINK)
    assert sorted(r.a for r in kept.collect()) == [11, 12, 21, 23]


_WORKER = """
import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa

sys.path.insert(0, sys.argv[1])
from basketry.llm import exchange, jaccard


def held():
    rollup = Path("/proc/self/smaps_rollup").read_text()
    return sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", rollup))) / 1024


random = np.random.default_rng(1)
owners = np.repeat(np.arange(1000), 100)
for _ in range(2):
    sent = [
        exchange.packed(
            random.integers(0, 1 << 63, 100_000).astype(np.uint64), owners,
            np.arange(1000).astype(np.uint64) + 1000 * k, 0,
        )
        for k in range(20)
    ]
    jaccard._stars(pa.Table.from_batches(sent))
    sent = None
    jaccard._stars(pa.Table.from_batches([exchange.packed(
        np.arange(2).astype(np.uint64), owners[:2], np.arange(1).astype(np.uint64), 0)]))
print(held())
"""


def test_a_worker_gives_back_the_memory_of_a_large_bucket():
    """2 million values; before, a worker held about 200 MB of them while it was idle."""
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(__file__).resolve().parents[2])
    out = subprocess.run([sys.executable, "-c", _WORKER, root], capture_output=True, text=True, check=True)
    assert float(out.stdout) < 120


def test_sketches_never_rule_out_a_link():
    """Sketches differ in no more bits than their sets in shingles, also after folding, and tell
    unlike sets apart."""
    rnd = np.random.default_rng(9)
    sets = []
    for n in (1, 2, 5, 40, 63, 64, 65, 130, 250, 300, 1000, 9000, 12000):
        one = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        own = rnd.integers(0, 2**64, max(1, n // 5), dtype=np.uint64)
        sets += [one, np.unique(np.append(one, own)), np.unique(np.append(one[: n - n // 7], own[: n // 9]))]
    drawn = [J.sketch(x) for x in sets]
    n = np.array([len(x) for x in sets])
    about = J._Described(
        np.arange(len(sets)), np.arange(len(sets)), n, np.array([len(x) for x in drawn]), np.concatenate(drawn)
    )
    a, b = np.triu_indices(len(sets), 1)
    may = about.may_link(a, b)
    both = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)])
    linked = 100 * both >= 75 * (n[a] + n[b] - both)
    assert linked.sum() > 20 and may[linked].all()
    unlike = (both == 0) & (n[a] > 30) & (n[b] > 30) & (n[a] < 5000)
    assert unlike.sum() > 100 and not may[unlike].any()


def common_line_texts(n=60, seed=4):
    """Unlike texts of passages that others hold, too, with one line in common, and a near copy
    of each eighth one."""
    rnd = random.Random(seed)
    line = " ".join(f"c{i}" for i in range(25))
    pool = [[f"w{rnd.randrange(400)}" for _ in range(25)] for _ in range(30)]
    own = [[w for passage in rnd.sample(pool, 3) for w in passage] for _ in range(n)]
    near = [["x", *words[1:]] for words in own[::8]]
    return [" ".join(words) + " " + line for words in own + near]


def test_pairs_that_share_a_common_line_only_stay_in_their_task(spark, monkeypatch):
    """Before, all pairs of sets under a signature of the line were rows of a join."""
    texts = common_line_texts()
    made = []
    across = J._across_pairs
    monkeypatch.setattr(J, "_across_pairs", lambda *x: made.append(across(*x).cache()) or made[-1])
    got = J.near_duplicates(T.plain(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == T.near_components(list(range(len(texts))), texts)
    assert all(df.count() < len(texts) for df in made)


def test_a_signature_with_many_sets_is_dealt_by_blocks(spark, monkeypatch):
    texts = common_line_texts() + family_texts(11)[200:]
    want = T.near_components(list(range(len(texts))), texts)
    monkeypatch.setattr(J, "GROUP_SETS", 3)
    monkeypatch.setattr(J, "BLOCK_SETS", 4)
    monkeypatch.setattr(J, "PAIRS_AT_ONCE", 10)
    got = J.near_duplicates(T.plain(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
