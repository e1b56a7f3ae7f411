import hashlib
import random

import llm_tables as T
import numpy as np
from pyspark.sql import functions as F

from basketry.llm import fingerprint as fp


def one(text):
    return fp.pack(fp.sketches([text]))[0]


def test_does_not_depend_on_the_batch():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 90))) for _ in range(200)]
    texts += ["", "a", "aa", "a" * 500, "ab" * 300, "é😀" * 40]
    assert fp.pack(fp.sketches(texts)) == [one(t) for t in texts]


def test_equal_stretches_share_names_at_any_offset():
    rnd = random.Random(2)
    middle = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    a, b = "x" * 17 + middle, "some other start " + middle + "!"
    unlike = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    s = fp.sketches([a, b, unlike])
    assert fp.likeness(s[:1], s[1:2])[0] > 0.9
    assert fp.likeness(s[:1], s[2:])[0] < 0.2


def test_likeness_of_small_sets():
    def sketch(values):
        row = np.full((1, fp.SKETCH), 1 << 32, np.uint64)
        row[0, : len(values)] = sorted(values)
        return row

    assert fp.likeness(sketch([]), sketch([]))[0] == 1.0
    assert fp.likeness(sketch([]), sketch([1]))[0] == 0.0
    assert fp.likeness(sketch([1, 2, 3]), sketch([2, 3, 4]))[0] == 0.5


def plain_neighbours(ids, texts):
    rows = sorted(zip(ids, texts), key=lambda x: -x[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 3
        new = t[: len(t) - n] + nxt[:n]
        a, b, c = (fp.sketches([x]) for x in (t, new, nxt))
        out[i] = (
            len(t), hashlib.sha256(new.encode()).hexdigest(), one(t), one(new),
            float(fp.likeness(a, b)[0]), float(fp.likeness(a, c)[0]),
        )
    return out


def test_neighbours_over_many_partitions(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(0, 200))) for _ in range(83)]
    texts += [None, "", texts[0]]
    ids = list(range(0, 5 * len(texts), 5))
    rnd.shuffle(ids)
    docs = T.plain(spark, texts, ids)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = fp.neighbours(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.doc_id: (r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint),
                       r.near_edited, r.near_next) for r in got} == plain_neighbours(ids, texts)


def test_awkward_rows(spark):
    docs = T.documents(spark)
    got = fp.neighbours(docs).collect()
    assert len(got) == docs.count()
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(bytes(r.fingerprint))
    assert all(len(p) == 1 for p in prints.values())
    assert prints[0] == prints[1] and prints[3] == prints[4] == {b""}
    assert fp.neighbours(T.empty(spark)).count() == 0
    alone = fp.neighbours(docs.where("doc_id = 8")).first()
    assert alone.near_next == 1.0
    assert fp.fingerprints(docs).where(F.col("doc_id") == 0).first().fingerprint == list(prints[0])[0]


def test_many_partitions_write_few_files(spark):
    texts = ["ab c" * (k % 50) + str(k) for k in range(400)]
    docs = T.plain(spark, texts, list(range(400)))
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        found = fp.neighbours(docs)
        got = found.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    assert {r.doc_id: (r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint),
                       r.near_edited, r.near_next) for r in got} == plain_neighbours(range(400), texts)
