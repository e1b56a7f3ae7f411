import zlib

import llm_tables as T
import pytest
from pyspark.sql import functions as F

from basketry.llm import sharding


def frame(df):
    return df.toPandas()


@pytest.fixture(scope="module")
def many(spark):
    return spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'one hot text' ELSE repeat(concat('t', id), 1 + id % 50) END")
        .alias("text"),
        F.concat(F.lit("l"), F.col("id") % 4).alias("lang"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('s', id % 9) END").alias("source"),
    )


def test_near_equal_bytes_and_gapless_slots(many):
    got = frame(sharding.kd_shards(many, 40))
    assert len(got) == 4000 and got.doc_id.is_unique
    size = got.groupby("shard")["size"].sum()
    assert sorted(size.index) == list(range(40))
    assert size.max() - size.min() <= 4 * got["size"].max()  # a third of all texts are equal
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
        assert list(g.sort_values("slot").doc_id) == sorted(g.doc_id)


def test_sizes_and_checksums(many):
    got = frame(sharding.kd_shards(many, 3)).set_index("doc_id")
    texts = many.select("doc_id", "text").toPandas().set_index("doc_id").text
    for i in (0, 1, 17, 3999):
        raw = texts[i].encode()
        assert got.loc[i, "size"] == len(raw) + 16
        assert got.loc[i, "text_crc32"] == zlib.crc32(raw)


def test_target_bytes_decides_the_shards(many):
    total = frame(sharding.kd_shards(many, 1))["size"].sum()
    got = frame(sharding.kd_shards(many, target_bytes=int(total / 6.5)))
    assert sorted(got.shard.unique()) == list(range(7))


def test_cut_halves_the_bytes(many):
    size = frame(sharding.kd_shards(many, 2)).groupby("shard")["size"].sum()
    assert abs(size[0] - size[1]) <= 300


def test_awkward_rows(spark):
    docs = T.documents(spark)
    got = frame(sharding.kd_shards(docs, 5))
    assert len(got) == docs.count()
    assert set(got.shard) <= set(range(5))
    null = got[got.doc_id == 3].iloc[0]
    assert (null["size"], null.text_crc32) == (16, 0)
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert sharding.kd_shards(T.empty(spark), 5).count() == 0


def test_query_columns(spark):
    got = sharding.op6_kd_sharding(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def plain_tree(rows, shards):
    """A k-d tree by sorting: rows are (id, size, checksum, id's hash, four coordinates)."""
    spread = [max(1, max(r[4 + d] for r in rows) - min(r[4 + d] for r in rows)) for d in range(4)]
    leaf = {}

    def split(some, first, n):
        if n == 1 or not some:
            leaf.update({r[0]: first for r in some})
            return
        widths = [(max(r[4 + d] for r in some) - min(r[4 + d] for r in some)) / spread[d] for d in range(4)]
        dim = widths.index(max(widths))
        left = (n + 1) // 2
        want = sum(r[1] for r in some) * left / n

        def key(r):
            return r[4 + dim], r[2] >> 12, r[3] % (1 << 19)

        keys = sorted({key(r) for r in some})
        bytes_of = {k: 0 for k in keys}
        for r in some:
            bytes_of[key(r)] += r[1]
        below, last = 0, None
        for k in keys:
            if below + bytes_of[k] >= want or k == keys[-1]:
                # the row at the cut goes to the side that comes nearer to the wish
                if below + bytes_of[k] - want <= want - below:
                    last = k
                break
            below, last = below + bytes_of[k], k
        split([r for r in some if last is not None and key(r) <= last], first, left)
        split([r for r in some if last is None or key(r) > last], first + left, n - left)

    split(rows, 0, shards)
    return leaf


@pytest.mark.parametrize("shards", [2, 7, 40])
def test_leaves_equal_a_plain_tree(many, shards):
    pts = sharding.points(many).withColumn("h", F.xxhash64("doc_id"))
    rows = [tuple(r) for r in pts.select("doc_id", "size", "text_crc32", "h", *sharding.DIMS).collect()]
    got = {r.doc_id: r.shard for r in sharding.kd_shards(many, shards).collect()}
    assert got == plain_tree(rows, shards)
