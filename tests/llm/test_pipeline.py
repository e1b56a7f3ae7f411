import hashlib
import zlib

import corpus_pipeline as C
import llm_tables as T
import pytest
import sentencepiece
from pyspark.sql import functions as F

from basketry.llm import decontaminate, langid, lattice, pii, registry

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    got = C.run(spark, SF).toPandas().set_index("doc_id")
    # 1. language
    train = [zlib.crc32(str(i).encode()) % 5 != 0 for i in docs.doc_id]
    vectors = langid.bundle([t or "" for t in docs.text])
    protos = [vectors[(docs.lang == x) & train].sum(0) for x in sorted(docs.lang.dropna().unique())]
    size = (vectors**2).sum(1) ** 0.5
    cosine = [max(v @ p / (p @ p) ** 0.5 for p in protos) / max(s, 1e-12) for v, s in zip(vectors, size)]
    docs = docs[(size > 0) & [c >= langid.LEAST_SCORE for c in cosine]]
    # 2. near duplicates
    label = T.near_components(list(docs.doc_id), list(docs.text))
    docs = docs[[label[i] == i for i in docs.doc_id]]
    # 3. decontamination
    pieces = [decontaminate.normalise(t) for t in items.text]
    held = [any(p in decontaminate.normalise(t) for p in pieces) for t in docs.text]
    docs = docs[[not h for h in held]]
    assert sorted(got.index) == sorted(docs.doc_id)
    # 4. personal data, 5. encoding
    own = sentencepiece.SentencePieceProcessor(model_file=lattice.DEFAULT_MODEL)
    accepted = pii.train(spark.createDataFrame(docs[["doc_id", "text"]]))
    for i, t in zip(docs.doc_id, docs.text):
        _, spans = pii.all_spans(t, accepted)
        last, parts = 0, []
        for s, k, e in spans:
            if e > last:
                parts += [t[last:s] if s > last else "", f"<{pii.KINDS[k].upper()}>"]
                last = e
        clean = "".join([*parts, t[last:]])
        ids = own.encode(clean)
        row = got.loc[i]
        assert row.n_chars == len(clean) and list(row.token_ids) == ids and row.round_trip
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_columns_and_awkward_rows(spark, tmp_path):
    T.documents(spark).withColumn("n_chars", F.col("n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, T.TEXTS[8])], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES:
        before = docs
        docs = stage(spark, docs, str(tmp_path))
        if name != "encoding":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
    left = {r.doc_id for r in docs.collect()}
    assert 0 in left and not {1, 2, 3, 4, 5, 7, 8, 10} & left


def test_empty_table(spark, tmp_path):
    T.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_query_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    if name.startswith("op11"):  # a row per phrase
        assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and df.count() > 0
        return
    table = "pages" if name.startswith("op4") else "documents"
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_archive_query_against_sql(spark):
    import duckdb

    got = registry.QUERIES["op4_warc_revisits"](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(registry.ORACLE["op4_warc_revisits"]).df()
    cols = sorted(want.columns)
    key = lambda df: sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert key(got) == key(want)
