"""A training-corpus pipeline over the ``documents`` table.

Stages, in order, each applied to what the one before it kept and wrote as Parquet:

1. language ID: documents without letters, or long enough to tell and far from every
   learned language, go;
2. near duplicates: one document of each component of the n-gram Jaccard join stays;
3. decontamination: documents that hold a benchmark item go;
4. PII: personal data in the texts is replaced by its kind, ``n_chars`` follows;
5. subword encoding: every kept text as token ids, checked by decoding them.

A null text passes no language test and goes in stage 1; an empty table gives an empty
result; repeated rows are near duplicates of each other; extra columns are kept up to
stage 4 and in the result (stage 5 replaces columns called n_tokens, ids_sha256,
round_trip or token_ids and drops the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, jaccard, langid, pii, spm
from basketry.llm.common import id_remainder, materialize, table
from basketry.llm.lattice import DEFAULT_MODEL, load_vocabulary

MODEL = DEFAULT_MODEL


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prototypes = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    return langid.keep_languages(docs, prototypes)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spm.encode_digest(docs, load_vocabulary(MODEL), keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

# n-gram components, edit matching, learned models and subword encoding have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
