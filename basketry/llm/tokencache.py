"""Token counts of texts through a digest cache.

A text is brought to a normal form with the same tokens, and the form's SHA-256 names it.
The cache is a folder of Parquet rows (digest, n_tokens) per tokenizer version, the
SHA-256 of the tokenizer's own file, so counts of two versions never mix. A call

1. reduces the texts to distinct normal forms (copies are combined per task before the
   shuffle, so a text held by a third of all rows crosses it once per task),
2. anti-joins them with the stored digests; what is left are the misses,
3. encodes the misses, each once, and appends their counts to the cache,
4. joins every row's digest with the stored counts (two plain shuffles of digests; a hot
   digest's partition can be split at run time).

Steps 1, 2 and 4 are DataFrame operations; only misses reach Python. The cache folder
must be on shared storage, with one writer at a time: a lost executor or a repeated task
leaves it right (Spark's committer), two writers at once could store a digest twice.

Defined results: null text = empty text = 0 tokens. Repeated rows are answered each, null
ids too. Other columns are not read. A text is counted unit by unit between its spaces (no
token reaches over one), and a worker encodes a unit once; a very long unit is encoded
whole. An empty table gives no rows and stores nothing.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import ARROW_ROWS, arrow_rows, blocks, kept, table, text_blocks
from basketry.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
BLOCK_BYTES = 1_000_000  # texts that are split at once
BATCH_CHARS = 200_000  # characters that the library encodes at once
REMEMBERED = 300_000  # units whose counts a worker keeps
FORGET_CHARS = 8_000_000
STORED = "digest binary, n_tokens bigint"
_SPACE = r"[\t\n\x0B\f\r][ \t\n\x0B\f\r]*| [ \t\n\x0B\f\r]+"


def spaces_and_case(rows: DataFrame) -> DataFrame:
    """``content`` in normal form, for tokenizers that drop white space and case.

    Runs of ASCII white space become one space. ASCII letters are lower-cased in texts
    that are all ASCII and hold no opening of a special string: beside other characters,
    lower case may compose where upper case does not.
    """
    rows = rows.withColumn("content", F.trim(F.regexp_replace("content", _SPACE, " ")))
    ascii_only = F.octet_length("content") == F.char_length("content")
    plain = ascii_only & ~F.contains("content", F.lit("<|"))
    return rows.withColumn("content", F.when(plain, F.lower("content")).otherwise(F.col("content")))


class Counter:
    """Token counts of texts, each distinct unit between spaces encoded once."""

    def __init__(self, tokenizer_json: str, by_word: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = by_word
        self.known: dict[str, int] = {}

    def _lengths(self, some: list[str]) -> Iterator[int]:
        for i, j in blocks([len(t) for t in some], BATCH_CHARS):
            yield from map(len, self.tokenizer.encode_batch_fast(some[i:j], add_special_tokens=False))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return list(self._lengths(texts))
        if len(self.known) > REMEMBERED:
            self.known = {}
        split = [t.split(" ") for t in texts]
        new = list(set().union(*split).difference(self.known))
        self.known.update(zip(new, self._lengths(new), strict=True))
        out = [sum(map(self.known.__getitem__, words)) for words in split]
        if sum(map(len, new)) > FORGET_CHARS:
            self.known = {}
        return out


def _encode(misses: DataFrame, tokenizer_json: str, by_word: bool) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = kept(("counter", tokenizer_json, by_word), lambda: Counter(tokenizer_json, by_word))
        for b in batches:
            for i, j, texts in text_blocks(b.column("content"), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [b.column("digest").slice(i, j - i), pa.array(counter.counts(texts), pa.int64())],
                    ["digest", "n_tokens"],
                )

    return misses.select("digest", "content").mapInArrow(count, STORED)


def stored_counts(spark: SparkSession, cache: str, tokenizer_json: str) -> DataFrame:
    """The cache's rows for this tokenizer; empty where nothing is stored yet."""
    path = _folder(cache, tokenizer_json)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(path)


def _folder(cache: str, tokenizer_json: str) -> str:
    return f"{cache}/tokenizer={hashlib.sha256(tokenizer_json.encode()).hexdigest()}"


def count_tokens(
    docs: DataFrame,
    tokenizer_json: str,
    cache: str,
    limit: int = LIMIT,
    normal: Callable[[DataFrame], DataFrame] = spaces_and_case,
    by_word: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row; the
    misses are encoded and stored when this is called. ``normal`` may only join texts that
    the tokenizer gives equally many tokens; ``by_word`` is for tokenizers whose tokens never
    reach over a space (others get whole texts)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    # never NULL: a join on it needs no filter, which would compute the normal form again
    digest = F.coalesce(F.unhex(F.sha2("content", 256)), F.lit(b""))
    rows = normal(rows).withColumn("digest", digest)
    distinct = rows.groupBy("digest").agg(F.first("content").alias("content"))
    known = stored_counts(spark, cache, tokenizer_json)
    misses = distinct.join(known, "digest", "left_anti")
    with arrow_rows(spark, ARROW_ROWS):
        fresh = _encode(misses, tokenizer_json, by_word)
        fresh.write.mode("append").parquet(_folder(cache, tokenizer_json))
    counts = stored_counts(spark, cache, tokenizer_json)
    return rows.drop("content").join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def read_tokenizer(name: str) -> str:
    """A tokenizer file's text, read by the driver and sent to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op12_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Token counts of every whole text, with a cache of this run."""
    return count_tokens(
        table(spark, sf_dir, "documents"), read_tokenizer(tokenizer), scratch_path(spark, "token-cache")
    )
