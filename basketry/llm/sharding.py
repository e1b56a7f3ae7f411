"""K-d tree sharding: recursive splits at weighted medians of metadata.

Every row is a point: byte size (log scale), source, language and text checksum, each
as a 24-bit coordinate. A node that must hold s shards is cut along its widest
dimension (width relative to the whole table's) where ceil(s / 2) / s of its bytes lie
on the left, until every leaf is one shard of the target bytes.

The medians are exact to the row and distributed: all nodes of a level are cut
together; each round sums bytes per node and per bin of 9 key bits and keeps the bin
that holds the cut, until that bin is a negligible part of the node. A round brings at
most (nodes x 512) sums to the driver, whatever the table's size. Ties along the
dimension are cut by text checksum and then by a hash of the id, so equal texts stay
neighbours and a group larger than a shard is still divided.

Text is read once; everything else works on a narrow table in the shared checkpoint
folder, rewritten with its new node numbers after each of the log2(shards) levels. Slots are numbered over a range partitioning by (shard, id) with offsets per
partition, so no task holds a whole shard. No Python code runs on executors.

Defined results: null text counts 16 bytes and checksum 0; null metadata is the
coordinate 0. Repeated rows are separate rows. Fewer rows than shards leave shards
empty. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from basketry.llm.common import materialize, table

SHARDS = 40
ROW_OVERHEAD = 16
DIMS = ("d_size", "d_source", "d_lang", "d_text")
COORD_BITS = 24
BIN_BITS = 9
KEY_BITS = 63  # 24 bits of coordinate, 20 of checksum, 19 of the id's hash
TOLERANCE = 1e-5  # a bin below this part of its node is not divided further
_POSITION = (1 << 33) - 1


@dataclass
class Cut:
    """A node that is being cut, and where the search for its weighted median stands."""

    shards: int
    left: int  # shards on the left
    dim: int  # index into DIMS
    total: int  # bytes of the node
    below: int = 0  # bytes certainly on the left
    prefix: int = 0  # leading key bits of the bin that holds the cut
    size: int = 0  # bytes of that bin
    last: int | None = None  # the last key on the left, once found


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the coordinates and the root node of every row."""
    raw = F.encode(F.col("text"), "UTF-8")

    def code(column: str) -> Column:
        text = F.encode(F.col(column).cast("string"), "UTF-8")
        return F.coalesce(F.shiftright(F.crc32(text), 8), F.lit(0).cast("long"))

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_OVERHEAD
    crc = F.coalesce(F.crc32(raw), F.lit(0).cast("long"))
    return docs.select(
        "doc_id",
        size.alias("size"),
        crc.alias("text_crc32"),
        F.floor(F.log2(size.cast("double")) * float((1 << COORD_BITS) / 48)).alias("d_size"),
        code("source").alias("d_source"),
        code("lang").alias("d_lang"),
        F.shiftright(crc, 8).alias("d_text"),
        F.lit(0).alias("node"),
    )


def _key() -> Column:
    """Sort key of a row along its node's dimension (column ``dim``)."""
    tie = F.shiftleft(F.shiftright(F.col("text_crc32"), 12), 19)
    own = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 19) - 1))
    at = F.element_at(F.array(*[F.col(d).cast("long") for d in DIMS]), F.col("dim") + 1)
    return F.shiftleft(at, 39) + tie + own


def _spans() -> list[Column]:
    return [(F.max(d) - F.min(d)).alias(d) for d in DIMS]


def _medians(here: DataFrame, cuts: dict[int, Cut]) -> None:
    """Find ``last`` of every cut: rounds of byte sums per node and bin of key bits."""
    spark = here.sparkSession
    for shift in range(KEY_BITS - BIN_BITS, -1, -BIN_BITS):
        live = {f: c for f, c in cuts.items() if c.last is None}
        if not live:
            return
        # at most one row per shard
        state = spark.createDataFrame(
            [(f, c.dim, c.prefix) for f, c in live.items()], "node int, dim int, prefix long"
        )
        found = (
            here.join(F.broadcast(state), "node")
            .withColumn("key", _key())
            .where(F.shiftright("key", shift + BIN_BITS) == F.col("prefix"))
            .groupBy("node", F.shiftright("key", shift).alias("bin"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        for f, c in live.items():
            want = c.total * c.left / c.shards
            bins = sorted((r["bin"], r["bytes"]) for r in found if r["node"] == f)
            for i, (at, size) in enumerate(bins):
                if c.below + size >= want or i == len(bins) - 1:
                    break
                c.below += size
            c.prefix, c.size = at, size
            if shift == 0 or size <= TOLERANCE * c.total:
                # the whole bin goes to the side that comes nearer to the wish
                take = c.below + size - want <= want - c.below
                c.last = ((at + 1) << shift) - 1 if take else (at << shift) - 1


def kd_split(pts: DataFrame, shards: int) -> DataFrame:
    """The points with their leaf number (column ``node``), level by level."""
    spark = pts.sparkSession
    whole = pts.agg(*_spans()).first()
    width = [max(1, whole[d] or 0) for d in DIMS]
    here = pts
    nodes = {0: shards}  # first shard -> shards below the node
    while opened := {f: n for f, n in nodes.items() if n > 1}:
        stats = here.groupBy("node").agg(F.sum("size").alias("bytes"), *_spans()).collect()
        cuts = {}
        for r in stats:  # a row per node with rows
            if (n := opened.get(r["node"])) is not None:
                wide = max(range(len(DIMS)), key=lambda i, r=r: (r[DIMS[i]] / width[i], -i))
                cuts[r["node"]] = Cut(n, (n + 1) // 2, wide, r["bytes"])
        _medians(here, cuts)
        rows = [(f, c.dim, c.last, f + c.left) for f, c in cuts.items()]
        moves = spark.createDataFrame(rows, "node int, dim int, last long, right int")
        here = here.join(F.broadcast(moves), "node", "left").withColumn(
            "node", F.when(_key() > F.col("last"), F.col("right")).otherwise(F.col("node"))
        )
        here = materialize(here.select(pts.columns), "level")
        for f, n in opened.items():
            half = (n + 1) // 2
            nodes[f], nodes[f + half] = half, n - half
    return here


def number_rows(df: DataFrame, group: str, order: str, out: str) -> DataFrame:
    """Gapless numbers from 0 inside each group, without one task per group."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, group, order)
        .sortWithinPartitions(group, order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn(
            "__at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
        ),
        "slots",
    )
    runs = placed.groupBy(group, "__part").agg(
        F.min("__at").alias("__from"), F.count(F.lit(1)).alias("__n")
    )
    # a row per group and partition: bounded by groups + partitions
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__from")).alias("__shift")
    )
    return (
        placed.join(F.broadcast(runs), [group, "__part"])
        .withColumn(out, F.col("__at") + F.col("__shift"))
        .drop("__part", "__at", "__shift")
    )


def kd_shards(
    docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot. Give the number of shards, or the bytes
    that a leaf may reach (then the number follows from the table's bytes)."""
    pts = materialize(points(docs), "points")
    if target_bytes is not None:
        total = pts.agg(F.sum("size").alias("b")).first()["b"] or 0
        shards = max(1, -(-total // target_bytes))
    placed = kd_split(pts, shards).select(
        "doc_id", "size", "text_crc32", F.col("node").alias("shard")
    )
    return number_rows(placed, "shard", "doc_id", "slot")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    return kd_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
