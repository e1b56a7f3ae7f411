"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Defaults for a batch session. Shuffle partitions is a starting point only: AQE
# coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs an extra exchange afterwards (the
    # items-to-orders join feeds an aggregation on the join key)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Broadcast joins happen only under this estimated size; beyond it the join
    # stays a shuffle join (statically and when AQE re-plans with real sizes).
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # delete reliable-checkpoint files once the DataFrames using them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app_name: str = "basketry",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a configured SparkSession (reuses an active one)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


PARTITION_INPUT = 8 << 20  # scanned bytes for which a shuffle gets a partition


def scanned_bytes(tables: Iterable[DataFrame]) -> int:
    """Size of the files that the tables read, by Spark's own listing (no job)."""
    total = 0
    for df in tables:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        total += sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return total


def bound_tasks(spark: SparkSession, tables: Iterable[DataFrame] = ()) -> None:
    """The settings that the marts need on whatever session they are given.

    Skewed joins are split (see ``DEFAULT_CONF``). A task that joins order items and reduces
    them to order lines needs about 13 times its shuffled bytes as memory for sorting and
    aggregating; AQE otherwise merges partitions up to 64 MB. AQE merges but does not divide
    them, so shuffles start from a number of partitions that follows the size of ``tables``.
    A smaller size or a larger number that the session already has is kept.
    """
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(spark.conf.get(name)) > in_bytes(DEFAULT_CONF[name]):
        spark.conf.set(name, DEFAULT_CONF[name])
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    first = int(spark.conf.get(number, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-scanned_bytes(tables) // PARTITION_INPUT)
    if wanted > first:
        spark.conf.set(number, str(wanted))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage; if it is
    unset there, this raises. Only in local mode (tests, one machine) an unset
    setting gets a local temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local"):
            # executors on other machines cannot see a folder local to the driver
            raise RuntimeError(
                "spark.checkpoint.dir is not set: set it to a folder on shared storage "
                "(e.g. hdfs:// or s3a://) for checkpoints and intermediate tables"
            )
        root = tempfile.mkdtemp(prefix="basketry-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a table a job writes, in the application's folder under
    the checkpoint root. The folder is deleted when the application ends."""
    app = f"{checkpoint_root(spark)}/basketry/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(app)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{app}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of the application's folder and read back: it is computed
    once, later jobs read only the columns they use, and a lost executor re-reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
