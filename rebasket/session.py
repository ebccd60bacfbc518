"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rebasket")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# What a shuffle partition holds: rows at most on average, and packed bytes when adaptive
# execution joins small ones. A task keeps its partition unpacked in a sort and a hash table.
ROWS_PER_PARTITION = 500_000
BYTES_PER_PARTITION = 16 << 20


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let the session's shuffles follow the rows: a task's share stays the same on larger tables.

    Settings that are finer already stay as they are.
    """
    parts = -(-rows // ROWS_PER_PARTITION)
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < parts:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{BYTES_PER_PARTITION}b")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="rebasket-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    For tables that several later jobs read: they are computed once, a lost
    executor does not bring the computation back, and the scans prune columns.
    """
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
