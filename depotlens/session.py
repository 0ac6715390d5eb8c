"""Session helpers: pinned time zone, shared scratch folder, local builder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: files of written rows: hashes are hex text, which zstd halves and Snappy does not
COMPRESSION = "zstd"
#: what a small written table may hold to be broadcast, whatever Spark's own limit
BROADCAST_BYTES = 32 << 20

# Every timestamp in the library is TIMESTAMP_NTZ holding UTC wall time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # big scans joined to a selective side (deliveries to complained parcels,
    # facts to a report window) are pre-filtered by a runtime bloom filter
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "depotlens") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the jobs rely on and make sure a shared
    checkpoint folder exists (the cluster's own setting wins)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set and the master is local (tests)
    a fresh folder is made and registered: on a cluster a folder of the
    driver's machine would be another one on every executor.
    """
    sc = spark.sparkContext
    current = None
    try:
        current = sc.getCheckpointDir()
    except Exception:
        current = None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.environ.get("DEPOTLENS_SCRATCH") or tempfile.mkdtemp(prefix="depotlens-ckpt-")
        sc.setCheckpointDir(base)
        current = sc.getCheckpointDir() or base
    return current


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows, written once to the shared folder and read back, where a
    checkpoint would do: the files are smaller, later steps read only the
    columns they need, and Spark knows the size when it plans their joins."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(rows: DataFrame, row_bytes) -> DataFrame:
    """Written rows, broadcast where they hold ``BROADCAST_BYTES`` at most (rows of
    ``row_bytes`` each): the wide side of their join then stays where it is,
    also where Spark's own limit for broadcasts is lower. Else Spark decides."""
    held = rows.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(rows) if held <= BROADCAST_BYTES else rows


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/depotlens-{name}-{uuid.uuid4().hex[:12]}"
