"""Session defaults. Every value can be overridden by the cluster's own configuration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing, broadcast by measured size, splitting of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state lives in RocksDB: it spills to disk and checkpoints changelogs instead of full snapshots.
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build(app: str = "rillmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `master` is only given in tests and local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare_streams(spark: SparkSession) -> None:
    """Use RocksDB for streaming state in sessions built elsewhere; keyed custom state needs it."""
    if not spark.conf.get(STATE_STORE).endswith("RocksDBStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)


_local_root: list[str] = []


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: name a folder shared by the whole cluster")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="rillmart-"))
    return _local_root[0]


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the cluster's `spark.checkpoint.dir`, the folder all executors and drivers see.

    Where it is unset, a session of one local process gets a folder of its own; on a cluster that is an error.
    """
    return os.path.join(_root(spark), *parts)


def settled(df: DataFrame) -> DataFrame:
    """A batch frame that is used several times, computed once into the checkpoint folder (see `shared_dir`)."""
    if df.isStreaming:
        return df
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_root(df.sparkSession))
    return df.checkpoint()
