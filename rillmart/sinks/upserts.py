"""Upsert tables as version logs.

Each micro-batch adds its rows below `_batch=<id>`; a repeated batch replaces its own folder, so replays change
nothing. Readers take the last version per key. Writing costs what the batch holds, never the table; `compact`
rewrites the log when reading has become the larger cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import state

BATCH = "_batch"


def append(rows: DataFrame, path: str, batch: int, partition: list[str] | None = None) -> None:
    """Write one micro-batch of versions."""
    writer = rows.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.parquet(f"{path}/{BATCH}={batch}")


def versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions with their batch number."""
    known = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(known).option("basePath", path).parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: tuple[str, ...] = ()
         ) -> DataFrame:
    """The table: the last version of each key, by batch, then by `order` within a batch."""
    return state.latest(versions(spark, path, schema), keys, [BATCH, *order]).drop(BATCH)


def compact(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: list[str],
            order: tuple[str, ...] = ()) -> None:
    """Write the last versions alone to the new folder `target`, keeping their batch numbers."""
    last = state.latest(versions(spark, path, schema), keys, [BATCH, *order])
    last.hint("rebalance", BATCH).write.partitionBy(BATCH).mode("errorifexists").parquet(target)
