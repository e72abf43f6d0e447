"""Starting and running streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .. import session
from ..sinks import upserts
from . import history

TRIGGER = "5 seconds"
T = TypeVar("T")


def writer(df: DataFrame, checkpoint: str, once: bool = False, trigger: str = TRIGGER, mode: str = "append"
           ) -> DataStreamWriter:
    """A stream writer with its checkpoint. `once` reads what is there and stops, otherwise batches run on `trigger`."""
    session.prepare_streams(df.sparkSession)
    started = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return started.trigger(availableNow=True) if once else started.trigger(processingTime=trigger)


_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


@contextmanager
def idle_inputs(spark: SparkSession, skip: bool = True) -> Iterator[None]:
    """Queries started within do not wait for idle inputs: their watermark follows the furthest of their inputs.

    Otherwise it follows the slowest, so an input without rows keeps all windows open. With `skip` rows of an input that
    wakes up behind the watermark are late and left out. The choice stays with the query's checkpoint.
    """
    before = spark.conf.get(_POLICY)
    spark.conf.set(_POLICY, "max" if skip else "min")
    try:
        yield
    finally:
        spark.conf.set(_POLICY, before)


# zstd instead of lz4, in the stores on the executors and in the checkpoint; stores of a query that has ended go sooner.
_PACKED = {"spark.sql.streaming.stateStore.compression.codec": "zstd",
           "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
           "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
           "spark.sql.streaming.stateStore.maintenanceInterval": "10s"}
_UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def packed_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started within keep their state packed closer: for states that are large and stay for good.

    A checkpoint keeps the codec it was started with.
    """
    return _settings(spark, _PACKED)


def uncounted_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started within do not count the rows of their state, which takes a look-up for each row written.

    Their progress then tells no `numRowsTotal`.
    """
    return _settings(spark, _UNCOUNTED)


def key_groups(spark: SparkSession, groups: int) -> AbstractContextManager[None]:
    """Streams with keyed history that are built within deal their keys to so many groups.

    A micro-batch costs a call per group it touches, so one of many rows does better with few. It rewrites the keys of these
    groups, so one of few rows does better with many. A checkpoint is bound to the number.
    """
    return _settings(spark, {history.GROUPS_CONF: str(groups)})


def each_batch(
    df: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None], once: bool = False,
    trigger: str = TRIGGER, mode: str = "append",
) -> StreamingQuery:
    """Run a batch function per micro-batch. It may be called again for the same batch id after a failure."""
    return writer(df, checkpoint, once, trigger, mode).foreachBatch(apply).start()


def with_live_config(
    df: DataFrame, checkpoint: str, read_config: Callable[[], DataFrame],
    apply: Callable[[DataFrame, DataFrame, int], None], once: bool = False, trigger: str = TRIGGER,
) -> StreamingQuery:
    """Run `apply(rows, config, batch id)` with the configuration read anew for every micro-batch."""
    return each_batch(df, checkpoint, lambda rows, batch: apply(rows, read_config(), batch), once, trigger)


def with_live_tables(
    df: DataFrame, checkpoint: str, read_tables: Callable[[], T], enrich: Callable[[DataFrame, T], DataFrame], path: str,
    once: bool = False, trigger: str = TRIGGER,
) -> StreamingQuery:
    """Append `enrich(rows, tables)` to the version log `path`, with the tables read anew for every micro-batch.

    Rows meet the tables as they are when the rows are written, so a dimension row added meanwhile is found. A
    repeated batch replaces its rows.
    """

    def apply(rows: DataFrame, batch: int) -> None:
        upserts.append(enrich(rows, read_tables()), path, batch)

    return each_batch(df, checkpoint, apply, once, trigger)


def with_lookups(
    df: DataFrame, checkpoint: str, find: Callable[[DataFrame], T], enrich: Callable[[DataFrame, T], DataFrame], path: str,
    once: bool = False, trigger: str = TRIGGER,
) -> StreamingQuery:
    """Append `enrich(rows, found)` to the version log `path`, where `found = find(rows)` looks up what the rows of a
    micro-batch need, such as `MergeTable.lookup`: the files read follow the keys that occur, not the tables."""

    def apply(rows: DataFrame, batch: int) -> None:
        settled = session.settled(rows)
        upserts.append(enrich(settled, find(settled)), path, batch)

    return each_batch(df, checkpoint, apply, once, trigger)
