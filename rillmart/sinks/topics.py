"""Writing rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import naming
from ..streaming import queries


def as_json(df: DataFrame, drop: tuple[str, ...] = (), key: str | None = None) -> DataFrame:
    """Typed rows as snake_case JSON in `value`, without the `drop` columns; optionally with a message key."""
    rows = naming.to_snake(df.drop(*drop))
    body = F.to_json(F.struct(*rows.columns)).alias("value")
    return rows.select(body) if key is None else rows.select(F.col(key).cast("string").alias("key"), body)


def routed(df: DataFrame, topic: str = "sink_table", payload: str = "data") -> DataFrame:
    """Rows with their own destination: `topic` and the JSON of `payload` alone."""
    body: Column = F.to_json(payload)
    return df.select(F.col(topic).alias("topic"), body.alias("value"))


def kafka(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None, **options: str) -> StreamingQuery:
    """Messages to Kafka, at least once. Rows need a `topic` column when no topic is given."""
    writer = queries.writer(df, checkpoint).format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return writer.options(**options).start()


def files(
    df: DataFrame, path: str, checkpoint: str, once: bool = False, partition: list[str] | None = None,
    format: str = "json",
) -> StreamingQuery:
    """Rows to files, exactly once. `partition=['topic']` gives each destination its own folder."""
    writer = queries.writer(df, checkpoint, once).format(format).option("path", path)
    return (writer.partitionBy(*partition) if partition else writer).start()
