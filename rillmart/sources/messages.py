"""Message topics: one row per message, its UTF-8 text in `value`, and on request where it stands in its topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values


# What one micro-batch of a stream reads at most; the rest waits for the next one.
BATCH_MESSAGES = 10_000_000
BATCH_FILES = 1_000


#: Columns of a message's place. Offsets order the messages of one partition, so of one key.
KAFKA_PLACE = ("partition", "offset")
#: Files are ordered by the time they were written, then by name. Rows of one file share their place.
FILE_PLACE = ("file_time", "file_name")


def kafka(
    spark: SparkSession, servers: str, topic: str, stream: bool = True, place: bool = False, **options: str
) -> DataFrame:
    """A topic from its earliest offset; keys and headers are dropped. Needs Spark's Kafka connector package.

    With `place` the columns KAFKA_PLACE are kept, for operators defined by order of arrival.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **({"maxOffsetsPerTrigger": str(BATCH_MESSAGES)} if stream else {}),
        **options,
    }
    kept = KAFKA_PLACE if place else ()
    return reader.options(**settings).load().select(F.col("value").cast("string").alias("value"), *kept)


def files(
    spark: SparkSession, path: str, stream: bool = True, place: bool = False, **options: str
) -> DataFrame:
    """JSON-lines files as messages, one per line; with `place` the columns FILE_PLACE are added."""
    reader = (spark.readStream if stream else spark.read).format("text")
    if stream:
        reader = reader.schema("value string").option("maxFilesPerTrigger", BATCH_FILES)
    lines = reader.options(**options).load(path)
    if not place:
        return lines
    where = (F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"))
    return lines.select("value", *[column.alias(name) for column, name in zip(where, FILE_PLACE)])


def as_table(
    messages: DataFrame, schema: T.StructType | str, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """A JSON topic as a table; fields a message lacks are null. `keep` names message columns to carry along."""
    parsed = values.compute_once(messages, *keep, _j=F.from_json(value, schema))
    return parsed.filter(F.col("_j").isNotNull()).select("_j.*", *keep)
