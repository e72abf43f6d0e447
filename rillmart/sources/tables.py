"""Topics read as typed tables, configuration feeds, and static tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import naming, times
from ..operators import cdc, windows
from . import messages as m


def change_records(messages: DataFrame, delay: str = "5 seconds", mode: str = "drop") -> DataFrame:
    """The change-record topic as an envelope table with event time `row_time` and processing time `proc_time`."""
    parsed = cdc.parse(messages, mode=mode).withColumn("proc_time", F.current_timestamp())
    return windows.watermarked(parsed, "row_time", delay)


def page_log(messages: DataFrame, delay: str = "5 seconds") -> DataFrame:
    """The page topic as a table: `page` as a map, `ts` in milliseconds, event time `et`."""
    rows = m.as_table(messages, "page map<string,string>, ts bigint")
    return windows.watermarked(rows.withColumn("et", times.from_epoch(F.col("ts"), "ms")), "et", delay)


def order_details(
    messages: DataFrame, delay: str | None = "5 seconds", place: tuple[str, ...] = ()
) -> DataFrame:
    """The order-detail topic as a version log with `row_time`. It holds upserts: see `plans.dwd.detail_table`.

    `place` names message columns that order the versions of a line, such as `messages.KAFKA_PLACE`.
    """
    rows = m.as_table(messages, schemas.ORDER_DETAIL_TOPIC, keep=place)
    return windows.watermarked(rows.withColumn("row_time", times.from_epoch(F.col("ts"), "s")), "row_time", delay)


def config_feed(messages: DataFrame, config: T.StructType) -> DataFrame:
    """Change feed of a configuration table: op, before, after and the change time `ts_ms`."""
    feed = T.StructType([*schemas.config_change(config).fields, T.StructField("ts_ms", T.LongType())])
    return m.as_table(messages, feed)


def jdbc(spark: SparkSession, url: str, table: str, camel: bool = False, **options: str) -> DataFrame:
    """A database table. Give partitionColumn, lowerBound, upperBound and numPartitions for a parallel read."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return naming.to_camel(df) if camel else df


def parquet(spark: SparkSession, path: str, camel: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    return naming.to_camel(df) if camel else df


def code_table(df: DataFrame, code: str = "dic_code", name: str = "dic_name") -> DataFrame:
    """A flat code table in nested form: rowkey, info.dic_name."""
    return df.select(
        F.col(code).cast("string").alias("rowkey"), F.struct(F.col(name).alias("dic_name")).alias("info")
    )
