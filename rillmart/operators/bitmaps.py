"""Distinct counts that roll up: one bitmap of ids per window, combined from short windows to long ones.

Ids are whole numbers. A bitmap is one number, the 64 bits of a range of 64 ids (a bucket), so a window holds one short row per
range that occurs in it, never more than it has ids, and windows of any length are counted exactly from the short ones
without the details being read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times

BUCKET, BITS = "bucket", "bits"
# Ids of a bucket, as a power of two.
_IDS = 6


def construct(df: DataFrame, ts: str, size: str, keys: list[str], id_: str, delay: str | None = None) -> DataFrame:
    """stt, edt (timestamps), the keys, bucket and bits: the ids seen per window of `size`. Null ids and times count nowhere.

    Bitmaps are combined per task before the shuffle. In a stream `delay` is the watermark; windows come out once they close.
    """
    rows = df.filter(F.col(id_).isNotNull() & F.col(ts).isNotNull())
    if df.isStreaming and delay is not None:
        rows = rows.withWatermark(ts, delay)
    number = F.col(id_).cast("bigint")
    place = number.bitwiseAND(F.lit((1 << _IDS) - 1)).cast("int")
    marked = rows.withColumn(BUCKET, F.shiftright(number, _IDS)).withColumn("_place", place).withColumn(
        "_bit", F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_place")))
    grouped = marked.groupBy(F.window(ts, size).alias("_w"), *keys, BUCKET).agg(F.bit_or("_bit").alias(BITS))
    return grouped.select(F.col("_w.start").alias("stt"), F.col("_w.end").alias("edt"), *keys, BUCKET, BITS)


def roll_up(bitmaps: DataFrame, size: str, keys: list[str]) -> DataFrame:
    """The same table for longer windows; `size` must be a multiple of the windows of `bitmaps`. Keys left out are merged."""
    grouped = bitmaps.groupBy(F.window("stt", size).alias("_w"), *keys, BUCKET).agg(F.bit_or(BITS).alias(BITS))
    return grouped.select(F.col("_w.start").alias("stt"), F.col("_w.end").alias("edt"), *keys, BUCKET, BITS)


def counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact distinct ids per window and keys, with the window as text."""
    summed = bitmaps.groupBy("stt", "edt", *keys).agg(F.sum(F.bit_count(BITS)).alias(name))
    return summed.select(*[times.text(F.col(c)).alias(c) for c in ("stt", "edt")], *keys, name)
