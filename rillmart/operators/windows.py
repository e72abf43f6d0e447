"""Tumbling event-time windows with stamped bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times


def watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """Set the allowed out-of-orderness; batch frames need none."""
    return df.withWatermark(ts, delay) if df.isStreaming and delay else df


def stamp(
    df: DataFrame, as_of: str | None = None, zone: str | None = None, window: str = "window"
) -> DataFrame:
    """Replace the window column by text columns stt, edt and cur_date (the report day, today by default)."""
    others = [name for name in df.columns if name != window]
    return df.select(
        times.text(F.col(f"{window}.start"), times.DATE_TIME, zone).alias("stt"),
        times.text(F.col(f"{window}.end"), times.DATE_TIME, zone).alias("edt"),
        times.as_of_day(as_of).alias("cur_date"),
        *others,
    )


def tumble(
    df: DataFrame,
    ts: str,
    size: str,
    keys: list[str],
    aggs: list[Column],
    delay: str | None = None,
    as_of: str | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Aggregate per window and keys. Aggregates are combined before the shuffle, also without keys."""
    grouped = watermarked(df, ts, delay).groupBy(F.window(ts, size), *keys).agg(*aggs)
    return stamp(grouped, as_of, zone)


def tumble_distinct(
    df: DataFrame,
    ts: str,
    size: str,
    keys: list[str],
    item: str,
    count_as: str,
    sums: tuple[str, ...] = (),
    delay: str | None = None,
    as_of: str | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Exact count of distinct `item` and sums per window and keys, in batch and in streams.

    First one row per window, keys and item, then the count of those rows: no set is ever built, and a hot group is
    spread over tasks by its items.
    """
    items = distinct_items(df, ts, size, keys, item, sums, delay)
    return count_items(items, keys, item, count_as, sums, as_of, zone)


def distinct_items(
    df: DataFrame, ts: str, size: str, keys: list[str], item: str, sums: tuple[str, ...] = (), delay: str | None = None
) -> DataFrame:
    """The first step of `tumble_distinct`: one row per window, keys and item, with the sums.

    An appending stream gives all rows of a window in the micro-batch that closes it. So `count_items` may count each
    micro-batch as a batch, without a state of its own.
    """
    return (
        watermarked(df, ts, delay)
        .groupBy(F.window(ts, size), *keys, item)
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(name).alias(name) for name in sums])
    )


def count_items(
    items: DataFrame, keys: list[str], item: str, count_as: str, sums: tuple[str, ...] = (), as_of: str | None = None,
    zone: str | None = None,
) -> DataFrame:
    """The second step of `tumble_distinct`."""
    grouped = items.groupBy("window", *keys).agg(
        F.count(item).alias(count_as), *[F.sum(name).alias(name) for name in sums]
    )
    return stamp(grouped, as_of, zone)
