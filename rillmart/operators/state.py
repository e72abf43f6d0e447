"""Per-key history operators. The custom state of their streaming forms lives in `rillmart.streaming.history`.

Batch frames hold the whole history, so state turns into ordering: `first_of_day` and `first_ever` keep one row per
key before the shuffle, `repair_is_new` needs two facts per visitor, `delta` looks one row back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import times
from ..streaming import history
from . import enrich, skew


def _first_by(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    # Spark turns row_number() = 1 into a per-task group limit ahead of the shuffle.
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_n = 1").drop("_n")


def first_of_day(
    df: DataFrame, keys: list[str], ts: str, order: tuple[str, ...] = (), zone: str | None = None,
    past: DataFrame | None = None,
) -> DataFrame:
    """The row with which each key appears for the first time on a day, in time order; ties fall to `order`.

    A stream may start from a batch, `past`, whose rows count as seen; so may the other functions of this module.

    In time order days never go back, so a row whose day differs from the previous row's day is exactly the first
    row of its (key, day). For other arrival orders use `day_changes`.
    """
    if df.isStreaming:
        return history.first_of_day(df, keys, ts, order, zone, past)
    return _first_by(df, [*map(F.col, keys), times.day(F.col(ts), zone)], [F.col(ts), *map(F.col, order)])


def day_changes(
    df: DataFrame, key: str, ts: str, arrival: list[str], zone: str | None = None, heavy: skew.Heavy | None = None
) -> DataFrame:
    """Rows whose day differs from the day of the key's previous row in arrival order (days may come back)."""
    dated = df.withColumn("_day_of", times.day(F.col(ts), zone))
    seen = skew.with_previous(dated, [key], arrival, ["_day_of"], heavy)
    return seen.filter(~F.col("_day_of").eqNullSafe(F.col("_prev._day_of"))).drop("_day_of", "_prev")


def first_ever(df: DataFrame, key: str, ts: str, order: tuple[str, ...] = (), forget: bool = False,
               past: DataFrame | None = None) -> DataFrame:
    """The first row of each key, in time order; ties fall to `order`.

    In a watermarked stream that is the earliest row of the micro-batch in which the key first arrives, whatever the
    order of its files. The seen keys are kept for ever, or with `forget` until the watermark has passed them.
    """
    if df.isStreaming:
        return history.first_ever(df, [key], ts, order, forget, past)
    return _first_by(df, [F.col(key)], [F.col(ts), *map(F.col, order)])


def daily_firsts(
    df: DataFrame, keys: list[str], ts: str, order: tuple[str, ...] = (), zone: str | None = None
) -> DataFrame:
    """First-of-day rows with `prev_day`, the last earlier day the key was seen on (null if none).

    In batch only one row per key and day enters the look-back, whatever the number of events.
    """
    if df.isStreaming:
        return history.day_changes(df, keys, ts, order, zone)
    firsts = first_of_day(df, keys, ts, order, zone).withColumn("_day", times.day(F.col(ts), zone))
    last_day = F.lag("_day").over(Window.partitionBy(*keys).orderBy("_day"))
    return firsts.withColumn("prev_day", last_day).drop("_day")


def is_back(ts: Column, prev_day: Column, days: int = 7, zone: str | None = None) -> Column:
    """Seen before, and more than `days` whole days have passed since the midnight of the last seen day."""
    midnight = times.date_to_ms(prev_day.cast("string"), zone)
    gap = F.floor((F.unix_millis(ts) - midnight) / F.lit(86_400_000))
    return F.coalesce(gap > days, F.lit(False))


def returning(
    df: DataFrame, keys: list[str], ts: str, order: tuple[str, ...] = (), days: int = 7, zone: str | None = None
) -> DataFrame:
    """First-of-day rows with `is_back`; `ts` must be a TIMESTAMP column."""
    firsts = daily_firsts(df, keys, ts, order, zone)
    return firsts.withColumn("is_back", is_back(F.col(ts), F.col("prev_day"), days, zone)).drop("prev_day")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """An upsert log read as a table: the last version of each key. `order` must be total within a key."""
    return _first_by(df, [F.col(k) for k in keys], [F.desc(c) for c in order])


def delta(
    df: DataFrame, keys: list[str], order: list[str], measures: list[str], heavy: skew.Heavy | None = None,
    ttl: str | None = None, past: DataFrame | None = None,
) -> DataFrame:
    """Replace each measure by its change since the key's previous version; the first version counts in full.

    With `ttl` (such as '30 seconds') so does a version later than that after the previous one; `order` then starts with
    the event time. In a stream it always does, watermarked, and measures must not be null.
    """
    if df.isStreaming:
        return history.delta(df, keys, order[0], order[1:], measures, ttl, past)
    looked_at = list(dict.fromkeys([*measures, *([order[0]] if ttl else [])]))
    seen = skew.with_previous(df, keys, order, looked_at, heavy)
    known = F.lit(True)
    if ttl:
        known = F.col(order[0]) <= F.col("_prev")[order[0]] + F.expr(f"INTERVAL {ttl}")
    for name in measures:
        kind = df.schema[name].dataType
        zero = F.lit(0).cast(kind)
        before = F.coalesce(F.when(known, F.col("_prev")[name]), zero)
        seen = seen.withColumn(f"_d_{name}", (F.coalesce(F.col(name), zero) - before).cast(kind))
    return seen.drop("_prev", *measures).withColumnsRenamed({f"_d_{m}": m for m in measures}).select(df.columns)


def repair_is_new(
    df: DataFrame,
    key: str,
    ts: str,
    flag: str,
    order: tuple[str, ...] = (),
    zone: str | None = None,
    heavy: skew.Heavy | None = None,
    facts_from: DataFrame | None = None,
    copies: bool = False,
    past: DataFrame | None = None,
) -> DataFrame:
    """Correct the new-visitor flag of each row from the visitor's history, in time order.

    A visitor who has shown up as old ('0') stays old. A visitor first seen as new ('1') on one day is old on later
    days. So two facts per visitor decide every row: the time of the first '0' and the day of the first '1'. They are
    aggregated before the shuffle, written to the checkpoint folder, and joined back: broadcast where they are measured as
    small, so that rows are not shuffled, otherwise with heavy visitors split. `facts_from` may give the same rows in a
    form that is cheaper to read for the two facts; `copies` is that of `skew.join`.
    """
    if df.isStreaming:
        return history.repair_is_new(df, [key], ts, flag, order, zone, past)
    moment = F.struct(F.col(ts), *map(F.col, order))
    day = times.day(F.col(ts), zone)
    facts = session.settled(
        (df if facts_from is None else facts_from).groupBy(key).agg(
            F.min(F.when(F.col(flag) == "0", moment)).alias("_first_old"),
            F.min(F.when(F.col(flag) == "1", day)).alias("_first_new_day"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    known_old = (F.col("_first_old") < moment) | (F.col("_first_new_day") < day)
    fixed = F.when((F.col(flag) == "1") & known_old, F.lit("0")).otherwise(F.col(flag))
    if heavy is None and enrich.small(facts):
        joined = df.join(F.broadcast(facts.drop("_rows")), key, "left")
    else:
        heavy = skew.heavy_from_counts(facts, [key], "_rows") if heavy is None else heavy
        joined = skew.join(df, facts.drop("_rows"), [key], "left", [ts, *order], heavy, copies)
    return joined.withColumn(flag, fixed).select(df.columns)
