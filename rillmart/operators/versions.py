"""Rows joined with the version of their key that was in force at their time.

A version holds from its time until the next one of its key. Few versions become intervals, which are broadcast behind
a check of their size, so the rows are not shuffled. Many are put between the rows in order of time, where each row takes
the last one before it; keys with very many rows are cut into chunks that hand their last version on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import enrich, skew

_AT, _KIND, _VERSION, _ROW, _TIE = "_as_of_at", "_as_of_kind", "_as_of_version", "_as_of_row", "_as_of_tie"
FOUND = "_version"


def intervals(versions: DataFrame, keys: list[str], at: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Versions with `_until`, the time of the next one of their key (null for the last).

    Of several of one moment the last by `order` counts. A null time is before all others.
    """
    of_moment = Window.partitionBy(*keys, at).orderBy(*[F.desc(name) for name in order] or [F.lit(1)])
    last = versions.withColumn("_n", F.row_number().over(of_moment)).filter("_n = 1").drop("_n")
    return last.withColumn("_until", F.lead(at).over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first(at))))


def as_of(rows: DataFrame, versions: DataFrame, keys: list[str], row_at: str, at: str, order: tuple[str, ...] = (),
          heavy: skew.Heavy | None = None, few: bool | None = None) -> DataFrame:
    """Rows with the struct `_version`: the version (all its columns) of their key in force at `row_at`, null if none.

    `rows` and `versions` have the key columns; `row_at` and `at` are times of one type, a version holds from `at` on. Rows
    with a null key or time have no version, versions with a null key are left out, and those with a null time hold
    from the beginning. `few` says whether versions are joined as intervals; by default that is measured. Streams can
    only meet few versions.
    """
    usable = versions.dropna(subset=keys)
    if rows.isStreaming or (few if few is not None else enrich.small(usable)):
        held = intervals(usable, keys, at, order).select(F.struct(*versions.columns).alias(FOUND), F.col("_until").alias("_as_of_until"))
        held = held if few is False else F.broadcast(held)
        here = (F.col(f"{FOUND}.{at}").isNull() & F.col(row_at).isNotNull()) | (F.col(row_at) >= F.col(f"{FOUND}.{at}"))
        same = [F.col(f"_as_of.{key}") == F.col(f"{FOUND}.{key}") for key in keys]
        matched = rows.alias("_as_of").join(
            held, [*same, here, F.col("_as_of_until").isNull() | (F.col(row_at) < F.col("_as_of_until"))], "left")
        return matched.drop("_as_of_until")
    kind = rows.schema[row_at].dataType
    first = F.lit({"date": "0001-01-01", "timestamp": "0001-01-01", "timestamp_ntz": "0001-01-01"}.get(
        kind.simpleString(), -(1 << 31))).cast(kind)
    of_row = rows.select(*keys, F.col(row_at).alias(_AT), F.lit(1).alias(_KIND), F.struct("*").alias(_ROW),
                         F.lit(None).cast(versions.schema).alias(_VERSION), F.xxhash64(*keys, row_at).alias(_TIE))
    ranked = intervals(usable, keys, at, order).select(
        *keys, F.coalesce(F.col(at).cast(kind), first).alias(_AT), F.lit(0).alias(_KIND),
        F.lit(None).cast(rows.schema).alias(_ROW), F.struct(*versions.columns).alias(_VERSION), F.lit(0).cast("bigint").alias(_TIE))
    known = F.col(_AT).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    found = skew.with_last(of_row.filter(known).unionByName(ranked), keys, [_AT, _KIND, _TIE], _VERSION, FOUND, heavy)
    without = of_row.filter(~known).withColumn(FOUND, F.lit(None).cast(versions.schema))
    return found.filter(F.col(_KIND) == 1).unionByName(without).select(f"{_ROW}.*", FOUND)
