"""Joins and windows that stay balanced when one key holds a large share of all rows.

Spark already handles skew where it can: `groupBy` combines before the shuffle, `row_number() <= k` filters keep at
most k rows per key before the shuffle, and AQE splits skewed partitions of sort-merge joins over two plain exchanges.
The functions here cover the rest. They look for keys with more than `limit` rows; there are at most
`total / limit` of them, so what is gathered and replicated is bounded by the input size over the task size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 5_000_000
MAX_HEAVY_KEYS = 20_000
# Bins of key hashes that are counted before the keys are.
BINS = 65_536

_HASH, _SALT, _PARTS, _CHUNK, _GHOST = "_key_hash", "_salt", "_parts", "_chunk", "_ghost"


@dataclass(frozen=True)
class Heavy:
    """Keys (by hash) with more rows than one task should hold, and how many tasks each needs."""

    parts: dict[int, int]
    limit: int = ROWS_PER_TASK

    def __bool__(self) -> bool:
        return bool(self.parts)

    def frame(self, df: DataFrame) -> DataFrame:
        schema = T.StructType([T.StructField(_HASH, T.LongType()), T.StructField(_PARTS, T.IntegerType())])
        return df.sparkSession.createDataFrame(list(self.parts.items()), schema)

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of heavy keys, of a frame that has the key hash. The keys, bounded in number, are joined as a table."""
        return df.join(F.broadcast(self.frame(df).select(_HASH)), _HASH, "left_semi")


def rows_per_task(df: DataFrame) -> int:
    """Setting `rillmart.skew.rowsPerTask`: the most rows of one key that a single task should get."""
    return int(df.sparkSession.conf.get("rillmart.skew.rowsPerTask", str(ROWS_PER_TASK)))


def heavy_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> Heavy:
    """Find heavy keys of a batch frame. Call it on frames close to a scan: it reads the key columns once.

    A table with at most `limit` rows has none; then only the row count is taken, which for a plain scan comes
    from file metadata. Otherwise bins of keys are counted first, and keys only in bins above `limit`: mostly none, so the
    keys are not shuffled. Nothing is sampled.
    """
    if df.isStreaming:
        return Heavy({})
    limit = limit or rows_per_task(df)
    if df.count() <= limit:
        return Heavy({})
    hashed = df.select(F.xxhash64(*keys).alias(_HASH))
    # A key cannot have more rows than its bin, and bins are counted without shuffling the keys.
    own = F.pmod(F.col(_HASH), F.lit(BINS))
    full = hashed.groupBy(own.alias("_bin")).count().filter(F.col("count") > limit).select("_bin").collect()
    if not full:
        return Heavy({})
    if len(full) <= BINS // 16:
        bins = df.sparkSession.createDataFrame(full, "_bin bigint")
        hashed = hashed.withColumn("_bin", own).join(F.broadcast(bins), "_bin", "left_semi").drop("_bin")
    return heavy_from_counts(hashed.groupBy(_HASH).count(), [], "count", limit)


def heavy_from_counts(counts: DataFrame, keys: list[str], count: str, limit: int | None = None) -> Heavy:
    """Heavy keys from a table that already holds the row count of each key.

    At most MAX_HEAVY_KEYS are taken, the largest ones; what is left out weighs less than a share of
    1 / MAX_HEAVY_KEYS of all rows and goes through whole.
    """
    limit = limit or rows_per_task(counts)
    key_hash = F.xxhash64(*keys) if keys else F.col(_HASH)
    largest = (
        counts.filter(F.col(count) > limit)
        .select(key_hash.alias(_HASH), F.col(count).alias("n"))
        .orderBy(F.desc("n"))
        .limit(MAX_HEAVY_KEYS)
        .collect()
    )
    size = max(limit, sum(row["n"] for row in largest) // MAX_HEAVY_KEYS)
    return Heavy({row[_HASH]: math.ceil(row["n"] / size) for row in largest if row["n"] > size}, size)


def join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    heavy: Heavy | None = None,
    copies: bool = False,
) -> DataFrame:
    """Equi-join for a left side with heavy keys, where AQE cannot split it (a side already partitioned by the key).

    Rows of a heavy key are spread over several tasks by a hash of `spread` (a row id; all columns by default) and
    the matching right rows are repeated once per task. Other keys go through unchanged. `how` is inner, left,
    left_semi or left_anti. With `copies` exact copies of a row are spread too, by their position: only for a left side
    read straight from storage, whose rows come in the same order when a task runs again.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a split join cannot be {how}")
    heavy = heavy_keys(left, on) if heavy is None else heavy
    if not heavy:
        return left.join(right, on, how)
    parts = heavy.frame(left)
    row_hash = F.xxhash64(*(spread or left.columns), *([F.monotonically_increasing_id()] if copies else []))
    salted_left = (
        left.withColumn(_HASH, F.xxhash64(*on))
        .join(parts, _HASH, "left")
        .withColumn(_SALT, F.coalesce(F.pmod(row_hash, F.col(_PARTS)).cast("int"), F.lit(0)))
        .drop(_HASH, _PARTS)
    )
    salted_right = (
        right.withColumn(_HASH, F.xxhash64(*on))
        .join(parts, _HASH, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)))
        .drop(_HASH, _PARTS)
    )
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)


def _cut_points(df: DataFrame, keys: list[str], first: str, heavy: Heavy) -> DataFrame:
    """For each heavy key, values of the first order column that cut its rows into even parts, in ascending order.

    A key of p parts gets p - 1 cuts, so all keys together have at most `total / limit` of them.
    """
    most = max(heavy.parts.values())
    # One literal however many shares there are.
    shares = F.split(F.lit(",".join(str(i / most) for i in range(1, most))), ",").cast("array<double>")
    own_share = F.transform(
        F.sequence(F.lit(1), F.col(_PARTS) - 1),
        lambda i: F.element_at("all_cuts", F.ceil(i * F.lit(most - 1) / F.col(_PARTS)).cast("int")),
    )
    found = (
        df.select(F.xxhash64(*keys).alias(_HASH), F.col(first).alias("v"))
        .transform(heavy.only)
        .groupBy(_HASH)
        .agg(F.percentile_approx("v", shares, max(10_000, 10 * most)).alias("all_cuts"))
        .join(heavy.frame(df), _HASH)
        .select(_HASH, F.array_distinct(own_share).alias("cuts"))
    )
    # Fixed here once: all uses must see the same cuts, also after an executor is lost.
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def _passed(rows: DataFrame, of: str, cuts: DataFrame, value: str, name: str, equal: bool = False) -> DataFrame:
    """Add `name`: how many cuts of the row's key hash (column `of`) are below its value, or with `equal` not above it.

    It is null for keys without cuts. Cuts lie in blocks of about the square root of their number. A row meets the last
    cut of each full block, then the cuts of its own block, by bisection in both, so what a row carries and compares
    hardly grows with the number of parts. Cuts are bounded as heavy keys are, and broadcast.
    """
    cuts = cuts.filter(F.size("cuts") > 0).withColumn("_width", F.ceil(F.sqrt(F.size("cuts"))).cast("int"))
    longest = cuts.agg(F.max("_width")).first()[0]
    if longest is None:
        return rows.withColumn(name, F.lit(None).cast("int"))
    # Full blocks may be one more than the width.
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range((longest + 1).bit_length()))])

    def passed(of_row: str):
        def further(at, step):
            cut = F.get(F.col(of_row), at + step - 1)
            return F.when(cut <= F.col(value) if equal else cut < F.col(value), at + step).otherwise(at)

        return F.aggregate(steps, F.lit(0), further)

    width, size = F.col("_width"), F.size("cuts")
    lasts = F.transform(F.sequence(F.lit(1), F.floor(size / width)), lambda i: F.element_at("cuts", (i * width).cast("int")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / width)),
                         lambda i: F.slice("cuts", (i * width + 1).cast("int"), width))
    outer = cuts.select(F.col(_HASH).alias(of), "_width", lasts.alias("_lasts"))
    inner = cuts.select(F.col(_HASH).alias(of), F.posexplode(blocks).alias("_block", "_of_block"))
    return (
        rows.join(F.broadcast(outer), of, "left")
        .withColumn("_block", passed("_lasts"))
        .drop("_lasts")
        .join(F.broadcast(inner), [of, "_block"], "left")
        .withColumn(name, F.col("_block") * width + passed("_of_block"))
        .drop("_width", "_block", "_of_block")
    )


_CUTTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _chunked(df: DataFrame, keys: list[str], order: list[str], heavy: Heavy) -> DataFrame:
    """Add `_key_hash` and `_chunk`: consecutive ranges of a heavy key's rows, one range for all other keys.

    Ranges follow the first order column. Where one of its values alone is too much, that value becomes the upper end
    of its range, and its rows are cut further by the second order column.
    """
    rows = df.withColumn(_HASH, F.xxhash64(*keys))
    cuts = _cut_points(df, keys, order[0], heavy)
    rows, tied = rows.withColumn("_part", F.lit(0)), Heavy({})
    if len(order) > 1 and isinstance(df.schema[order[1]].dataType, _CUTTABLE):
        hot_rows = rows.transform(heavy.only)
        group = [*keys, order[0]]
        counts = hot_rows.groupBy(_HASH, *group).count()
        tied = heavy_from_counts(counts.drop(_HASH), group, "count", heavy.limit)
    if tied:
        ends = (
            counts.withColumnRenamed(_HASH, "_of_key").withColumn(_HASH, F.xxhash64(*group)).transform(tied.only)
            .drop(_HASH).withColumnRenamed("_of_key", _HASH)
            .groupBy(_HASH)
            .agg(F.collect_set(order[0]).alias("ends"))
        )
        both = F.concat("cuts", F.coalesce("ends", F.array()))
        with_ends = cuts.join(ends, _HASH, "left").select(_HASH, F.array_sort(F.array_distinct(both)).alias("cuts"))
        cuts = df.sparkSession.createDataFrame(with_ends.collect(), cuts.schema)
        inner = _cut_points(df, group, order[1], tied)
        rows = _passed(rows.withColumn("_group_hash", F.xxhash64(*group)), "_group_hash", inner, order[1], "_part")
        # Part 0 holds the rows of a range below its upper end.
        rows = rows.withColumn("_part", F.coalesce(F.col("_part") + 1, F.lit(0)))
    return (
        _passed(rows, _HASH, cuts, order[0], "_range")
        .withColumn(_CHUNK, F.struct(F.coalesce("_range", F.lit(0)).alias("range"), F.col("_part").alias("part")))
        .drop("_range", "_part", "_group_hash")
    )


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str], heavy: Heavy | None = None
) -> DataFrame:
    """Add struct `_prev` holding `columns` of the previous row of the same key.

    `order` must be total within a key and start with a number, date or timestamp. Rows of a heavy key are cut into
    consecutive chunks; the last row of each chunk is handed to the next one, so a chunk never needs more than its own
    rows.
    """
    previous = F.lag(F.struct(*columns))
    heavy = heavy_keys(df, keys) if heavy is None else heavy
    if not heavy:
        return df.withColumn("_prev", previous.over(Window.partitionBy(*keys).orderBy(*order)))

    chunked = _chunked(df, keys, order, heavy)
    carried = list(dict.fromkeys([*order, *columns]))
    lasts = (
        chunked.transform(heavy.only)
        .groupBy(*keys, _HASH, _CHUNK)
        .agg(F.max_by(F.struct(*carried), F.struct(*order)).alias("_last"))
        .withColumn(_CHUNK, F.lead(_CHUNK).over(Window.partitionBy(*keys).orderBy(_CHUNK)))
        .filter(F.col(_CHUNK).isNotNull())
        .select(*keys, _HASH, _CHUNK, *[F.col("_last")[c].alias(c) for c in carried if c not in keys])
    )
    rows = chunked.withColumn(_GHOST, F.lit(False)).unionByName(
        lasts.withColumn(_GHOST, F.lit(True)), allowMissingColumns=True
    )
    in_chunk = Window.partitionBy(*keys, _CHUNK).orderBy(F.desc(_GHOST), *order)
    return (
        rows.withColumn("_prev", previous.over(in_chunk)).filter(~F.col(_GHOST)).drop(_HASH, _CHUNK, _GHOST)
    )


def numbered(
    df: DataFrame, keys: list[str], order: list[Column], by: str, name: str, heavy: Heavy | None = None
) -> DataFrame:
    """Running number per key, from 1, in descending order of number column `by`, then `order`.

    Heavy keys are cut into value ranges of `by`; each range numbers its own rows and adds the sizes of the ranges
    above it.
    """
    ordering = [F.desc(by), *order]
    heavy = heavy_keys(df, keys) if heavy is None else heavy
    if not heavy:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)).cast("bigint"))
    cuts = _cut_points(df, keys, by, heavy)
    # Ranges of larger values come first; null, which passes no cut, is in the last one.
    chunked = _passed(df.withColumn(_HASH, F.xxhash64(*keys)), _HASH, cuts, by, _CHUNK, equal=True).withColumn(
        _CHUNK, -F.coalesce(_CHUNK, F.lit(0)))
    # One small row per key and range; only heavy keys have more than one range.
    offsets = (
        chunked.transform(heavy.only)
        .groupBy(_HASH, *keys, _CHUNK)
        .count()
        .withColumn(
            "_before",
            F.sum("count").over(
                Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*keys, _CHUNK, "_before")
    )
    local = F.row_number().over(Window.partitionBy(*keys, _CHUNK).orderBy(*ordering))
    return (
        chunked.withColumn(name, local)
        .join(offsets, [*keys, _CHUNK], "left")
        .withColumn(name, (F.col(name) + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint"))
        .drop(_HASH, _CHUNK, "_before")
    )


def with_last(
    df: DataFrame, keys: list[str], order: list[str], column: str, name: str, heavy: Heavy | None = None
) -> DataFrame:
    """Add `name`: the last non-null value of struct column `column` at or before each row of the same key.

    `order` must be total within a key and start with a number, date or timestamp. Rows of a heavy key are cut into
    consecutive chunks; each hands the last value it knows to the next one.
    """
    heavy = heavy_keys(df, keys) if heavy is None else heavy
    up_to_row = Window.unboundedPreceding, Window.currentRow
    if not heavy:
        of_key = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*up_to_row)
        return df.withColumn(name, F.last(column, ignorenulls=True).over(of_key))
    chunked = _chunked(df, keys, order, heavy)
    moment = F.when(F.col(column).isNotNull(), F.struct(*order))
    ends = (
        chunked.transform(heavy.only)
        .groupBy(*keys, _HASH, _CHUNK)
        .agg(F.max_by(column, moment).alias(column))
    )
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.withColumn(column, F.last(column, ignorenulls=True).over(before)).filter(F.col(column).isNotNull())
    rows = chunked.withColumn(_GHOST, F.lit(False)).unionByName(
        handed.withColumn(_GHOST, F.lit(True)), allowMissingColumns=True)
    in_chunk = Window.partitionBy(*keys, _CHUNK).orderBy(F.desc(_GHOST), *order).rowsBetween(*up_to_row)
    found = rows.withColumn(name, F.last(column, ignorenulls=True).over(in_chunk))
    return found.filter(~F.col(_GHOST)).drop(_HASH, _CHUNK, _GHOST)
