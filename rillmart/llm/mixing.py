"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, settled

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = 20_251


def quality(size: Column, chars: Column) -> Column:
    """A weight between 0.25 and 1 from size and shape: short texts and texts of odd word lengths weigh less."""
    length = F.try_divide(chars, size)
    return F.when(size < 20, 0.5).otherwise(1.0) * F.when(length.between(3, 12), 1.0).otherwise(0.5)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """Add `target` to a table with source and source_size, one row per source.

    Sources in code-point order, null last, weigh `weights`, repeating. They share `share` of all sizes by weight; a target
    stops at `most` times its source's size and the excess goes to the others by weight, until none is above. That is
    one common level per unit of weight: with the sources in order of size per weight, the first level that fits.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", F.get(pattern, (F.row_number().over(order) - 1) % len(weights)))
    ranked = ranked.withColumn("cap", most * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    )
    leveled = ranked.withColumn("level", level)
    fits = F.min(F.when(F.col("level") * F.col("w") < F.col("cap"), F.struct("rank", "level"))).over(everything)
    chosen = leveled.withColumn("rank", F.row_number().over(by_cap)).withColumn("fit", fits)
    target = F.when(F.col("rank") < F.col("fit.rank"), F.col("cap")).otherwise(F.col("fit.level") * F.col("w"))
    return chosen.select(*sizes.columns, F.coalesce(target, F.col("cap")).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        weight: Column | None = None, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: the key, source, size, source_size, target, times, taken.

    A size is a number of words (null text: 0). Complete epochs of a source come first; the rest of its target is drawn
    in order of exponential keys, scaled by quality weights: documents enter while more than half of each lies within
    the budget, so a source misses its target by half a document at most. `times` says how often the mix takes
    the document, `taken` is times * size.

    Prefix sums are taken in two levels: each source is cut into about as many key ranges as each range has rows
    (the square root of its count), ranges are summed first, and a window adds up the rows within one range only. Ranges
    follow the distribution of the source's keys, which its counts of rows per weight give, so they are even whatever
    the weights are. Only the source table, one row per source, is ordered in one task.

    The draw depends on `seed`, key and weight alone, so reruns agree; ties go by key, then size, and rows equal in both
    count as any order. Null sources are a source. Sources without words have target 0. Texts of any length are taken
    whole. An empty table gives no rows. Other columns are ignored, whatever their names.
    `weight` (a column over docs, from 0 exclusive to 1) replaces the built-in quality; null weighs 1.
    """
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")
    own = quality(F.col("size"), F.col("chars")) if weight is None else F.coalesce(F.col("weight"), F.lit(1.0))
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("key")), 11).cast("double") + 0.5) / float(2**53)
    rows = settled(
        docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words.alias("size"),
                    F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
                    (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight"))
        .select("key", "source", _label("source"), "size", own.alias("weight"), (-F.log(unit) / own).alias("at")),
        "sizes",
    )
    # Weights within a fifth of each other count as one.
    about = F.greatest(F.floor(4 * F.log2("weight")), F.lit(-256))
    per_weight = rows.groupBy("label", about.alias("about")).agg(
        F.first("source").alias("source"), F.sum("size").alias("size"), F.count("*").alias("n"), F.avg("weight").alias("weight"))
    totals = settled(
        per_weight.groupBy("label").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.sum("n").alias("n"),
                                        F.collect_list(F.struct("n", "weight")).alias("mixture")), "sources")
    plan = targets(totals, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = settled(
        plan.withColumn("epochs", epochs.cast("int"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("ranges", F.ceil(F.sqrt("n"))).drop("source"),
        "targets",
    )
    known = _with_source(rows, plan).withColumn(
        "range", F.least(F.floor(below(F.col("at"), F.col("mixture")) / F.col("n") * F.col("ranges")), F.col("ranges") - 1))
    ranges = known.groupBy("label", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("label").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = settled(
        ranges.select("label", "range", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("before")), "ranges")
    within = Window.partitionBy("label", "range").orderBy("at", "key", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = known.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, ["label", "range"])
    drawn = (F.col("before") + F.col("inside") + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    return placed.withColumn("times", F.col("epochs") + drawn.cast("int")).select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "times",
        (F.col("times") * F.col("size")).cast("bigint").alias("taken"),
    )


def below(at: Column, mixture: Column) -> Column:
    """How many keys of a source are expected up to `at`; its rows per weight are the array `mixture` of (n, weight)."""
    return F.aggregate(mixture, F.lit(0.0), lambda acc, part: acc + part["n"] * (1 - F.exp(-at * part["weight"])))


def _label(source: str) -> Column:
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("label")


def _with_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan. The plan, one row per source, is repeated once per salt and rows are dealt by
    source and salt, so that a source with a large share of all rows meets it in many tasks."""
    salts = 64
    spread = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key", "size"), F.lit(salts)).cast("int"))
    return salted.join(spread, ["label", "salt"]).drop("salt")
