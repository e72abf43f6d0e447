"""Words of texts without blanks, cut by a dictionary.

Substrings of each run of characters are joined with the dictionary; among the words found, the cut that covers most
characters with the fewest words is taken. Runs are cut once each, however many rows hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 32


def _found(runs: DataFrame, dictionary: DataFrame, longest: int) -> DataFrame:
    """(run, start, end) of every dictionary word in every run; places count from 0, `end` is after the word."""
    size = F.char_length("run")
    starts = runs.select("run", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    ends = F.sequence(F.col("start") + 1, F.least(F.col("start") + longest, size))
    pieces = starts.select("run", "start", F.explode(ends).alias("end"))
    word = F.substring(F.col("run"), F.col("start") + 1, F.col("end") - F.col("start"))
    return pieces.withColumn("word", word).join(dictionary, "word").select("run", "start", "end")


def _islands(found: DataFrame) -> DataFrame:
    """Words that overlap one another, and so must be chosen among: one row per island with its words, relative to its start."""
    in_order = Window.partitionBy("run").orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1))
    marked = found.withColumn("opens", opens).withColumn("island", F.sum("opens").over(in_order))
    first = F.min("start").over(Window.partitionBy("run", "island"))
    return marked.withColumn("first", first).groupBy("run", "island").agg(
        F.min("start").alias("from"), F.max("end").alias("to"),
        F.collect_list(F.struct((F.col("start") - F.col("first")).alias("start"), (F.col("end") - F.col("first")).alias("end")))
        .alias("words"))


def _best(words: Column, size: Column) -> Column:
    """The ends of a cut that covers most characters with the fewest words, then the longest last word: an array over
    places 0 to `size` of (covered, -words, from, word)."""
    step = "struct<covered:int, words:int, start:int, word:boolean>"

    def choose(best: Column, end: Column) -> Column:
        left = F.get(best, end - 1)
        bare = F.struct(left["covered"], left["words"], (end - 1).cast("int"), F.lit(False)).cast(step)
        ending = F.transform(F.filter(words, lambda w: w["end"] == end), lambda w: F.struct(
            F.get(best, w["start"])["covered"] + (end - w["start"]).cast("int"), F.get(best, w["start"])["words"] - 1,
            (-w["start"]).cast("int"), F.lit(True)).cast(step))
        chosen = F.array_max(F.concat(F.array(F.struct(
            bare["covered"], bare["words"], F.lit(-(1 << 30)), bare["word"]).cast(step)), ending))
        return F.when(chosen["word"], F.struct(chosen["covered"], chosen["words"], -chosen["start"], chosen["word"]).cast(step)).otherwise(bare)

    origin = F.array(F.struct(F.lit(0), F.lit(0), F.lit(0), F.lit(False)).cast(step))
    return F.aggregate(F.sequence(F.lit(1), size), origin, lambda best, end: F.concat(best, F.array(choose(best, end))))


def _cut(best: Column, size: Column) -> Column:
    """The words of the best cut as (start, end), from the last place back."""
    state = "struct<at:int, cut:array<struct<start:int, end:int>>>"
    start = F.struct(size.cast("int"), F.array()).cast(state)

    def back(state_: Column, _: Column) -> Column:
        here = F.get(best, state_["at"])
        word = F.array(F.struct(here["start"], state_["at"])).cast("array<struct<start:int, end:int>>")
        return F.when(state_["at"] <= 0, state_).otherwise(F.struct(
            here["start"], F.when(here["word"], F.concat(word, state_["cut"])).otherwise(state_["cut"])).cast(state))

    return F.aggregate(F.sequence(F.lit(1), size), start, back)["cut"]


def cut_runs(runs: DataFrame, dictionary: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(run, words) for each different value of column `run`: its dictionary words and what lies between them, in order.

    `dictionary` has a column `word`; words of more than `longest` characters are not looked for, so a run gives at
    most that many substrings per character. Of all cuts the one that covers most characters counts, then fewer words,
    then a longer last word. Characters in no word stay together as they stand. Runs without any word stay whole; null and
    empty runs have no words.
    """
    different = runs.select("run").filter("run <> ''").distinct()
    known = dictionary.select("word").filter("word <> ''").filter(F.char_length("word") <= longest).distinct()
    best = _islands(_found(different, known, longest)).withColumn("size", F.col("to") - F.col("from")).withColumn(
        "best", _best(F.col("words"), F.col("size")))
    cuts = best.select("run", F.explode(F.transform(_cut(F.col("best"), F.col("size")), lambda w: F.struct(
        (w["start"] + F.col("from")).alias("start"), (w["end"] + F.col("from")).alias("end")))).alias("w"))
    of_run = cuts.groupBy("run").agg(F.sort_array(F.collect_list("w")).alias("cut"))
    joined = different.join(of_run, "run", "left")
    cut = F.coalesce("cut", F.array().cast("array<struct<start:int, end:int>>"))
    size = F.char_length("run")
    # Between and around the words lie the rests; places run from one end to the next start.
    froms = F.concat(F.array(F.lit(0)), F.transform(cut, lambda w: w["end"]))
    tos = F.concat(F.transform(cut, lambda w: w["start"]), F.array(size))
    rests = F.transform(F.arrays_zip(froms.alias("start"), tos.alias("end")), lambda g: F.struct(g["start"].cast("int").alias("start"), g["end"].cast("int").alias("end")))
    places = F.sort_array(F.concat(cut, F.filter(rests, lambda g: g["end"] > g["start"])))
    words = F.transform(places, lambda p: F.substring(F.col("run"), p["start"] + 1, p["end"] - p["start"]))
    return joined.select("run", words.alias("words"))
