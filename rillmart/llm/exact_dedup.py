"""Exact deduplication by a tree merge of digest runs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import lower_ascii, settled

FAN_IN = 2


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest",
                fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of `docs`: the key, keep_id, group_size, kept, text_sha256.

    Each input partition is a run of digests. Runs merge in binomial rounds, `fan_in` at a time, until one is left: the
    rows of a round are dealt by run and digest, sorted, and streamed in that order, rows of one digest, hash and length becoming one
    with the key to keep and the count. The first round combines each partition's rows before its shuffle, so that
    later ones hold a digest once per run and no round sees a hot key. Repeated digests go back to the rows by
    a join of two plain exchanges, which AQE splits when one digest holds a large share of all rows.

    A digest is the SHA-256 of the text, lower-cased for A-Z only, and counts as equal only if a second, independent
    hash and the length in bytes agree at every level. Null and empty texts are equal. `keep` is 'largest' or
    'smallest' key. Rows with the same key and text count singly in group_size and are kept or dropped together. A
    null key is kept only where all keys of its group are null. Texts of any length are one digest. An empty table
    gives no rows. Other columns are ignored, whatever their names.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep}")
    best = F.max if keep == "largest" else F.min
    plain = lower_ascii(F.col(text))
    same = ["digest", "proof", "bytes"]
    digests = settled(
        docs.select(F.col(key).alias("key"), F.sha2(plain, 256).alias("digest"), F.xxhash64(plain).alias("proof"),
                    F.octet_length(plain).alias("bytes"), F.spark_partition_id().alias("run")),
        "digests",
    )
    groups = settled(_merged(digests, same, best, fan_in).filter("group_size > 1"), "repeated")
    own = F.when(F.col("group_size").isNull(), F.col("key")).otherwise(F.col("keep_id"))
    return digests.join(groups, same, "left").select(
        F.col("key").alias(key),
        own.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("key").eqNullSafe(own).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _merged(digests: DataFrame, same: list[str], best, fan_in: int) -> DataFrame:
    left = math.ceil((1 + (digests.agg(F.max("run")).first()[0] or 0)) / fan_in)
    next_run = F.floor(F.col("run") / fan_in).alias("run")
    run = digests.groupBy(next_run, *same).agg(best("key").alias("keep_id"), F.count("*").alias("group_size"))
    of_digest = Window.partitionBy("run", *same)
    while left > 1:
        left = math.ceil(left / fan_in)
        merged = run.select(next_run, *same, "keep_id", "group_size").select(
            "run", *same, best("keep_id").over(of_digest).alias("keep_id"),
            F.sum("group_size").over(of_digest).alias("group_size"),
            F.row_number().over(of_digest.orderBy("keep_id")).alias("place"))
        run = merged.filter("place = 1").drop("place")
    return run.drop("run")
