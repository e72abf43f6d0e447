"""Joins on a key and a time range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times

def interval(
    left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, lower: str, upper: str, how: str = "inner"
) -> DataFrame:
    """Pairs with equal `on` and `lt - lower <= rt <= lt + upper`.

    In batch the time axis is cut into buckets as long as the range; a right row meets only the two or three buckets
    its range touches, so a key with a long history never pairs its whole past with its whole future. Right rows are
    repeated for that: give the narrow side there. In a stream both sides need a watermark, which together with the range
    bounds the state.
    """
    low, high = F.expr(f"INTERVAL {lower}"), F.expr(f"INTERVAL {upper}")
    shared = {name: f"_r_{name}" for name in on}
    right = right.withColumnsRenamed(shared)
    same_key = [F.col(name) == F.col(hidden) for name, hidden in shared.items()]
    in_range = F.col(rt).between(F.col(lt) - low, F.col(lt) + high)
    if left.isStreaming or right.isStreaming:
        condition = in_range
        for part in same_key:
            condition = condition & part
        return left.join(right, condition, how).drop(*shared.values())
    if how != "inner":
        raise ValueError("a batch range join is an inner join")

    width = max(int(times.seconds(lower) + times.seconds(upper)), 1)

    def bucket(ts):
        return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(width * 1_000_000)).cast("bigint")

    left = left.withColumn("_bucket", bucket(F.col(lt)))
    right = right.withColumn(
        "_r_bucket", F.explode(F.sequence(bucket(F.col(rt) - high), bucket(F.col(rt) + low)))
    )
    condition = (F.col("_bucket") == F.col("_r_bucket")) & in_range
    for part in same_key:
        condition = condition & part
    return left.join(right, condition).drop("_bucket", "_r_bucket", *shared.values())
