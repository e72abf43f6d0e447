"""Dimension enrichment.

Dimensions are static frames of string columns keyed by `id`. Joins with them force no broadcast: Spark broadcasts a
dimension whose size is below `spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles both sides, with AQE
splitting hot fact keys. Code tables are measured first and broadcast while they are small, because facts have few
codes and a shuffle by code would put large shares of all rows together. Missing dimension rows give nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SMALL_ROWS = 50_000
SMALL_BYTES = 64 << 20


def small(table: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> bool:
    """Whether a static table has at most `rows` rows and, as JSON text, `size` bytes; reading stops at the rows."""
    length = F.octet_length(F.to_json(F.struct("*")))
    measured = table.limit(rows + 1).agg(F.count("*").alias("rows"), F.sum(length).alias("bytes")).first()
    return measured["rows"] <= rows and (measured["bytes"] or 0) <= size


def ready(table: DataFrame) -> DataFrame:
    """A static lookup table marked for broadcasting if it is small; otherwise a plain one, whose join AQE may split."""
    return F.broadcast(table) if small(table) else table


def dim(
    df: DataFrame, table: DataFrame, key: str, columns: dict[str, str], table_key: str = "id", how: str = "left"
) -> DataFrame:
    """Add `columns` (output name -> dimension column) of the dimension row whose `table_key` equals `key`."""
    looked_up = table.select(
        F.col(table_key).alias("_dim_key"), *[F.col(source).alias(name) for name, source in columns.items()]
    )
    joined = df.join(looked_up, F.col(key) == F.col("_dim_key"), how)
    return joined.drop("_dim_key")


def code(df: DataFrame, dic: DataFrame, key: str, out: str) -> DataFrame:
    """Translate a code column through the code table (rowkey, info.dic_name); rows with an unknown code drop."""
    return dim(df, ready(dic), key, {out: "info.dic_name"}, table_key="rowkey", how="inner")


def categories(dims: dict[str, DataFrame]) -> DataFrame:
    """Category 3 with its parents as one flat dimension."""
    c3 = dims["dim_base_category3"].select(F.col("id"), F.col("name").alias("category3_name"), "category2_id")
    with_c2 = dim(c3, dims["dim_base_category2"], "category2_id",
                  {"category2_name": "name", "category1_id": "category1_id"})
    return dim(with_c2, dims["dim_base_category1"], "category1_id", {"category1_name": "name"})


def sku_dimension(dims: dict[str, DataFrame], with_spu: bool = True) -> DataFrame:
    """The sku snowflake (sku, spu, trademark, category 3 to 1) flattened to one row per sku.

    Joining the dimensions with each other first leaves a single join for the facts.
    """
    flat = dims["dim_sku_info"].select("id", "spu_id", "category3_id", F.col("tm_id").alias("trademark_id"))
    if with_spu:
        flat = dim(flat, dims["dim_spu_info"], "spu_id", {"spu_name": "spu_name"})
    else:
        flat = flat.drop("spu_id")
    flat = dim(flat, dims["dim_base_trademark"], "trademark_id", {"trademark_name": "tm_name"})
    parents = {name: name for name in
               ("category3_name", "category2_id", "category2_name", "category1_id", "category1_name")}
    return dim(flat, categories(dims), "category3_id", parents)


def sku_hierarchy(df: DataFrame, dims: dict[str, DataFrame], key: str = "sku_id", with_spu: bool = True) -> DataFrame:
    flat = sku_dimension(dims, with_spu)
    return dim(df, flat, key, {name: name for name in flat.columns if name != "id"})
