"""Search keywords."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import values
from . import segments


def searches(pages: DataFrame) -> DataFrame:
    """Pages reached by a keyword search from the search or home page."""
    return pages.filter(
        F.col("last_page_id").isin("search", "home")
        & (F.col("item_type") == "keyword")
        & F.col("item").isNotNull()
    )


def explode(
    df: DataFrame, column: str, tokenizer: Callable[[Column], Column] | None = None, out: str = "keyword"
) -> DataFrame:
    """One row per distinct word of a text column; texts without words give no row.

    `tokenizer` maps a text column to an array of words: a built-in expression (default) or a pandas UDF around a
    dictionary.
    """
    words = values.tokens if tokenizer is None else tokenizer
    return df.withColumn(out, F.explode(F.array_distinct(words(F.col(column)))))


def by_dictionary(df: DataFrame, column: str, dictionary: DataFrame, out: str = "keyword", longest: int = segments.LONGEST
                  ) -> DataFrame:
    """One row per distinct word of a text column in batch, where runs of letters or digits are cut by a dictionary (column `word`).

    Each different run is cut once (`segments.cut_runs`) and joined back; texts without words give no row.
    """
    rows = session.settled(df.withColumn("_row", F.monotonically_increasing_id()))
    runs = rows.select("_row", F.explode(values.tokens(F.col(column))).alias("run"))
    cut = segments.cut_runs(runs, dictionary, longest)
    words = runs.join(cut, "run").select("_row", F.explode("words").alias(out)).distinct()
    return rows.join(words, "_row").drop("_row")


def register(spark: SparkSession, name: str = "kw_split") -> None:
    """The splitter as a table function for SQL: `FROM t, LATERAL kw_split(t.item)` gives a row per distinct word."""
    spark.sql(rf"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (keyword STRING)
        RETURN SELECT explode(array_distinct(array_remove(split(lower(text), r'[^\p{{L}}\p{{N}}]+'), '')))
    """)
