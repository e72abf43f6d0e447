"""From documents to token ids: language, repeated lines, near-duplicates, source mixture, encoding.

Each stage takes all rows its predecessor kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm import bpe, language, line_dedup, mixing, queries, shared, simhash

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those rejected go, null texts and texts without letters among them.

    Learned from the part that is not held out. Copies are judged alike, an empty table stays empty, other columns stay.
    """
    dictionaries = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    names = ("__rm_lang", "__rm_score", "__rm_accepted")
    return language.identify(docs, dictionaries, names=names).filter("__rm_accepted").drop(*names).select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, of three lines or of fewer with 50 words together; n_chars follows the
    text. Null texts and lines of any length pass, a text left empty is dropped, an empty table stays empty."""
    done = _counted(line_dedup.dedup_lines(docs, words=queries.LINE_WORDS))
    return done.filter("text IS NULL OR trim(text) <> ''")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with a similarity of 0.8 or more in 5-word shingles stays, the one with the
    smallest id. Null and empty texts are alike, rows that repeat an id are one, an empty table stays empty."""
    found = simhash.similar_texts(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.select(F.col("doc_id").alias("__rm_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__rm_kept")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them. Rows that repeat an id are taken alike, as often as any of them.

    Null and empty texts have size zero, long ones enter whole; a null source is a source, rows without an id are one
    document. An empty table stays empty, other columns stay.
    """
    drawn = mixing.mix(docs.select("doc_id", "source", "text")).filter("times > 0")
    times = drawn.groupBy(F.col("doc_id").alias("__rm_id")).agg(F.max("times").alias("__rm_times"))
    taken = docs.join(times, F.col("doc_id").eqNullSafe(F.col("__rm_id")))
    return taken.withColumn("__rm_copy", F.explode(F.sequence(F.lit(1), F.col("__rm_times")))).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text: none for null and empty texts, all of a long one. Rows stay as they are."""
    encoded = bpe.encode(docs, queries.vocabulary("word_bpe_49k.json"))
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").alias("n_tokens"), "token_ids")


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind)).select(docs.columns)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = shared.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared.settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
