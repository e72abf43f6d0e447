"""Language identification by compression with one dictionary per language."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settled, ship

#: Bounds of the training sample: documents per language, characters of each, bytes of a dictionary.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 2_000
DICTIONARY_BYTES = 1 << 17
PIECE = 2_048
LEVEL = 3
MARGIN = 0.002
UNKNOWN = "und"
_LANGUAGES = 10_000


def held_out(key: Column) -> Column:
    """The part of the documents that is never learned from; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", order: Column | None = None,
          sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
          dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary per language from a sample whose size does not depend on the input.

    Of each language the `sample_docs` different texts come first in order of a hash, with the first `sample_chars`
    characters of each; of these the first that fit `dictionary_bytes` are learned from. Texts count as different by these
    characters in lower case, which the hash is of, so any number of copies or repeated rows is one text, and the rest of
    a very long text does not count here. Null languages, null and empty texts are left out; an empty table gives no dictionaries.

    How many different texts a language has is estimated by a sketch, and only those below the hash that leaves about
    twice `sample_docs` are gathered; if there are fewer than wanted, that is repeated with more. So what meets in a
    task and on the driver depends on the number of languages alone. With an `order` of one's own, all different texts are gathered
    and ranked per language.
    """
    known = docs.select(F.col(lang).alias("lang"), F.lower(F.substring(F.col(text), 1, sample_chars)).alias("text"),
                        *([] if order is None else [order.alias("at")])).filter("lang IS NOT NULL AND length(text) > 0")
    if order is None:
        known = _lowest(known.withColumn("at", F.xxhash64("text")), sample_docs)
    different = known.groupBy("lang", "text").agg(F.min("at").alias("at"))
    first = Window.partitionBy("lang").orderBy("at", "text")
    bytes_before = F.sum(F.octet_length("text") + 1).over(first.rowsBetween(Window.unboundedPreceding, -1))
    ranked = different.withColumn("before", F.coalesce(bytes_before, F.lit(0))).withColumn(
        "n", F.row_number().over(first)).filter(F.col("n") <= sample_docs)
    sample = ranked.filter((F.col("before") < dictionary_bytes) | (F.col("n") == 1))
    parts: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda row: (row["lang"], -row["n"])):
        parts.setdefault(row["lang"], []).append(row["text"])
    return {lang: _last_bytes("\n".join(texts).encode(), dictionary_bytes) for lang, texts in parts.items()}


def _lowest(known: DataFrame, wanted: int) -> DataFrame:
    """Rows whose hash `at` is low enough that each language keeps at least `wanted` different ones, if it has them, and
    about twice as many."""
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("at").alias("n"))
    share = 2.0 * wanted
    while True:
        limit = F.least(F.lit(1.0), share / F.col("n")) * float(1 << 64) - float(1 << 63)
        limits = sizes.select("lang", (F.col("n") <= share).alias("all"), limit.alias("limit"))
        kept = settled(known.join(F.broadcast(limits) if limits.limit(_LANGUAGES + 1).count() <= _LANGUAGES else limits, "lang")
                       .filter(F.col("all") | (F.col("at") <= F.col("limit"))).drop("limit"), "sample")
        short = kept.filter("NOT all").groupBy("lang").agg(F.countDistinct("at").alias("n")).filter(F.col("n") < wanted)
        if short.isEmpty():
            return kept.drop("all")
        share *= 4


def _last_bytes(content: bytes, most: int) -> bytes:
    return content[max(0, len(content) - most):]


class Scorer:
    """Compressed sizes under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.compressors = {
            lang: zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for lang, content in sorted(dictionaries.items())
        }

    def sizes(self, text: str) -> dict[str, int]:
        """Bytes of the whole text, compressed in pieces so that the dictionary counts everywhere alike."""
        content = text.lower().encode("utf-8", "surrogatepass")
        pieces = [content[i:i + PIECE] for i in range(0, len(content), PIECE)]
        return {lang: sum(len(c.compress(piece)) for piece in pieces) for lang, c in self.compressors.items()}

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, margin to the second. Equal sizes fall to the first language by name."""
        if not self.compressors or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes, key=lambda lang: (sizes[lang], lang))
        second = min((size for lang, size in sizes.items() if lang != best), default=2 * sizes[best])
        margin = 1 - sizes[best] / second
        return best, min(1.0, 0.5 + 5 * margin) if margin else 0.5, margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN,
             names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """Add lang_pred, score and accepted to every row; all other columns stay, those named alike are replaced.

    The language is that whose dictionary compresses the whole text smallest, `und` where the text is null or has no
    letter. A row is accepted where it has a language whose size is below the second one's by more than the share `margin`.
    Nothing but the text is looked at, whole, however long it is. Repeated rows are judged each, alike; an empty table
    stays empty. The dictionaries, of bounded size, travel with the function.
    """
    ship(docs.sparkSession)
    content = dict(dictionaries)

    @F.pandas_udf("struct<lang:string,score:double,margin:double>")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(content)
        for texts in batches:
            yield pd.DataFrame([scorer.predict(text) for text in texts], columns=["lang", "score", "margin"])

    lang, score, accepted = names
    kept = [name for name in docs.columns if name not in names]
    found = docs.select(*kept, classify(F.col(text)).alias("__rm_found"))
    return found.select(
        *kept, F.col("__rm_found.lang").alias(lang), F.col("__rm_found.score").alias(score),
        ((F.col("__rm_found.lang") != UNKNOWN) & (F.col("__rm_found.margin") > margin)).alias(accepted))
