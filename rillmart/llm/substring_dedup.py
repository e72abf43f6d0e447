"""Substring deduplication: a count-min sketch picks windows that may repeat, an exact pass groups those."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settled, ship

WINDOW = 50
GRAM = 26
#: Cells of each of the two rows of the sketch, as a power of two. It is kept as a table of its used cells.
CELL_BITS = 44
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16
_NULL_KEY = (1 << 63) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mixed(values: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: all bits of the result depend on all bits of the value."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def gram_hashes(words: list[bytes], gram: int = GRAM) -> np.ndarray:
    """Hash of each `gram` consecutive words, by prefix sums of a polynomial modulo 2^64."""
    out = []
    for at in range(0, len(words) - gram + 1, _BLOCK):
        part = words[at:at + _BLOCK + gram - 1]
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, part), np.uint64, len(part))
        powers = np.cumprod(np.full(len(part), _BASE, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each * powers)])
        back = np.cumprod(np.full(len(part) - gram + 1, _BACK, np.uint64))
        out.append(_mixed((sums[gram:] - sums[:-gram]) * back))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def minima(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """For each window, the position of its smallest gram hash, the first of equal ones."""
    width, out = window - gram + 1, []
    for at in range(0, len(hashes) - width + 1, _BLOCK):
        part = hashes[at:at + _BLOCK + width - 1]
        views = np.lib.stride_tricks.sliding_window_view(part, width)
        out.append(at + np.arange(len(views)) + views.argmin(axis=1))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, mark, text in zip(batch["key"], batch["print"], batch["text"]):
            words = words_of(text)
            whole = b" ".join(words)
            hashes = gram_hashes(words) if len(words) >= WINDOW else np.zeros(0, np.uint64)
            chosen = np.unique(minima(hashes))
            grams = np.unique(hashes[chosen]).view(np.int64)
            rows.append((key, mark, hashlib.sha256(whole).hexdigest(), len(words), grams))
        yield pd.DataFrame(rows, columns=["key", "print", "digest", "n_words", "grams"])


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact digests of the windows whose gram the sketch estimates as repeated."""
    for batch in batches:
        keys, prints, starts, ones, twos = [], [], [], [], []
        for key, mark, text, grams in zip(batch["key"], batch["print"], batch["text"], batch["grams"]):
            words = words_of(text)
            hashes = gram_hashes(words)
            flagged = np.isin(hashes[minima(hashes)], np.asarray(grams, np.int64).view(np.uint64))
            at = np.flatnonzero(flagged)
            raw = b"".join(
                hashlib.blake2b(b" ".join(words[i:i + WINDOW]), digest_size=16).digest() for i in at.tolist())
            pairs = np.frombuffer(raw, np.int64).reshape(-1, 2)
            keys += [key] * len(at)
            prints += [mark] * len(at)
            starts.append(at)
            ones.append(pairs[:, 0])
            twos.append(pairs[:, 1])
            if len(keys) > 200_000:
                yield _frame(keys, prints, starts, ones, twos)
                keys, prints, starts, ones, twos = [], [], [], [], []
        if keys:
            yield _frame(keys, prints, starts, ones, twos)


def _frame(keys, prints, starts, ones, twos) -> pd.DataFrame:
    return pd.DataFrame({"key": np.array(keys, np.int64), "print": np.array(prints, np.int64),
                         "start": np.concatenate(starts).astype(np.int32),
                         "one": np.concatenate(ones), "two": np.concatenate(twos)})


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, mark, text, starts in zip(batch["key"], batch["print"], batch["text"], batch["starts"]):
            words = words_of(text)
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, np.asarray(starts), 1)
            np.add.at(steps, np.asarray(starts) + WINDOW, -1)
            gone = np.cumsum(steps[:-1]) > 0
            kept = b" ".join(word for word, drop in zip(words, gone.tolist()) if not drop)
            rows.append((key, mark, int(gone.sum()), kept.decode("utf-8", "surrogatepass")))
        yield pd.DataFrame(rows, columns=["key", "print", "n_removed", "kept"])


def dedup_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_words, n_removed, kept_sha256, and kept, the words that stay where some went.

    A word goes if a window of WINDOW words over it also starts, word for word, in a document of a smaller key;
    windows are judged on the input. `kept` is null where nothing was removed (the text itself is what stays).

    Each window stands in the sketch through the smallest hash among its grams of GRAM words: equal windows have
    equal grams, so the count of the gram is at least that of the window. The sketch has two rows of
    2^CELL_BITS cells; partitions count into the cells they use, and the counts of all are summed. Only windows whose
    gram is estimated at two or more places, in both rows, enter the second pass, which groups exact 128-bit digests of
    their words. Texts with equal word sequences enter once: under all keys but the smallest they go as a whole.

    Null and empty texts have no words. Texts shorter than a window do not change. Rows with one key are one document:
    they never remove words from each other. A null key comes after all others. An empty table gives no rows.
    Memory per task is bound by the longest text; hot windows and grams meet in joins of settled tables that AQE splits.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(key), F.lit(_NULL_KEY)).cast("bigint").alias("key"),
        # Tells rows of one key apart.
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("print"), F.col(text).alias("text"))
    sketched = settled(
        rows.mapInPandas(_sketched, "key bigint, print bigint, digest string, n_words bigint, grams array<bigint>"),
        "sketched")
    classes = settled(
        sketched.filter(F.col("n_words") >= WINDOW).groupBy("digest")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"))
        .filter("least < most").select("digest", "least"), "classes")
    copy = F.coalesce(F.col("key") > F.col("least"), F.lit(False))
    single = settled(sketched.join(classes, "digest", "left").withColumn("copy", copy).drop("least"), "classed")
    grams = settled(
        single.filter("NOT copy").select("key", "print", F.explode("grams").alias("gram")), "grams")
    flagged = grams
    for row in range(2):
        cell = F.shiftrightunsigned(F.xxhash64(F.lit(row), F.col("gram")), 64 - CELL_BITS)
        cells = settled(grams.groupBy(cell.alias("cell")).count().filter("count > 1").select("cell"), "cells")
        flagged = settled(flagged.withColumn("cell", cell).join(cells, "cell", "left_semi").drop("cell"), "flagged")
    per_text = flagged.groupBy("key", "print").agg(F.collect_set("gram").alias("grams"))
    touched = settled(rows.join(per_text, ["key", "print"]).dropDuplicates(["key", "print"]), "touched")
    windows = settled(
        touched.mapInPandas(_candidates, "key bigint, print bigint, start int, one bigint, two bigint"), "windows")
    firsts = settled(
        windows.groupBy("one", "two").agg(F.min("key").alias("least"), F.max("key").alias("most"))
        .filter("least < most").select("one", "two", "least"), "first-windows")
    later = windows.join(firsts, ["one", "two"]).filter("key > least").groupBy("key", "print").agg(
        F.collect_set("start").alias("starts"))
    cut = touched.drop("grams").join(later, ["key", "print"]).mapInPandas(
        _cut, "key bigint, print bigint, n_removed bigint, kept string")
    done = single.drop("grams").join(settled(cut, "cut"), ["key", "print"], "left")
    kept = F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept"))
    return done.select(
        F.when(F.col("key") != _NULL_KEY, F.col("key")).alias(key),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(kept.isNull(), F.col("digest")).otherwise(F.sha2(kept, 256)).alias("kept_sha256"),
        kept.alias("kept"),
    )
