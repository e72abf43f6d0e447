"""Byte-pair encoding and decoding with word ends, by a priority queue of merges over a linked list of symbols."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship

#: Pieces and words kept by a worker: up to this many recent ones and as many before them.
CACHE = 200_000
_SPACE = regex.compile(r"\p{White_Space}+")


def byte_symbols() -> list[str]:
    """The printable character for each byte: itself where it prints, else the next one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge neighbours in order of rank, the leftmost first, until no pair has one.

    The queue holds (rank, left place); places form a doubly linked list. An entry is stale when its left symbol is gone
    or the pair there has another rank by now, and is skipped.
    """
    end, rank_of = len(symbols), ranks.get
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    parts: list[str | None] = list(symbols)
    queue = [(rank, at) for at, rank in enumerate(map(rank_of, zip(parts, parts[1:]))) if rank is not None]
    heapify(queue)
    while queue:
        rank, at = heappop(queue)
        left, right = parts[at], after[at]
        if left is None or right >= end or rank_of((left, parts[right])) != rank:
            continue
        left = parts[at] = left + parts[right]
        parts[right] = None
        beyond = after[at] = after[right]
        if beyond < end:
            before[beyond] = at
            if (rank := rank_of((left, parts[beyond]))) is not None:
                heappush(queue, (rank, at))
        ahead = before[at]
        if ahead >= 0 and (rank := rank_of((parts[ahead], left))) is not None:
            heappush(queue, (rank, ahead))
    return [part for part in parts if part is not None]


class WordBpe:
    """A BPE file of the tokenizers library with word ends: NFC, lower case, words by a pattern, white space dropped.

    Special tokens are found in the raw text first. Words repeat, so what a piece between white space becomes is kept
    in a bounded cache.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {(left, right): rank for rank, (left, right) in enumerate(model["merges"])}
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.names = {number: token for token, number in (*self.ids.items(), *self.special.items())}
        split = next(step for step in spec["pre_tokenizer"]["pretokenizers"] if step["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.symbols = byte_symbols()
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.odd_marks = any("<" not in mark for mark in self.special)
        self.known, self.known_before = {}, {}
        self.seen, self.seen_before = {}, {}
        self.coded, self.coded_before = {}, {}

    def word(self, word: str) -> list[int]:
        """Ids of one word; a final symbol without a vocabulary entry drops, as in the library without unknown token."""
        chars = [self.symbols[byte] for byte in word.encode("utf-8", "surrogatepass")]
        chars[-1] += self.end
        merged = merge([char for char in chars if char in self.ids], self.ranks)
        return [self.ids[part] for part in merged]

    def plain(self, text: str) -> list[int]:
        """Ids of text without special tokens."""
        text = unicodedata.normalize("NFC", text)
        text = text.lower() if text.isascii() else "".join(map(str.lower, text))
        # Words of letters alone, by far the most, need no pattern.
        words, ids = [text] if text.isalpha() else self.words.findall(text), []
        for word in words:
            if (found := self.known.get(word)) is None:
                if len(self.known) > CACHE:
                    self.known, self.known_before = {}, self.known
                found = self.known[word] = self.known_before.get(word) or self.word(word)
            ids += found
        return ids

    def piece(self, text: str) -> list[int]:
        if "<" not in text and not self.odd_marks:
            return self.plain(text)
        ids, at = [], 0
        for mark in self.marks.finditer(text):
            ids += self.plain(text[at:mark.start()])
            ids.append(self.special[mark.group()])
            at = mark.end()
        return ids + self.plain(text[at:])

    def encode(self, text: str) -> list[int]:
        return self.packed(text).tolist()

    def packed(self, text: str) -> array:
        """Ids of the whole text as 32-bit integers."""
        ids = array("i")
        for piece in _pieces(text):
            if (known := self.coded.get(piece)) is None:
                if len(self.coded) > CACHE:
                    self.coded, self.coded_before = {}, self.coded
                known = self.coded[piece] = self.coded_before.get(piece) or array("i", self.piece(piece))
            ids += known
        return ids

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings side by side, as a file without decoder asks: with a space between tokens."""
        return " ".join([self.names[number] for number in ids if number in self.names])

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded text."""
        count, numbers, names = 0, [], []
        for piece in _pieces(text):
            if (known := self.seen.get(piece)) is None:
                if len(self.seen) > CACHE:
                    self.seen, self.seen_before = {}, self.seen
                known = self.seen[piece] = self.seen_before.get(piece) or self._digested(piece)
            if known[0]:
                count += known[0]
                numbers.append(known[1])
                names.append(known[2])
        return (count, hashlib.sha256(" ".join(numbers).encode()).hexdigest(),
                hashlib.sha256(" ".join(names).encode("utf-8", "surrogatepass")).hexdigest())

    def _digested(self, piece: str) -> tuple[int, str, str]:
        ids = self.piece(piece)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)


@lru_cache(maxsize=2)
def bpe_of(vocabulary: str) -> WordBpe:
    """One encoder for all tasks of a worker process."""
    return WordBpe(vocabulary)


def _pieces(text: str) -> list[str]:
    """Text between white space. str.split() also cuts at U+001C to U+001F, which count as characters here."""
    if any(char in text for char in "\x1c\x1d\x1e\x1f"):
        return [piece for piece in _SPACE.split(text) if piece]
    return text.split()


def encode(docs: DataFrame, vocabulary: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add `out`, the ids of the whole text (array<int>). All other columns stay, one of the name `out` is replaced.

    Null and empty texts have no ids, texts of any length are encoded whole in their row, repeated rows are encoded
    each, an empty table stays empty.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = bpe_of(vocabulary)
        for texts in batches:
            yield pd.Series([np.frombuffer(bpe.packed(text or ""), np.int32) for text in texts], dtype=object)

    return docs.withColumn(out, run(F.col(text)))


def decode(docs: DataFrame, vocabulary: str, ids: str = "token_ids", out: str = "text") -> DataFrame:
    """Add `out`, the decoded text of an array of ids. All other columns stay, one of the name `out` is replaced.

    Unknown ids are left out; a null or empty array gives an empty text, a long one a long text in one row. Repeated rows are decoded each,
    an empty table stays empty.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = bpe_of(vocabulary)
        for rows in batches:
            yield rows.map(lambda row: bpe.decode([] if row is None else list(row)))

    return docs.withColumn(out, run(F.col(ids)))


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256, without carrying the ids.

    Null texts are empty, texts of any length are taken whole. Keys may be null or repeat: rows count singly. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = bpe_of(vocabulary)
        for texts in batches:
            yield pd.DataFrame([bpe.digest(text or "") for text in texts],
                               columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).alias("_key"), run(F.col(text)).alias("_d")).select(
        F.col("_key").alias(key), "_d.n_tokens", "_d.ids_sha256", "_d.decoded_sha256")
