"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A data file is a row of records: length (u64), masked CRC of the length (u32), payload, masked CRC of the payload (u32).
A payload is the key (i64, with a flag for null), the width of an id in bytes (2 or 4) and the ids; all numbers are
little-endian. An index file has the start of each record (u64) and the end of the last, so records can be read in any
order. Files and the index are written by the tasks that hold the rows, into one folder all machines share.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .shared import settled, ship

#: The mask of the checksums and the layout of the fields.
MASK = 0xA282EAD8
LENGTH, CRC, HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<?qB")
CACHE = 500_000
#: White space with the word after it. Byte-level vocabularies never merge across the start of such a piece.
PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|\s+")
#: Letters, then signs that no rule joins to them: all of ASCII but the apostrophe.
MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")



def masked(content: bytes) -> int:
    crc = zlib.crc32(content)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def record(key: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = HEAD.pack(key is not None, key or 0, width) + ids.astype(f"<u{width}").tobytes()
    length = LENGTH.pack(len(payload))
    return b"".join((length, CRC.pack(masked(length)), payload, CRC.pack(masked(payload))))


def read_record(content: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """Key, ids and the end of the record at a position; a damaged record raises ValueError."""
    body = at + LENGTH.size + CRC.size
    length_bytes = bytes(content[at:at + LENGTH.size])
    if len(length_bytes) < LENGTH.size or CRC.unpack_from(content, at + LENGTH.size)[0] != masked(length_bytes):
        raise ValueError(f"damaged length at {at}")
    end = body + LENGTH.unpack(length_bytes)[0]
    payload = bytes(content[body:end])
    if len(content) < end + CRC.size or CRC.unpack_from(content, end)[0] != masked(payload):
        raise ValueError(f"damaged record at {at}")
    known, key, width = HEAD.unpack_from(payload)
    return (key if known else None), np.frombuffer(payload, f"<u{width}", offset=HEAD.size), end + CRC.size


class ByteEncoder:
    """Ids of whole texts from a tokenizers file.

    A byte-level tokenizer without normaliser always splits where white space follows a character, so a text is encoded
    piece by piece, and pieces seen before are taken from a bounded cache: texts of lines and single blanks are cut with
    str.split, others with PIECE. Other tokenizers get the whole text.
    """

    def __init__(self, vocabulary: str):
        # The tasks of a machine share its cores already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        kind = self.tokenizer.pre_tokenizer
        self.by_piece = isinstance(kind, pre_tokenizers.ByteLevel) and self.tokenizer.normalizer is None
        self.model, self.symbols = self.tokenizer.model, byte_symbols()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.seen, self.older = {}, {}

    def __call__(self, text: str) -> np.ndarray:
        if not self.by_piece:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        # A word stands for itself after a blank, after a line feed with that, and at the start with two.
        words = []
        for line in text.split("\n"):
            here = line.split(" ")
            here[0] = f"\n{here[0]}" if words else f"\n\n{here[0]}"
            words += here
        content = self._joined(words)
        if content is None:
            # PIECE keeps the white space, so each piece stands as at the start.
            content = self._joined([f"\n\n{piece}" for piece in PIECE.findall(text)], True)
        return np.frombuffer(content, f"<u{self.width}")

    def _joined(self, words: list[str], any_end: bool = False) -> bytes | None:
        """None if a word has no last character that ends a piece for sure."""
        seen = self.seen
        for word in set(words).difference(seen):
            if not self._learn(word, any_end):
                return None
        content = b"".join(map(seen.__getitem__, words))
        if len(seen) > CACHE:
            self.seen, self.older = {}, seen
        return content

    def _learn(self, word: str, any_end: bool) -> bool:
        if not any_end and (word[-1:] in ("", "\n") or word[-1].isspace()):
            return False
        found = self.older.get(word)
        self.seen[word] = self._encoded(word) if found is None else found
        return True

    def _encoded(self, word: str) -> bytes:
        if word.isalpha():
            # One word after a blank is one unit for the merges.
            unit = word if word.isascii() else "".join([self.symbols[byte] for byte in word.encode()])
            ids = [token.id for token in self.model.tokenize(self.symbols[32] + unit)]
        elif (parts := MARKED.fullmatch(word)) is not None:
            return b"".join([self._part(parts[1]), self._part(f"\n\n{parts[2]}")])
        else:
            piece = word[2:] if word[:2] == "\n\n" else word if word[:1] == "\n" else f" {word}"
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def _part(self, word: str) -> bytes:
        if word not in self.seen:
            self._learn(word, True)
        return self.seen[word]


@lru_cache(maxsize=2)
def encoder_of(vocabulary: str) -> ByteEncoder:
    """One encoder for all tasks of a worker process."""
    return ByteEncoder(vocabulary)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def write(docs: DataFrame, out: str, vocabulary: str, end: int | None, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Encode all texts and write them in ascending key order: data-*.bin and data-*.idx below `out`.

    Returns the manifest (part, name, n_docs, n_tokens), parts in order of their keys. Rows are dealt by ranges of
    the key and sorted, so a part is one task. A task writes under a name of its own and only what the manifest
    lists counts: tasks that run twice do no harm. Null texts are empty, texts of any length are one record, a null key
    comes first, rows of equal keys are ordered by text; an empty table has an empty manifest. Other columns are
    ignored, whatever their names.
    """
    ship(docs.sparkSession)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, system, sink, offsets, at, tokens = encoder_of(vocabulary), None, None, [], 0, 0
        tail = np.array([] if end is None else [end], np.uint32)
        width = 4 if end is not None and end >= 1 << 16 else encoder.width
        part = TaskContext.get().partitionId()
        name = f"data-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            for known, doc, content in zip(batch["known"], batch["key"], batch["text"]):
                if sink is None:
                    system, root = _open(out)
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(f"{root}/{name}.bin")
                ids = np.concatenate([encoder(content), tail])
                offsets.append(at)
                at += sink.write(record(int(doc) if known else None, ids, width))
                tokens += len(ids)
        if sink is not None:
            sink.close()
            with system.open_output_stream(f"{root}/{name}.idx") as index:
                index.write(np.array([*offsets, at], "<u8").tobytes())
            yield pd.DataFrame([(part, name, len(offsets), tokens)], columns=["part", "name", "n_docs", "n_tokens"])

    rows = docs.select(
        F.col(key).isNotNull().alias("known"), F.coalesce(F.col(key), F.lit(0)).cast("bigint").alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("known", "key").sortWithinPartitions("known", "key", "text")
    return settled(ordered.mapInPandas(put, "part int, name string, n_docs bigint, n_tokens bigint"), "manifest")


def _sizes(out: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open(out)
        for batch in batches:
            for name, start in zip(batch["name"], batch["start"]):
                with system.open_input_file(f"{root}/{name}.idx") as index:
                    offsets = np.frombuffer(index.read(), "<u8").tolist()
                rows = []
                with system.open_input_stream(f"{root}/{name}.bin") as source:
                    for at, stop in zip(offsets, offsets[1:]):
                        key, ids, _ = read_record(memoryview(source.read(stop - at)), 0)
                        rows.append((key is not None, key or 0, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                yield pd.DataFrame(rows, columns=["known", "key", "start", "n_tokens", "ids_crc32"])

    return get


def read(manifest: DataFrame, out: str, key: str = "doc_id") -> DataFrame:
    """Per record in the files: key, start (ids of all records before it), n_tokens, ids_crc32 over ids of 32 bits.

    The manifest, one row per file, is ordered in one task; each file is streamed by a task, record by record, and
    every checksum is verified.
    """
    ship(manifest.sparkSession)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settled(
        manifest.select("name", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")), "starts")
    files = starts.repartition(max(1, starts.count()))
    found = files.mapInPandas(
        _sizes(out), "known boolean, key bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    own: Column = F.when(F.col("known"), F.col("key"))
    return found.select(own.alias(key), "start", "n_tokens", "ids_crc32")


def fetch(out: str, name: str, number: int) -> tuple[int | None, list[int]]:
    """One record of a file by its number, through the index: the read a shuffled loader makes."""
    system, root = _open(out)
    with system.open_input_file(f"{root}/{name}.idx") as index:
        index.seek(8 * number)
        at, stop = np.frombuffer(index.read(16), "<u8").tolist()
    with system.open_input_file(f"{root}/{name}.bin") as source:
        source.seek(at)
        key, ids, _ = read_record(memoryview(source.read(stop - at)), 0)
    return key, ids.tolist()

