"""SimHash near-duplicates: fingerprints, and a byte-position index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .components import connected
from .shared import WORD, lower_ascii, settled, ship

SHINGLE = 4
BITS = 4
BYTES = 8
HEAVY = 100_000
_CHUNK = 1 << 15
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash over shingles of `width` words, A-Z lower-cased; fewer words are one shingle, none give zero."""
    return fingerprints(text, width, 1)[0]


def fingerprints(text: str | None, width: int, count: int) -> list[int]:
    """`count` SimHashes of a text: the first from the hashes of its shingles, the others from those hashes mixed anew."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return [0] * count
    width = min(width, len(words))
    total, ones = len(words) - width + 1, np.zeros((count, 64), np.int64)
    for at in range(0, total, _CHUNK):
        part = words[at:at + _CHUNK + width - 1]
        grams = zip(*[part[i:] for i in range(width)])
        hashes = np.fromiter(map(_hash, map(b" ".join, grams)), np.uint64, len(part) - width + 1)
        for number in range(count):
            mixed = _mixed(hashes, number) if number else hashes
            bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[number] += bits.sum(axis=0, dtype=np.uint32)
    set_bits = np.packbits(ones * 2 > total, axis=1, bitorder="little")
    return set_bits.view("<u8").ravel().tolist()


def _mixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Hashes spread anew over 64 bits, by multiplication with odd numbers and shifts; a bijection."""
    mixed = hashes + np.uint64(number * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(31))


def _fingerprints(width: int):
    @pandas_udf(T.LongType())
    def prints_of(texts: pd.Series) -> pd.Series:
        prints = np.fromiter(map(partial(fingerprint, width=width), texts), np.uint64, len(texts))
        return pd.Series(prints.view(np.int64))

    return prints_of


def _several(width: int, count: int):
    @pandas_udf(T.ArrayType(T.LongType()))
    def prints_of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(fingerprints(text, width, count), np.uint64).view(np.int64) for text in texts])

    return prints_of


def _masks(bits: int) -> list[int]:
    """Bit masks of all sets of BYTES - bits byte positions, as signed 64-bit numbers."""
    if not 0 <= bits < BYTES:
        raise ValueError(f"at most {BYTES - 1} bits may differ, so that some byte agrees: {bits}")
    found = []
    for places in combinations(range(BYTES), BYTES - bits):
        mask = sum(0xFF << (8 * place) for place in places)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def _distance(one: np.uint64, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(others ^ one)


def forest(prints: np.ndarray, bits: int = BITS) -> tuple[list[int], list[int]]:
    """Links that connect what is connected within these prints: each print found takes its unvisited neighbours, so
    close groups shrink at once and no pair list is built."""
    rest, ends, starts = np.unique(prints), [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = _distance(node, rest) <= bits
            if near.any():
                found = rest[near]
                starts += [node] * len(found)
                ends += found.tolist()
                queue += list(found)
                rest = rest[~near]
    return [int(x) for x in starts], [int(x) for x in ends]


def _links(key: list[str], limit: int | None, bits: int):
    """Links within each posting of rows sorted by `key`; a posting may span batches. One of more than `limit` rows is
    only named, as a row with its place and its shared bytes."""
    masks = np.array(_masks(bits), np.int64)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        prints, values = rows["print"].to_numpy().view(np.uint64), rows[key].to_numpy()
        changed = (values[1:] != values[:-1]).any(axis=1)
        starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
        sizes = np.diff(np.append(starts, len(rows)))
        two = starts[sizes == 2]
        near = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= bits]
        a, b, named = prints[near].tolist(), prints[near + 1].tolist(), []
        for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            if limit is not None and size > limit:
                named.append(at)
                continue
            some, more = forest(prints[at:at + size], bits)
            a += some
            b += more
        found = pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})
        heavy = pd.DataFrame({"shared": rows["shared"].to_numpy()[named], "place": rows["place"].to_numpy()[named]})
        return pd.concat([found.assign(shared=0, place=-1), heavy.assign(a=0, b=0)])[["a", "b", "shared", "place"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            if not len(batch):
                continue
            batch = batch.assign(shared=batch["print"].to_numpy() & masks[batch["place"].to_numpy()])
            first, last = batch[key].iloc[0], batch[key].iloc[-1]
            if held and not (held[-1][key].iloc[-1] == first).all():
                yield solve(pd.concat(held))
                held, count = [], 0
            open_ = (batch[key] == last).all(axis=1)
            if not open_.all():
                yield solve(pd.concat([*held, batch[~open_]]))
                held, count = [], 0
            # Of a posting over the limit no more rows than show it need to be held.
            if limit is None or count <= limit:
                held.append(batch[open_])
                count += int(open_.sum())
        if held:
            yield solve(pd.concat(held))

    return run


def links(prints: DataFrame, heavy: int = HEAVY, bits: int = BITS) -> DataFrame:
    """Links (a, b) between different fingerprints (column `print`, distinct) that connect all at most `bits` bits apart.

    At most `bits` (up to 7) differing bits leave at least 8 - `bits` of 8 bytes equal, so the inverted index holds each
    print under every set of so many byte positions with the bytes there: a pair is tallied to the guaranteed count exactly if it meets under
    some set. Prints that meet are verified by their distance; a posting gives links that connect it, not its pairs.
    Postings are streamed in order. One with more than `heavy` prints is set aside, cut into parts, and every two parts
    meet in a task of their own, so that no task grows.
    """
    ship(prints.sparkSession)
    form = "a bigint, b bigint, shared bigint, place int"
    masks = F.array(*[F.lit(mask) for mask in _masks(bits)])
    shared = F.col("print").bitwiseAND(F.get(masks, F.col("place")))
    postings = prints.select("print", F.explode(F.sequence(F.lit(0), F.lit(len(_masks(bits)) - 1))).alias("place"))
    # A print that meets no other under a posting goes before Python sees it; what is left comes in order of postings.
    of_posting = Window.partitionBy("place", "shared").orderBy("print")
    met = postings.withColumn("shared", shared).withColumn(
        "alone", F.lag("print").over(of_posting).isNull() & F.lead("print").over(of_posting).isNull())
    found = settled(met.filter("NOT alone").select("place", "print").mapInPandas(
        _links(["place", "shared"], heavy, bits), form), "postings")
    light = found.filter("place < 0").select("a", "b")
    large = found.filter("place >= 0").select("place", "shared")
    if large.isEmpty():
        return light
    of_large = settled(postings.withColumn("shared", shared).join(large, ["place", "shared"]), "large-postings")
    parts = settled(
        of_large.groupBy("place", "shared").agg(F.ceil(2 * F.count("*") / heavy).cast("int").alias("parts")), "parts")
    own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    # Parts i <= j meet under the number i * parts + j.
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda other: F.least(own, other) * F.col("parts") + F.greatest(own, other))
    cut = of_large.join(parts, ["place", "shared"]).select("place", "shared", "print", F.explode(meets).alias("part"))
    key = ["place", "shared", "part"]
    sorted_parts = cut.repartition(*key).sortWithinPartitions(*key)
    return light.unionByName(sorted_parts.mapInPandas(_links(key, None, bits), form).select("a", "b"))


def once(found: DataFrame) -> DataFrame:
    """Each link (a, b) in one row, a before b: near prints meet under up to all sets of byte positions, and each gives its link."""
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE,
                    bits: int = BITS) -> DataFrame:
    """One row per row of `docs`: key, fingerprint (bigint) and component_id, the smallest key reachable over links.

    Fingerprints are over shingles of `width` words; those at most `bits` (up to 7) bits apart are linked. Fewer equal bytes
    mean larger postings, so work grows with `bits`. Texts with equal fingerprints are one class and enter the index once. Null and empty texts have fingerprint zero
    and link like any other. Keys may repeat; a null key is reached only where a component has no other. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    prints = settled(
        docs.select(F.col(key).alias("key"), _fingerprints(width)(F.col(text)).alias("print")), "fingerprints")
    classes = settled(prints.groupBy("print").agg(F.min("key").alias("least")), "classes")
    roots = connected(links(classes.select("print"), bits=bits)).withColumnRenamed("node", "print")
    placed = settled(
        classes.join(roots, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root")), "roots")
    smallest = settled(placed.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    of_class = settled(placed.join(smallest, "root").select("print", "component_id"), "components")
    return prints.join(of_class, "print").select(
        F.col("key").alias(key), F.col("print").alias("fingerprint"), "component_id")


def shingles(text, width: int):
    """Distinct hashes of a text's shingles of `width` words, A-Z lower-cased; fewer words are one shingle, none give no hash."""
    words = F.regexp_extract_all(lower_ascii(text), F.lit(f"({WORD})"), 1)
    last = F.greatest(F.size(words) - width, F.lit(0))
    whole = F.get(F.transform(F.array(words), lambda w: F.when(
        F.size(w) > 0, F.transform(F.sequence(F.lit(0), last), lambda at: F.xxhash64(F.slice(w, at + 1, F.lit(width)))))), F.lit(0))
    return F.array_distinct(F.coalesce(whole, F.array().cast("array<bigint>")))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of texts whose shingle sets have at least the given Jaccard similarity."""
    one, two = (sets.select(F.col("node").alias(end), F.col("shingles").alias(f"of_{end}")) for end in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    united = F.size("of_a") + F.size("of_b") - shared
    return both.filter(shared >= similarity * united).select("a", "b")


def similar_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2, bits: int = 5, count: int = 4,
                  shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per row of `docs`: key and component_id, the smallest key reachable over pairs of similar texts.

    Two texts are similar if their sets of `shingle`-word shingles have a Jaccard similarity of at least `similarity`,
    which is verified on the whole texts. Candidates are texts that lie within `bits` of 64 bits in one of `count` fingerprints over
    `width`-word shingles; more fingerprints find more of the similar pairs, none gives a wrong one. What `links` connects is
    verified first against the smallest text of each connected group, then, where that fails, link by link, so a
    group of copies costs one comparison per text and no list of all pairs arises.

    Texts equal but for the case of A-Z are one text. Null and empty texts are one text, similar to each other alone; texts without as many
    words as a shingle are similar if all their words agree. Keys may repeat; a null key is reached only where a
    component has no other. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    digest = F.sha2(lower_ascii(F.col(text)), 256).alias("digest")
    rows = settled(docs.select(F.col(key).alias("key"), digest, _several(width, count)(F.col(text)).alias("prints")), "several-prints")
    texts = settled(rows.groupBy("digest").agg(F.min("key").alias("least"), F.first("prints").alias("prints"))
                    .withColumn("node", F.monotonically_increasing_id()), "texts")
    found = []
    for number in range(count):
        of_print = texts.select("node", F.col("prints")[number].alias("print"))
        classes = settled(of_print.groupBy("print").agg(F.min("node").alias("first"), F.count("*").alias("n")), "print-classes")
        same = of_print.join(classes.filter("n > 1"), "print").filter("node > first").select(
            F.col("first").alias("a"), F.col("node").alias("b"))
        near = once(links(classes.select("print"), bits=bits))
        ends = [classes.select(F.col("print").alias(end), F.col("first").alias(f"{end}_node")) for end in ("a", "b")]
        near = near.join(ends[0], "a").join(ends[1], "b").select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))
        found.append(settled(same.unionByName(near), "candidates"))
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    candidates = settled(candidates.distinct(), "all-candidates")
    nodes = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    wanted = settled(texts.join(nodes, "node").select("digest", "node"), "candidate-texts")
    sets = settled(
        docs.select(digest, F.col(text).alias("text")).join(wanted, "digest").groupBy("node").agg(F.first("text").alias("text"))
        .select("node", shingles(F.col("text"), shingle).alias("shingles")), "shingles")
    stars = connected(candidates).select(F.col("root").alias("a"), F.col("node").alias("b"))
    sure = settled(_verified(stars, sets, similarity), "verified-stars")
    # Links both of whose ends are joined to the smallest text already say nothing new.
    joined = settled(sure.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        sure.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct(), "joined")
    roots = [joined.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")]
    open_ = candidates.join(roots[0], "a", "left").join(roots[1], "b", "left").filter("root_a IS NULL OR root_b IS NULL OR root_a <> root_b")
    all_links = sure.unionByName(_verified(open_.select("a", "b"), sets, similarity))
    of_text = connected(settled(all_links, "verified")).toDF("node", "root")
    placed = settled(texts.join(of_text, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root")), "placed")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_digest = settled(placed.join(smallest, "root").select("digest", "component_id"), "components")
    return rows.join(of_digest, "digest").select(F.col("key").alias(key), "component_id")
