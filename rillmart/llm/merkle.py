"""Merkle manifest of a table: a tree of digests per group, siblings found by equijoins of each level with itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settled

_STEP = "array<struct<before: binary, after: binary>>"
_ROWS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower 33 bits


def record_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) over fields: `-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    texts = [column.cast("string") for column in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def _hex(content: Column) -> Column:
    return F.lower(F.hex(content))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to. A null leaf gives null."""
    return F.aggregate(
        proof, leaf, lambda acc, step: F.sha2(F.concat(_hex(step["before"]), acc, _hex(step["after"])), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 over the siblings of a proof as hex texts, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), ""), 256)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `place` (from 0 within a tree, rows ordered by `order`) and `size`, the rows of the tree.

    Rows are dealt by ranges of tree and order and numbered where they lie; a tree that spans ranges, however large,
    adds the counts of its earlier ranges: one row per tree and range. Rows equal in everything are told apart by
    their position in the settled table, so they may span ranges too.
    """
    keys = ["tree", *order, "at"]
    spot = F.monotonically_increasing_id()
    ranged = settled(
        rows.withColumn("at", spot).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("spot", spot).drop("at"),
        "ordered")
    part = F.shiftright("spot", _ROWS)
    counts = ranged.groupBy("tree", part.alias("part")).agg(F.min("spot").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree").orderBy("part")
    starts = settled(
        counts.select(
            "tree", "part", "first", F.sum("n").over(Window.partitionBy("tree")).alias("size"),
            (F.sum("n").over(of_tree.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("earlier")), "starts")
    return settled(
        ranged.withColumn("part", part).join(starts, ["tree", "part"])
        .withColumn("place", F.col("spot") - F.col("first") + F.col("earlier")).drop("spot", "part", "first", "earlier"),
        "numbered")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with the digests of their run before and after them, by one equijoin per sibling.

    The sibling of a binary node is its place XOR 1; with more, slot plus 1, 2, ... modulo the arity. A place beyond the
    end of the tree has no row.
    """
    slot = F.pmod("place", F.lit(arity))
    joined, found = nodes, []
    for offset in range(1, arity):
        shifted = F.pmod(slot + offset, F.lit(arity))
        sibling = F.col("place").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("place") - slot + shifted
        other = nodes.select(F.col("tree"), F.col("place").alias("sibling"), F.col("digest").alias(f"other{offset}"))
        joined = joined.withColumn("sibling", sibling.cast("bigint")).join(other, ["tree", "sibling"], "left").drop("sibling")
        found.append(F.struct(shifted.alias("slot"), F.col(f"other{offset}").alias("digest")))
    run = F.sort_array(F.filter(F.array(*found), lambda s: s["digest"].isNotNull()))

    def side(keep) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter(run, keep), lambda s: s["digest"]), ""))

    return joined.select(
        "tree", "place", "size", "digest", side(lambda s: s["slot"] < slot).alias("before"),
        side(lambda s: s["slot"] > slot).alias("after"))


def _levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """Each level with its siblings, from the leaves up; rows of slot zero emit the parents. A tree ends at one node."""
    most, levels = nodes.agg(F.max("size")).first()[0] or 0, []
    while True:
        level = settled(_with_siblings(nodes, arity), f"level-{len(levels)}")
        levels.append(level)
        if most <= 1:
            return levels
        parent = F.sha2(F.concat("digest", _hex(F.col("after"))), 256)
        nodes = level.filter((F.col("size") > 1) & (F.pmod("place", F.lit(arity)) == 0)).select(
            "tree", F.floor(F.col("place") / arity).alias("place"), F.ceil(F.col("size") / arity).alias("size"),
            parent.alias("digest"))
        most = -(-most // arity)


def _roots(levels: list[DataFrame]) -> DataFrame:
    roots = [level.filter("size = 1").select("tree", "digest") for level in levels]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return found


def _proofs(levels: list[DataFrame], start: DataFrame | None, arity: int) -> DataFrame:
    """(tree, place, subroot, proof) of the leaves: each level adds its siblings to the proof of its parents.

    `start` has (tree, subroot, proof) of the nodes that end a tree; without it their proofs are empty.
    """
    none = (F.array().cast(_STEP).alias("proof"), F.lit(None).cast("string").alias("subroot"))
    below = None
    for number, level in reversed(list(enumerate(levels))):
        ends = level.filter("size = 1").select("tree", "place")
        ends = ends.select("*", *none) if start is None else ends.join(start, "tree")
        here = ends
        if below is not None:
            step = F.array(F.struct("before", "after")).cast(_STEP)
            inner = level.filter("size > 1").withColumn("parent", F.floor(F.col("place") / arity)).join(
                below.withColumnRenamed("place", "parent"), ["tree", "parent"])
            here = inner.select("tree", "place", F.concat(step, "proof").alias("proof"), "subroot").unionByName(ends)
        below = settled(here, f"proofs-{number}")
    return below


def manifest(docs: DataFrame, columns: Sequence[Column], key: str = "doc_id", group: str = "lang", arity: int = 2,
             extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of `docs`: the key, leaf, subroot, root, proof, and the columns of `extra` computed over `docs`.

    A leaf is the `record_digest` of `columns`. Within a group leaves ascend by key; every `arity` consecutive nodes, the last run
    perhaps fewer, become the digest of their concatenated digests until one is left, the subroot; a lone leaf is
    its own. Subroots in order of their group (null first, UTF-8 bytes) likewise give the root. A proof holds
    per level the digests of a node's run before and after it as bytes, from leaf to root: `folded` recomputes the
    root from it, and a row of a run of its own has a level without siblings.

    Every level is one equijoin of its nodes with themselves per sibling, and one join takes proofs down again, so no
    task holds a tree and a group with a large share of all rows is like any other. Work is in proportion to rows times
    the size of a proof; only the size of the largest tree and the root reach the driver.

    Null fields, empty texts and texts of any length are fields like others. A null group is one; a null key comes
    first. Rows that repeat a key are ordered by leaf; equal rows are leaves of their own, with the same leaf and
    their own proofs. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    if arity < 2:
        raise ValueError(f"a node has 2 children or more, not {arity}")
    label = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree")
    more = F.struct(*[column.alias(name) for name, column in (extra or {"none": F.lit(None).cast("int")}).items()])
    rows = settled(docs.select(label, F.col(key).alias("key"), record_digest(columns).alias("digest"), more.alias("extra")),
                   "leaves")
    leaves = _numbered(rows, ["key", "digest"])
    levels = _levels(leaves.select("tree", "place", "size", "digest"), arity)
    subroots = settled(_roots(levels).select(
        F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("digest").alias("subroot")), "subroots")
    top = _numbered(subroots, ["group"])
    top_levels = _levels(top.select("tree", "place", "size", F.col("subroot").alias("digest")), arity)
    root = (_roots(top_levels).first() or {"digest": None})["digest"]
    of_group = _proofs(top_levels, None, arity).drop("subroot").join(top, ["tree", "place"]).select(
        F.col("group").alias("tree"), "proof", "subroot")
    proofs = _proofs(levels, settled(of_group, "groups"), arity)
    return leaves.join(proofs, ["tree", "place"]).select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), "proof",
        *[F.col("extra")[name].alias(name) for name in (extra or {})])
