"""Merkle manifest, packing and whitening against brute-force versions, on the smallest tables and on awkward rows."""

import hashlib
import os
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from rillmart.llm import merkle, packing, queries, whitening  # noqa: E402
from test_operators import SF_DIR, awkward, docs, empty  # noqa: E402, F401


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, columns):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns))


def tree(digests, arity):
    """The root, and per leaf the (before, after) of each level."""
    level, paths, at = list(digests), [[] for _ in digests], list(range(len(digests)))
    while len(level) > 1:
        for leaf, place in enumerate(at):
            run = level[place // arity * arity:place // arity * arity + arity]
            paths[leaf].append(("".join(run[:place % arity]), "".join(run[place % arity + 1:])))
        level = [sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)]
        at = [place // arity for place in at]
    return level[0], paths


def brute_manifest(rows, columns, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"], leaf_of(row, columns)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    roots, inner = [], {}
    for group in order:
        groups[group].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        root, inner[group] = tree([leaf for _, leaf in groups[group]], arity)
        roots.append(root)
    top, outer = tree(roots, arity)
    return [(key, leaf, roots[i], top, inner[group][j] + outer[i])
            for i, group in enumerate(order) for j, (key, leaf) in enumerate(groups[group])]


@pytest.mark.parametrize("table, arity", [("awkward", 2), ("awkward", 3), ("docs", 2), ("docs", 5)])
def test_manifest(request, table, arity):
    df = request.getfixturevalue(table)
    columns = ["doc_id", "source", "lang", "text"]
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"],
            [(s["before"].hex(), s["after"].hex()) for s in r["proof"]])
           for r in merkle.manifest(df, [F.col(c) for c in columns], arity=arity).collect()]
    assert sorted(got, key=repr) == sorted(brute_manifest(df.collect(), columns, arity), key=repr)


def test_manifest_of_few_rows(spark, empty):  # noqa: F811
    assert merkle.manifest(empty, [F.col("text")]).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], "doc_id int, text string, lang string")
    row = merkle.manifest(one, [F.col("text")], extra={"leaf_size": F.length("text")}).first()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:a") and row["proof"] == [] and row["leaf_size"] == 1


def test_a_changed_leaf_leads_to_another_root(spark):
    df = spark.range(37).selectExpr("id AS doc_id", "cast(id AS string) AS text", "if(id < 30, 'en', null) AS lang")
    found = merkle.manifest(df, [F.col("text")])
    again = found.select("root", merkle.folded(F.col("leaf"), F.col("proof")).alias("same"),
                         merkle.folded(F.sha2(F.lit("x"), 256), F.col("proof")).alias("other")).collect()
    assert all(r["same"] == r["root"] != r["other"] for r in again)


def test_numbering_spreads_equal_rows(spark):
    df = spark.range(5_000).selectExpr("'a' AS tree", "1 AS key", "if(id < 4000, 'x', 'y') AS digest")
    got = merkle._numbered(df.repartition(3), ["key", "digest"]).collect()
    assert sorted(r["place"] for r in got) == list(range(5_000)) and {r["size"] for r in got} == {5_000}
    assert all((r["digest"] == "x") == (r["place"] < 4_000) for r in got)


# packing

def check_pieces(rows, pieces, capacity, end, padding):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    wanted = sorted((repr(key), [*library.encode(text or "", add_special_tokens=False).ids, end]) for key, text in rows)
    documents, bins = {}, {}
    for p in pieces:
        documents.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        bins.setdefault(p["sequence_id"], []).append(p)
    free = 0
    for parts in bins.values():
        parts.sort(key=lambda p: p["offset"])
        at = 0
        for p in parts:
            assert p["offset"] == at
            at += len(p["ids"]) // 4
        assert 0 < at <= capacity
        free += 0 if at & (at - 1) == 0 else capacity - at
    total = sum(len(ids) for _, ids in wanted)
    assert free <= padding * total
    # Rows of one key and length: their pieces together are the tokens of all of them.
    flat = sorted((key, x) for key, ids in wanted for x in enumerate(ids))
    got = sorted((repr(p["doc_id"]), (p["start"] + i, int(x)))
                 for p in pieces for i, x in enumerate(np.frombuffer(p["ids"], "<u4")))
    assert flat == got


@pytest.mark.parametrize("table, capacity, slack", [("awkward", 2048, 8), ("docs", 2048, 8), ("docs", 100, 0)])
def test_packing(request, table, capacity, slack):
    df = request.getfixturevalue(table)
    pieces = packing.pack(df, queries.vocabulary("byte_bpe_50k.json"), 1, capacity=capacity, slack=slack).collect()
    check_pieces([(r["doc_id"], r["text"]) for r in df.collect()], pieces, capacity, 1, 0.005)


def test_packing_of_nothing(empty, spark):  # noqa: F811
    file = queries.vocabulary("byte_bpe_50k.json")
    assert packing.pack(empty, file, 1).count() == 0
    blank = spark.createDataFrame([("a", None), ("b", "")], "doc_id string, text string")
    assert packing.pack(blank, file, None).count() == 0
    assert {r["doc_id"] for r in packing.pack(blank, file, 1).collect()} == {"a", "b"}


def test_cuts_are_few_and_exact():
    found = packing.cuts(2048, 8)
    sizes = packing.class_sizes(2048, 8)
    assert all(sum(found[n]) == n and set(found[n]) <= set(sizes) for n in range(2048))
    assert max(map(len, found)) <= 5 and all(2048 - 2048 // s * s <= 8 for s in sizes)


def test_sequences_join_the_pieces(docs):  # noqa: F811
    pieces = packing.pack(docs, queries.vocabulary("byte_bpe_50k.json"), 1).cache()
    bins = {}
    for p in pieces.collect():
        bins.setdefault(p["sequence_id"], []).append((p["offset"], np.frombuffer(p["ids"], "<u4").tolist()))
    for row in packing.sequences(pieces, 9).collect():
        ids = [x for _, part in sorted(bins[row["sequence_id"]]) for x in part]
        assert row["ids"] == ids + [9] * row["padding"]
        assert len(row["ids"]) == 2048 or (row["padding"] == 0 and len(ids) & (len(ids) - 1) == 0)
    pieces.unpersist()


# whitening

def brute_whitening(rows, components=32):
    sound = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
             if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in sound], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    off = x * n - sums
    deviation = (off * off).sum(axis=1)
    centred = off.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return [i for i, _ in sound], n, deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check_whitening(rows, got, components=32):
    ids, n, deviation, white, explained = brute_whitening(rows, components)
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and r["identity_error"] < 1e-8
    assert sorted(by_row, key=repr) == sorted(ids, key=repr)
    signs = np.zeros(white.shape[1])
    for at, key in enumerate(ids):
        assert sorted(by_row[key]) == list(range(1, white.shape[1] + 1))
        for c, r in by_row[key].items():
            assert r["deviation"] == deviation[at]
            assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
            signs[c - 1] += np.sign(r["whitened"]) * np.sign(white[at, c - 1])
            assert abs(r["whitened"]) == pytest.approx(abs(white[at, c - 1]), rel=1e-6, abs=1e-7)
    assert all(abs(signs) >= len(ids) * 0.99)


def test_whitening(spark):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(300, 40)) @ np.diag(2.0 ** -np.arange(0, 10, 0.25)) @ rng.normal(size=(40, 40)) * 40
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 38), (402, [float("nan")] * 40), (403, [float("-inf")] * 40), (None, [5.0] * 40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    check_whitening(rows, whitening.whiten(df).collect())


def test_whitening_of_the_given_table(spark, docs):  # noqa: F811
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    check_whitening([tuple(r) for r in df.collect()], queries.op13_whitening(spark, SF_DIR).collect())


def test_whitening_without_variance_and_of_several_dimensions(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(50, 3))
    rows = [(i, [a, b, a, 7.0]) for i, (a, b, _) in enumerate(base.tolist())]
    rows += [(100 + i, v) for i, v in enumerate(base.tolist())] + [(200, []), (201, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = whitening.whiten(df).collect()
    counts = {}
    for r in got:
        counts.setdefault(r["vec_id"], []).append(r["component"])
    assert all(sorted(counts[i]) == [1, 2] for i in range(50))
    assert all(sorted(counts[100 + i]) == [1, 2, 3] for i in range(50))
    assert set(counts) == set(range(50)) | set(range(100, 150))
    check_whitening(rows[50:100], [r for r in got if 100 <= r["vec_id"] < 200])
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 4, df.schema)).count() == 0


def test_whitening_of_numbers_beyond_64_bits(spark):
    schema = "vec_id bigint, embedding array<double>"
    wide = [(i, [float(1 << 44) * (-1) ** i, float(i % 3)]) for i in range(6)]
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(spark.createDataFrame(wide, schema)).collect()
    with pytest.raises(Exception, match="or more"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], schema)).collect()
