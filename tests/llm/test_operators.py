"""Each operator against a brute-force version, on the smallest tables and on awkward rows."""

import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from rillmart.llm import (  # noqa: E402
    bpe, components, exact_dedup, language, line_dedup, mixing, pii, queries, simhash, substring_dedup, token_files, topk,
)

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = ("doc_id bigint, text string, lang string, source string, key int, print string, digest string, run int, "
          "label string, size int, lines string, kept string, hash string, block int, n_words string")
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
TEXTS = [
    None, "", " \t\n", "one", "One", "ONE", "a b c", "a b c d e", "É é", "é É", LONG, LONG.upper(), "x" * 200_000,
    "a\nb\nc\nd", "z\na\nb\nc\ny", "a\na\na\na\na\na", "\n\n\n\n\n", "a\n\nb\nq", "p\na\n\nb",
    "mail me@b.co or x@y.z.w, +1 (555) 123-4567 and 4111 1111 1111 1111 from 10.0.0.255 or 1.2.3.256",
    "a@b.c+x@d.e a@b@c.d 1.2.3.4.5.6.7.8 4111-1111-1111-1112 +1+2+34567890 00010.1.1.001 é@é.com É.a@b.cc",
    "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, ssn 123-45-6789, 123-45-6789-1",
    "tokens <|endoftext|> and <|startoftext|>x it's we'll DON'T 123 45 six\x1cseven İΣ é \U0001f600!",
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, text, ("en", "de", None)[i % 3], ("b", "a", None, "")[i % 4]) for i, text in enumerate(TEXTS)]
    rows += [(3, "one", "en", "b"), (3, "one", "en", "b"), (None, "one", None, None), (None, None, None, None),
             (4, "other text of the same id", "de", "a")]
    return spark.createDataFrame([(*row, *[None] * 11) for row in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def pairs(df, *names):
    return sorted((tuple(row) for row in df.select(*(names or ("doc_id", "text"))).collect()), key=repr)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# exact duplicates

@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("fan_in", [2, 32])
def test_exact_dedup(awkward, empty, keep, fan_in):
    groups = {}
    for key, text in pairs(awkward):
        groups.setdefault(lowered(text), []).append(key)
    wanted = []
    for key, text in pairs(awkward):
        known = [k for k in groups[lowered(text)] if k is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        digest = hashlib.sha256(lowered(text).encode()).hexdigest()
        wanted.append((key, best, len(groups[lowered(text)]), key == best, digest))
    got = exact_dedup.exact_dedup(awkward, keep=keep, fan_in=fan_in)
    assert pairs(got, *got.columns) == sorted(wanted, key=repr)
    assert exact_dedup.exact_dedup(empty).count() == 0


# personal data

def luhn(digits):
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub(r"\D", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
}


def base_spans(text):
    found = []
    for kind, (pattern, valid) in BASE.items():
        found += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if valid(m.group())]
    return found


def check_pii(df):
    for row in pii.find_pii(df).select("text", "pii").collect():
        if row["text"] is None or len(row["text"]) < 100_000:
            got = [(s["kind"], s["start"], s["end"]) for s in row["pii"] if s["kind"] in BASE]
            assert got == base_spans(row["text"]), row["text"]
        for span in row["pii"]:
            assert row["text"][span["start"]:span["end"]] == span["text"] and 0 <= span["score"] <= 1


def test_pii_finds_the_spans_of_the_plain_patterns(spark, awkward, docs):
    check_pii(awkward)
    check_pii(docs)
    rng = random.Random(5)
    texts = ["".join(rng.choice("a1@. +-é9(_%") for _ in range(rng.randrange(120))) for _ in range(600)]
    texts += [" ".join("a@b.cd" for _ in range(900)), "1.2.3.4 " * 700]
    check_pii(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_pii_adds_confirmed_kinds_and_context(spark, empty):
    text = "my iban DE89 3704 0044 0532 0130 00, GB82WEST12345698765433; ssn 123-45-6789 " + "x" * 60 + " 321-45-6789"
    found = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()["pii"]
    assert [(s["kind"], s["text"]) for s in found if s["kind"] in ("iban", "ssn")] == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789")]
    assert pii.find_pii(empty).count() == 0
    got = pii.summary(spark.createDataFrame([(1, None)], "doc_id int, text string")).first()
    assert got["n_email"] == 0 and got["base_sha256"] == hashlib.sha256(b"").hexdigest() and got["spans"] == ""


def test_hostile_texts_take_linear_time(spark):
    texts = ["a" * 300_000, "a." * 150_000 + "@", "1." * 150_000, "1 " * 150_000, "+1" * 150_000, "a@b" + ".c" * 150_000]
    assert pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).select(F.size("pii")).collect()


# mixing

def shares(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE, most=mixing.MOST):
    """Targets by reserving capped sources and sharing the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, budget = {}, set(order), share * sum(sizes.values())
    while free:
        unit = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= most * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("table", ["awkward", "docs"])
def test_mixing_meets_its_targets(request, table):
    df = request.getfixturevalue(table)
    rows = mixing.mix(df).collect()
    sizes, own = {}, []
    for key, text, source in pairs(df, "doc_id", "text", "source"):
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
        own.append((key, len(words_of(text))))
    assert sorted([(r["doc_id"], r["size"]) for r in rows], key=repr) == sorted(own, key=repr)
    targets = shares(sizes)
    for source, size in sizes.items():
        mine = [r for r in rows if r["source"] == source]
        assert all(r["source_size"] == size and r["target"] == pytest.approx(targets[source]) for r in mine)
        assert all(r["times"] in (0, 1, 2) and r["taken"] == r["times"] * r["size"] for r in mine)
        largest = max(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - targets[source]) <= largest / 2 + 1e-6
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_mixing_ranges_are_even_for_any_weights(spark):
    for weights in ("0.25", "1.0", "if(id % 3 = 0, 1.0, if(id % 3 = 1, 0.5, 0.25))", "0.01 + (id % 100) / 101.0"):
        df = spark.range(10_000).selectExpr("id", f"{weights} AS weight")
        unit = (F.shiftrightunsigned(F.xxhash64(F.lit(7), "id"), 11).cast("double") + 0.5) / float(2**53)
        keyed = df.withColumn("at", -F.log(unit) / F.col("weight"))
        found = keyed.groupBy(F.floor(4 * F.log2("weight"))).agg(F.count("*").alias("n"), F.avg("weight").alias("weight")).collect()
        mixture = F.array(*[F.struct(F.lit(r["n"]).alias("n"), F.lit(float(r["weight"])).alias("weight")) for r in found])
        place = F.least(F.floor(mixing.below(F.col("at"), mixture) / 100), F.lit(99))
        counts = [r["count"] for r in keyed.groupBy(place.alias("range")).count().collect()]
        assert len(counts) == 100 and max(counts) < 4 * 100


def test_mixing_of_nothing(empty, spark):
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id int, text string, source string")
    assert [r["taken"] for r in mixing.mix(blank).collect()] == [0, 0]


def test_mixing_prefers_quality(spark):
    df = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"),
                                   F.lit("s").alias("source"), (F.col("id") % 2).alias("good"))
    drawn = mixing.mix(df, share=0.5, weight=F.when(F.col("good") == 1, 1.0).otherwise(0.1))
    counts = {r["good"]: r["n"] for r in drawn.filter("times = 1").groupBy((F.col("doc_id") % 2).alias("good"))
              .agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 1000 and counts[1] > 3 * counts[0]


# near-duplicates

def plain_fingerprint(text):
    words = words_of(lowered(text))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(gram.encode(), seed=42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(keyed, bits=4):
    root = list(range(len(keyed)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keyed)):
        for j in range(i):
            if (keyed[i][1] ^ keyed[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(keyed):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, value, least.get(find(i))) for i, (key, value) in enumerate(keyed)]


@pytest.mark.parametrize("table", ["awkward", "docs"])
def test_near_duplicates(request, table):
    df = request.getfixturevalue(table)
    got = [(r[0], r[1] % (1 << 64), r[2]) for r in simhash.near_duplicates(df).collect()]
    keyed = [(key, plain_fingerprint(text)) for key, text in pairs(df)]
    assert sorted(got, key=repr) == sorted(plain_components(keyed), key=repr)


@pytest.mark.parametrize("heavy", [30, 100_000])
def test_links_connect_all_close_prints(spark, heavy):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(400):
        base = rng.choice(sorted(prints)) if rng.random() < 0.5 else centre
        flips = rng.sample(range(64), rng.randrange(1, 6))
        prints.add(base ^ sum(1 << f for f in flips))
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)]
    found = simhash.links(spark.createDataFrame(signed, "print bigint"), heavy)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in found.collect())
    roots = {r["node"]: r["root"] for r in components.connected(found).collect()}
    got = {}
    for (p,) in signed:
        got.setdefault(roots.get(p, p), set()).add(p)
    wanted = {}
    for p, _, least in plain_components([(p, p % (1 << 64)) for (p,) in signed]):
        wanted.setdefault(least, set()).add(p)
    assert got == wanted


@pytest.mark.parametrize("width, bits", [(5, 7), (3, 0)])
def test_near_duplicates_of_other_widths_and_radii(spark, width, bits):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(120)) for _ in range(12)]
    texts += [" ".join(w if rng.random() > 0.02 else "new" for w in t.split()) for t in texts for _ in range(5)]
    texts += ["", "a b", "A b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)

    def plain_print(text):
        words = text.lower().split()
        grams = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
        grams = grams or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(gram.encode(), seed=42) for gram in grams]
        return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))

    wanted = plain_components([(i, plain_print(t)) for i, t in enumerate(texts)], bits)
    got = [(r[0], r[1] % (1 << 64), r[2]) for r in simhash.near_duplicates(df, width=width, bits=bits).collect()]
    assert sorted(got) == sorted(wanted)
    assert bits == 0 or len({least for *_, least in wanted}) < len({value for _, value, _ in wanted})


def shingle_set(text, width=5):
    words = words_of(lowered(text))
    return {" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def similar_roots(texts, similarity=0.8):
    """For each of some different texts the first one it is connected to over similar pairs; all pairs are tried."""
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            two = sets[j]
            if min(len(one), len(two)) >= similarity * max(len(one), len(two)) > 0:
                shared = len(one & two)
                if shared >= similarity * (len(one) + len(two) - shared):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return [find(i) for i in range(len(texts))]


def similar_kept(rows):
    """Keys that stay of (key, text): the smallest of each group of similar texts."""
    texts = sorted({lowered(t) for _, t in rows})
    group = dict(zip(texts, similar_roots(texts)))
    least = {}
    for key, text in rows:
        at = group[lowered(text)]
        least[at] = min(key, least.get(at, key))
    return set(least.values())


def near_copies(rng, count=60):
    """Texts with near copies at similarities from about 0.6 to 1, tight groups and short ones among them."""
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60, 400))) for _ in range(count)]
    for text in list(texts):
        for _ in range(3):
            parts, share = text.split(), rng.choice([0.005, 0.01, 0.015, 0.02, 0.05])
            texts.append(" ".join(w if rng.random() > share else rng.choice(words) for w in parts))
    group = texts[0].split()
    texts += [" ".join([*group[:i], "changed", *group[i + 1:]]) for i in range(0, min(50, len(group)))]
    return texts + ["a b", "A b", "a b c d e f", "a  b", "", None]


def test_similar_texts_find_nearly_all_similar_pairs(spark):
    texts = near_copies(random.Random(8))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = dict(map(tuple, simhash.similar_texts(df).collect()))
    different = sorted({lowered(t) for t in texts})
    first = {t: min(i for i, x in enumerate(texts) if lowered(x) == t) for t in different}
    pairs_, found = 0, 0
    sets = {t: shingle_set(t) for t in different}
    for i, a in enumerate(different):
        for b in different[:i]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                pairs_ += 1
                found += got[first[a]] == got[first[b]]
    assert pairs_ > 500 and found >= 0.9 * pairs_
    roots = dict(zip(different, similar_roots(different)))
    for i, text in enumerate(texts):
        assert roots[lowered(texts[got[i]])] == roots[lowered(text)], "only similar texts are joined"


def test_links_enter_joins_once(spark, monkeypatch):
    """Prints one bit apart meet under 35 of 56 sets of byte positions; at first each of these links went through the joins."""
    prints = spark.createDataFrame([(0,)] + [(1 << bit,) for bit in range(40)], "print bigint")
    found = simhash.links(prints, bits=5)
    pairs_ = {tuple(sorted(row)) for row in found.collect()}
    assert found.count() > 5 * len(pairs_)
    assert sorted(map(tuple, simhash.once(found).collect())) == sorted(pairs_)
    met, links = [], simhash.once
    monkeypatch.setattr(simhash, "once", lambda rows_: met.append(1) or links(rows_))
    texts = spark.createDataFrame(list(enumerate(near_copies(random.Random(3), 4))), "doc_id bigint, text string")
    simhash.similar_texts(texts, count=2)
    assert len(met) == 2


def test_similar_texts_of_the_given_table(docs, awkward, empty):
    rows = pairs(docs)
    got = dict(map(tuple, simhash.similar_texts(docs).collect()))
    kept = {key for key, least in got.items() if key == least}
    assert kept == similar_kept(rows)
    assert simhash.similar_texts(empty).count() == 0
    assert simhash.similar_texts(awkward).count() == awkward.count()


def test_radius_beyond_the_byte_guarantee_is_refused(empty):
    with pytest.raises(ValueError):
        simhash.near_duplicates(empty, bits=8)


def test_near_duplicates_of_nothing(empty):
    assert simhash.near_duplicates(empty).count() == 0


# lines

def plain_lines(rows, run=line_dedup.RUN):
    """Text after deletion by (key, text)."""
    order = sorted({(k, t or "") for k, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for key, text in order:
        lines, gone = text.split("\n"), set()
        for at in range(len(lines) - run + 1):
            part = tuple(lines[at:at + run])
            if all(line.strip(" ") == "" for line in part):
                continue
            if part in seen:
                gone |= set(range(at, at + run))
            seen.add(part)
        out[key, text] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("table", ["awkward", "docs"])
def test_line_dedup(request, table):
    df = request.getfixturevalue(table)
    wanted = plain_lines(pairs(df))
    got = line_dedup.dedup_lines(df, report=("n_before", "n_gone"))
    assert got.columns == [*df.columns, "n_before", "n_gone"]
    expected = [(key, None if text is None else wanted[key, text]) for key, text in pairs(df)]
    assert pairs(got) == sorted(expected, key=repr)


def test_line_dedup_of_nothing_and_of_many_runs(empty, spark):
    assert line_dedup.dedup_lines(empty).count() == 0
    blocks = "\n".join(f"{x}{i}" for i in range(2_000) for x in "abc")
    mixed = "\n".join(f"{x}{i}\nnew{i}" if x == "c" else f"{x}{i}" for i in range(2_000) for x in "abc")
    df = spark.createDataFrame([(1, blocks), (2, mixed)], "doc_id int, text string")
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert kept == {1: blocks, 2: "\n".join(f"new{i}" for i in range(2_000))}


def plain_long_lines(rows, words, run=line_dedup.RUN):
    order = sorted({(k, t or "") for k, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for key, text in order:
        lines, gone = text.split("\n"), set()
        for length in range(1, run + 1):
            for at in range(len(lines) - length + 1):
                part = tuple(lines[at:at + length])
                short = length < run and sum(len(words_of(line)) for line in part) < words
                if short or all(line.strip(" ") == "" for line in part):
                    continue
                if part in seen:
                    gone |= set(range(at, at + length))
                seen.add(part)
        out[key, text] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("table, words", [("awkward", 1), ("docs", 50)])
def test_line_dedup_of_long_lines(request, table, words):
    df = request.getfixturevalue(table)
    wanted, short = plain_long_lines(pairs(df), words), plain_lines(pairs(df))
    assert wanted != short
    expected = [(key, None if text is None else wanted[key, text]) for key, text in pairs(df)]
    assert pairs(line_dedup.dedup_lines(df, words=words)) == sorted(expected, key=repr)


def test_line_dedup_replaces_columns_of_the_report(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", 9), (2, "a\nb\nc", 8)], "doc_id int, text string, n_lines int")
    got = line_dedup.dedup_lines(df, report=("n_lines", "n_removed"))
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert pairs(got, "doc_id", "n_lines", "n_removed") == [(1, 3, 0), (2, 3, 3)]


def test_line_dedup_of_one_long_line(spark):
    long = " ".join(f"w{i}" for i in range(50))
    half = [" ".join(f"{x}{i}" for i in range(25)) for x in "ab"]
    df = spark.createDataFrame([
        (1, long), (2, long), (3, "a\n" + long + "\nb"), (4, "\n".join(half)), (5, "\n".join(["c", *half, "d"])),
        (6, half[0]), (7, long.rsplit(" ", 1)[0]), (8, long.rsplit(" ", 1)[0])], "doc_id int, text string")
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, words=50).collect()}
    assert [kept[i] for i in (2, 3, 5)] == ["", "a\nb", "c\nd"]
    assert kept[8] == kept[7] != "" and kept[6] == half[0] and kept[1] == long


# language

def test_language_learns_from_different_texts(spark):
    rows = [("xx", f"text number {i}") for i in range(6)]
    copied = rows[:1] * 500 + rows[1:]
    df = spark.createDataFrame(copied, "lang string, text string").repartition(3)
    first = (F.col("text") != rows[0][1]).cast("int")
    found = language.learn(df, order=first, sample_docs=4)
    assert found == {"xx": "\n".join(text for _, text in reversed(rows[:4])).encode()}
    assert language.learn(df, order=first, sample_docs=4, dictionary_bytes=20) == {"xx": found["xx"][-20:]}
    assert language.learn(df, order=first, sample_docs=4, dictionary_bytes=0) == {"xx": b""}


def test_language_sample_is_the_lowest_hashes(spark):
    df = spark.range(3_000).selectExpr("if(id % 3 = 0, 'aa', 'bb') AS lang", "concat('Text ', id % 900) AS text")
    found = language.learn(df, sample_docs=20)
    for lang in ("aa", "bb"):
        texts = df.filter(F.col("lang") == lang).select(F.lower("text").alias("text")).distinct()
        lowest = [r["text"] for r in texts.orderBy(F.xxhash64("text")).limit(20).collect()]
        assert found[lang] == "\n".join(reversed(lowest)).encode()


def plain_sizes(text, dictionaries):
    """Compressed sizes of a whole text per language."""
    import zstandard

    content, sizes = text.lower().encode(), {}
    for lang in sorted(dictionaries):
        words = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=language.LEVEL, write_content_size=False, write_checksum=False,
                                              write_dict_id=False, dict_data=words)
        sizes[lang] = sum(len(compressor.compress(content[i:i + language.PIECE])) for i in range(0, len(content), language.PIECE))
    return sizes


def plain_language(text, dictionaries):
    """The language whose dictionary compresses best."""
    if text is None or not any(map(str.isalpha, text)):
        return "und"
    sizes = plain_sizes(text, dictionaries)
    return min(sizes, key=lambda lang: (sizes[lang], lang))


def clear_language(text, dictionaries):
    """Whether the best language leads the second by more than the margin."""
    if text is None or not any(map(str.isalpha, text)):
        return False
    best, second = sorted(plain_sizes(text, dictionaries).values())[:2]
    return 1 - best / second > language.MARGIN


def test_language_agrees_with_plain_compression(docs):
    dictionaries = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    got = language.identify(docs, dictionaries).collect()
    assert [r["lang_pred"] for r in got] == [plain_language(r["text"], dictionaries) for r in got]


def test_language_on_held_out_documents(docs, spark):
    rows = queries.op6_language(spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_texts(awkward, empty):
    known = {"en": b"the and of with that " * 50, "de": b"und der die das nicht " * 50}
    got = language.identify(awkward, known)
    assert got.count() == awkward.count() and set(awkward.columns) < set(got.columns)
    for row in got.collect():
        letters = any(map(str.isalpha, row["text"] or ""))
        assert (row["lang_pred"] in known) == letters and (row["accepted"] is False or letters)
    assert language.learn(empty) == {}
    assert {r["lang_pred"] for r in language.identify(awkward, {}).collect()} == {"und"}
    assert set(language.learn(awkward, sample_docs=2)) == {"en", "de"}


# passages

def plain_passages(rows, window=substring_dedup.WINDOW):
    least = {}
    for key, text in rows:
        words = words_of(text)
        for at in range(len(words) - window + 1):
            part = tuple(words[at:at + window])
            order = (key is None, key or 0)
            least[part] = min(least.get(part, order), order)
    out = []
    for key, text in rows:
        words, gone = words_of(text), set()
        for at in range(len(words) - window + 1):
            if least[tuple(words[at:at + window])] < (key is None, key or 0):
                gone |= set(range(at, at + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_passages(spark, awkward, empty):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(40)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    texts = []
    for i in range(60):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        start = rng.randrange(0, 15)
        part = passage[start:start + rng.randrange(45, 56)] if i % 2 else []
        texts.append((i, " ".join([*own, *part, *own[:10], *part])))
    texts += [(100, texts[5][1]), (2, texts[7][1]), (None, texts[9][1]), (101, texts[5][1].replace(" ", "  "))]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    for table in (df, awkward.filter("doc_id IS NULL OR doc_id NOT IN (10, 11)")):
        got = substring_dedup.dedup_passages(table)
        assert pairs(got, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_passages(pairs(table))
    assert substring_dedup.dedup_passages(empty).count() == 0


# token files

def test_token_files_agree_with_the_library(spark, awkward, empty, docs, tmp_path):
    from tokenizers import Tokenizer

    file = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    for number, table in enumerate((awkward, docs)):
        out = str(tmp_path / str(number))
        manifest = token_files.write(table, out, file, 2)
        start, wanted = 0, []
        for key, text in sorted(pairs(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
            wanted.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = token_files.read(manifest, out)
        assert pairs(got, *got.columns) == sorted(wanted, key=repr)
        first = manifest.orderBy("part").first()
        assert token_files.fetch(out, first["name"], 0)[0] == wanted[0][0]
    manifest = token_files.write(empty, str(tmp_path / "none"), file, 2)
    assert token_files.read(manifest, str(tmp_path / "none")).count() == 0


def test_damaged_records_are_found():
    content = bytearray(token_files.record(7, np.array([1, 2, 70_000]), 4))
    assert token_files.read_record(memoryview(content), 0)[1].tolist() == [1, 2, 70_000]
    for at in (0, 9, 14, len(content) - 1):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.read_record(memoryview(broken), 0)


def test_byte_encoder_cuts_where_the_library_cuts():
    from tokenizers import Tokenizer

    file = queries.vocabulary("byte_bpe_50k.json")
    library, own, rng = Tokenizer.from_file(file), token_files.ByteEncoder(file), random.Random(1)
    for _ in range(3_000):
        text = "".join(rng.choice("ab '\n\t\x1c\x1f\x85  　1é!s ") for _ in range(rng.randrange(25)))
        assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


# byte-pair encoding

def test_bpe_agrees_with_the_library(awkward, docs):
    from tokenizers import Tokenizer

    file = queries.vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    for table in (awkward.filter("doc_id IS NULL OR doc_id <> 12"), docs):
        wanted = []
        for key, text in pairs(table):
            ids = library.encode(text or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            wanted.append((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                           hashlib.sha256(decoded.encode()).hexdigest()))
        got = bpe.digests(table, file)
        assert pairs(got, *got.columns) == sorted(wanted, key=repr)


def test_bpe_on_random_texts():
    from tokenizers import Tokenizer

    file = queries.vocabulary("word_bpe_49k.json")
    library, own, rng = Tokenizer.from_file(file), bpe.WordBpe(file), random.Random(2)
    signs = "aAbeE '\n\t\x1c\x1f\x85  　1é́!stİΣσß中\U0001f600|<>"
    for _ in range(3_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(30)))
        if rng.random() < 0.2:
            text += rng.choice(["<|endoftext|>", " <|startoftext|>b", "<|ENDOFTEXT|>"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_columns(awkward, empty):
    file = queries.vocabulary("word_bpe_49k.json")
    encoded = bpe.encode(awkward.filter("doc_id < 9"), file)
    decoded = bpe.decode(encoded, file, out="back").orderBy("doc_id").collect()
    assert [r["back"] for r in decoded if r["doc_id"] == 6] == ["a</w> b</w> c</w>"]
    assert bpe.encode(empty, file).count() == 0


# top k

def brute_top(rows, k, asks):
    sound = [(i, np.floor(64 * np.asarray(v, float)).astype(int)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if asks(q):
            scored = sorted((-int(a @ b), i) for i, b in sound if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 1000])
def test_top_k(spark, block):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(60 + i, rows[20][1]) for i in range(30)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5),
             (105, [0.0] * 5), (110, [1.0, 2.0]), (111, [1.0, -2.0]), (115, [300.0] * 5), (120, []), (None, [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    rounded = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=8, block=block)
    assert [tuple(r) for r in got.orderBy("query_id", "rank").collect()] == brute_top(rounded, 8, lambda q: q % 5 == 0)
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_large_components(spark):
    big = float(1 << 22)
    rows = [(0, [big, 0.0]), (1, [big, 1.0]), (2, [-big, 3.0]), (3, [1.0, 1.0]), (5, [1.0, 2.0]), (6, [float(1 << 24), 0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=8, block=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute_top(rows, 8, lambda q: q % 5 == 0)
    # Sums that pass 64 bits on the way, scores that do not.
    found = topk._products(np.array([[1 << 61, 1 << 61, 1]]), np.array([1 << 10, -(1 << 10), 7]))
    assert found.tolist() == [7]
    with pytest.raises(OverflowError):
        topk._products(np.array([[1 << 61]]), np.array([1 << 10]))
    with pytest.raises(Exception, match="or more"):
        topk.top_k(spark.createDataFrame([(0, [1e38])], df.schema), F.lit(True)).count()


def test_top_k_deals_rows_of_one_id(spark):
    df = spark.range(400).selectExpr("1L AS id", "array(1L, 2L) AS vector", "2 AS dims")
    sizes = [len(r["ids"]) // 8 for r in topk._blocks(df, 8, "").collect()]
    assert sum(sizes) == 400 and max(sizes) < 100


# registered queries

@pytest.fixture(scope="module")
def db():
    import check

    return check.database(SF_DIR)


@pytest.mark.parametrize("name", [name for name, (_, sql) in queries.QUERIES.items() if sql])
def test_query_agrees_with_its_sql(spark, docs, db, name):
    import check

    run, sql = queries.QUERIES[name]
    df, wanted = run(spark, SF_DIR), db.sql(sql)
    assert sorted(df.columns) == sorted(wanted.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(wanted.columns, wanted.fetchall())


def test_digest_runs_merge_in_sorted_rounds(spark):
    rows = spark.range(640).selectExpr("id AS doc_id", "cast(id % 100 AS string) AS text").repartition(16)
    digests = rows.select(F.col("doc_id").alias("key"), F.sha2("text", 256).alias("digest"), F.lit(0).alias("proof"),
                          F.lit(1).alias("bytes"), F.spark_partition_id().alias("run")).cache()
    merged = exact_dedup._merged(digests, ["digest", "proof", "bytes"], F.max, 2)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    rounds = plan.count("row_number(")
    assert rounds >= 3 and merged.count() == 100
    merged.collect()
    executed = merged._jdf.queryExecution().executedPlan().toString()
    assert executed.count("+- Sort [run") >= 3 or executed.count("Sort [run") >= 3
    digests.unpersist()


def test_native_operators_run_no_python(spark, docs):
    frames = [pii.summary(docs), exact_dedup.exact_dedup(docs), mixing.mix(docs), line_dedup.dedup_lines(docs)]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
