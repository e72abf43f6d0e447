"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
CONTEXT = 40
THRESHOLD = 0.5
_SPAN = "struct<start:int,end:int,text:string>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` has it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(digits, -at, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(at % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code of capitals and digits has remainder 1 (ISO 13616)."""
    bare = F.replace(code, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        letter = F.ascii(char)
        return F.when(letter >= 65, rest * 100 + letter - 55).otherwise(rest * 10 + letter - 48) % 97

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), add) == 1


def _octets(address: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.char_length(bare) <= 3) & (F.coalesce(F.try_to_number(bare, F.lit("999")), F.lit(0)) <= 255)

    return F.forall(F.split(address, r"\."), small)


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.char_length(_digits(match)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """`guard` is a string that every match holds; `base` kinds are reported whatever their score."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    words: str
    guard: str | None = None
    base: bool = True


# The patterns find the same leftmost matches as their plain forms in linear time: a match starts where a run of its
# characters starts or the match before ended (\G), and runs are not given up again.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda match: F.lit(True), 0.9, "mail|contact|write", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, r"\bip\b|host|server|address", "."),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
         lambda match: luhn(_digits(match)), 0.8, "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _between(8, 15), 0.6, "phone|call|tel|mobile|fax", "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         mod97, 0.8, "iban|account|bank|konto|compte", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda match: F.lit(True), 0.3,
         r"ssn|social|security|tax", "-", base=False),
)


def _placed(text: Column, pattern: str, found: Column) -> Column:
    """Matches with their positions, in code points: the pieces between matches give the gaps.

    Positions are summed in blocks, so that a text with very many matches costs no quadratic copying.
    """

    def place(acc: Column, pair: Column) -> Column:
        start = (acc["at"] + pair["gap"]).cast("int")
        end = (start + F.char_length(pair["text"])).cast("int")
        span = F.struct(start.alias("start"), end.alias("end"), pair["text"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def blockwise(pairs: Column) -> Column:
        def block(acc: Column, number: Column) -> Column:
            start = F.struct(acc["at"].alias("at"), F.expr(f"cast(array() as array<{_SPAN}>)").alias("out"))
            inner = F.aggregate(F.slice(pairs, number * BLOCK + 1, F.lit(BLOCK)), start, place)
            return _let(inner, lambda done: F.struct(
                done["at"].alias("at"), F.concat(acc["out"], F.array(done["out"])).alias("out")))

        zero = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<array<{_SPAN}>>)").alias("out"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
        return F.flatten(F.aggregate(blocks, zero, block, lambda acc: acc["out"]))

    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda piece, match: F.struct(
        F.char_length(piece).alias("gap"), match.alias("text")))
    return _let(pairs, blockwise)


def _spans(text: Column, kind: Kind) -> Column:
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if kind.guard:
        found = F.when(F.contains(text, F.lit(kind.guard)), found).otherwise(F.expr("cast(array() as array<string>)"))
    spans = _let(found, lambda f: F.when(F.size(f) > 0, _placed(text, kind.pattern, f)).otherwise(none))

    def scored(span: Column) -> Column:
        first = F.greatest(span["start"] - CONTEXT, F.lit(0))
        around = F.lower(F.substr(text, first + 1, span["end"] + CONTEXT - first))
        score = F.lit(kind.score) + F.when(F.rlike(around, F.lit(kind.words)), F.lit(0.3)).otherwise(F.lit(0.0))
        return F.struct(F.lit(kind.name).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                        span["text"].alias("text"), F.round(F.least(score, F.lit(1.0)), 2).alias("score"))

    scored_spans = F.transform(F.filter(spans, lambda span: kind.valid(span["text"])), scored)
    return scored_spans if kind.base else F.filter(scored_spans, lambda span: span["score"] >= THRESHOLD)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add `out`: array of (kind, start, end, text, score), by kind as in KINDS, then start.

    Positions are code points, the end is exclusive. Within a kind spans are leftmost and do not overlap; a match
    that fails its check (octets, Luhn, digit count, mod-97) is dropped without another try. Base kinds are reported
    at any score, the others from a score of THRESHOLD on: an account code by its checksum, a social security number only
    with a word like 'ssn' within CONTEXT characters. Null and empty texts give an empty array. All other columns
    stay, one of the name `out` is replaced. Repeated rows are searched each, an empty table stays empty. One pass
    without a shuffle; a text of any length is handled whole in its row.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(out, F.concat(*[_spans(whole, kind) for kind in KINDS]))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the key, the count of each base kind, base_sha256 and all spans as text."""
    base = [kind.name for kind in KINDS if kind.base]
    found = find_pii(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", "_pii").drop("_text")

    def count(name: str) -> Column:
        return F.size(F.filter("_pii", lambda s: s["kind"] == name)).cast("bigint").alias(f"n_{name}")

    counts = [count(name) for name in base]
    return found.select(
        F.col("_key").alias(key), *counts,
        F.sha2(joined(F.filter("_pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("_pii")).alias("spans"),
    )
