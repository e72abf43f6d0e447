"""Click-stream logs: entry checks, the five-way split and the page-log table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times, values
from ..schemas import PAGE_LOG

STREAMS = ("err", "start", "display", "action", "page")
# The fields of a raw log record. Each is kept as its own JSON text, so what lies inside passes through unchanged.
FIELDS = ("common", "start", "page", "err", "displays", "actions", "ts")
_RECORD = ", ".join(f"{name} string" for name in FIELDS)
_ELEMENTS = "array<map<string,variant>>"


def _checked(rows: DataFrame) -> DataFrame:
    """Rows with a visitor id and a time, with event time `et`."""
    kept = rows.withColumn("ts", F.col("ts").try_cast("bigint"))
    kept = kept.filter(values.filled(F.col("mid")) & F.col("ts").isNotNull())
    return kept.withColumn("et", F.timestamp_millis("ts"))


def parse(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON log messages as `rec` (one JSON text per field) with `mid`, `is_new`, `ts`, event time `et` and `tie`.

    Records without a visitor id or a time are dropped. `tie` orders records of one visitor and instant.
    """
    parsed = values.compute_once(messages, F.xxhash64(value).alias("tie"), rec=F.from_json(value, _RECORD))
    known = values.compute_once(parsed, "rec", "tie", c=F.from_json("rec.common", "mid string, is_new string"))
    return _checked(known.select("rec", "c.mid", "c.is_new", "rec.ts", "tie"))


def heads(messages: DataFrame, value: str = "value", keep: bool = False) -> DataFrame:
    """`parse` without `rec`: reads only the few fields a visitor's history needs, and may `keep` the message."""
    kept = [value] if keep else []
    parsed = values.compute_once(
        messages,
        *kept,
        F.xxhash64(value).alias("tie"),
        h=F.from_json(value, "common struct<mid:string,is_new:string>, ts string"),
    )
    return _checked(parsed.select("h.common.mid", "h.common.is_new", "h.ts", "tie", *kept))


def records(heads: DataFrame, value: str = "value") -> DataFrame:
    """`heads` that keep the message, with `rec` read from it."""
    return values.compute_once(heads, *[name for name in heads.columns if name != value], rec=F.from_json(value, _RECORD))


def with_flag(logs: DataFrame) -> DataFrame:
    """Write the (repaired) `is_new` column back into the record; records that have it already stay as they are.

    In a flat object without escapes the flag is replaced in the text, where its name can only be a key; others are parsed.
    """
    common, flag = F.col("rec.common"), F.col("is_new")
    same = flag.eqNullSafe(F.get_json_object(common, "$.is_new"))
    fields = F.from_json(common, "map<string,variant>")
    rewritten = F.to_json(
        F.transform_values(fields, lambda key, v: F.when(key == "is_new", flag.cast("variant")).otherwise(v))
    )
    replaced = F.regexp_replace(common, r'"is_new"(\s*:\s*)(?:"[^"]*"|[^",}\s]+)', '"is_new"$1"0"')
    written = F.when((flag == "0") & common.rlike(r"^\{[^{}\[\]\\]*\}$"), replaced).otherwise(rewritten)
    return logs.withColumn("rec", F.col("rec").withField("common", F.when(same, common).otherwise(written)))


def _members(*fields: str) -> Column:
    """The named fields as members of a JSON object; absent fields are left out."""
    return F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), F.col(f"rec.{name}")) for name in fields])


def _object(members: Column) -> Column:
    return F.concat(F.lit("{"), members, F.lit("}"))


def _elements(field: str) -> Column:
    """Each element of an array field as a JSON object with the page, the common part and the time set in it."""
    added = ("page", "common", "ts")

    def with_context(item: Column) -> Column:
        own = F.map_filter(item, lambda key, _: ~key.isin(*added))
        own_members = F.when(F.size(own) > 0, F.regexp_extract(F.to_json(own), r"(?s)^\{(.*)\}$", 1))
        return _object(F.concat_ws(",", own_members, _members(*added)))

    return F.transform(F.from_json(F.col(f"rec.{field}"), _ELEMENTS), with_context)


def tagged(logs: DataFrame) -> DataFrame:
    """Every output record of the split as (stream, value JSON), in one pass over the logs.

    A record with an error goes whole to `err`, and on without the error. A start record goes to `start`. A page
    record gives one `display` / `action` per element and one `page` without those arrays.
    """
    nothing = F.array().cast("array<struct<stream:string,value:string>>")

    def out(stream: str, value: Column) -> Column:
        return F.struct(F.lit(stream).alias("stream"), value.alias("value"))

    def each(stream: str, field: str) -> Column:
        items = F.transform(_elements(field), lambda value: out(stream, value))
        return F.when(F.col(f"rec.{field}").isNotNull(), F.coalesce(items, nothing)).otherwise(nothing)

    failed = F.when(F.col("rec.err").isNotNull(), F.array(out("err", _object(_members(*FIELDS))))).otherwise(nothing)
    start = F.array(out("start", _object(_members("common", "start", "page", "displays", "actions", "ts"))))
    page = F.concat(
        each("display", "displays"),
        each("action", "actions"),
        F.array(out("page", _object(_members("common", "page", "ts")))),
    )
    main = (
        F.when(F.col("rec.start").isNotNull(), start).when(F.col("rec.page").isNotNull(), page).otherwise(nothing)
    )
    return logs.select("mid", "ts", "et", F.inline(F.concat(failed, main)))


def split(logs: DataFrame) -> dict[str, DataFrame]:
    """The five output streams by name."""
    out = tagged(logs)
    return {name: out.filter(F.col("stream") == name).select("value") for name in STREAMS}


def pages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Page-log messages as flat columns; only the fields the summary jobs read are parsed."""
    parsed = values.compute_once(messages, p=F.from_json(value, PAGE_LOG))
    return parsed.select("p.common.*", "p.page.*", "p.ts")


def page_views(pages_: DataFrame, page_ids: tuple[str, ...] | None = None) -> DataFrame:
    """Pages with a visitor and a time, optionally of some page kinds, with event time `et`."""
    kept = pages_.filter(values.filled(F.col("mid")) & (F.col("ts") > 0))
    if page_ids:
        kept = kept.filter(F.col("page_id").isin(*page_ids))
    return kept.withColumn("et", times.from_epoch(F.col("ts"), "ms"))


def logins(pages_: DataFrame) -> DataFrame:
    """Pages that are a log-in: a known user whose previous page is none or the login page."""
    entered = F.col("last_page_id").isNull() | (F.col("last_page_id") == "login")
    return pages_.filter((F.col("ts") > 0) & F.col("uid").isNotNull() & entered).withColumn(
        "et", times.from_epoch(F.col("ts"), "ms")
    )
