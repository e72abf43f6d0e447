"""Order details from keyed state: a line is written at once and again whenever one of its other records comes.

Two chained stateful steps. The first is keyed by line and keeps the last line, activity and coupon record; the second
is keyed by order and keeps the order with its lines. A micro-batch reads the state of the keys it touches and nothing else, however
long the history is. Both run in Python, a call per key; where the lines go to a table anyway, `order_detail_table` needs
none: lines meet their orders in a stream join, and the table takes in activities and coupons as parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import schemas, session
from ..functions import times
from ..operators import cdc
from ..sinks import merge_tables, upserts
from . import queries

_LINE = ["order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "split_total_amount",
         "split_activity_amount", "split_coupon_amount"]
_ORDER = {"user_id": "user_id", "province_id": "province_id"}
_ACTIVITY = {"activity_id": "activity_id", "activity_rule_id": "activity_rule_id"}
_COUPON = {"coupon_id": "coupon_id"}


def _struct(names: Iterable[str], *more: T.StructField) -> T.StructType:
    return T.StructType([*[T.StructField(name, T.StringType()) for name in names], *more])


_LINE_TYPE = _struct(_LINE, T.StructField("ts", T.LongType()))
_PARTS = {"line": _LINE_TYPE, "activity": _struct(_ACTIVITY), "coupon": _struct(_COUPON)}
_WIDE = _struct([*_LINE, *_ACTIVITY, *_COUPON], T.StructField("ts", T.LongType()))
_ORDER_TYPE = _struct(_ORDER)
_KEYED_LINE = T.StructType([*_struct(["order_id", "id"]).fields, T.StructField("wide", _WIDE), T.StructField("at", T.LongType())])


def _values(struct: Row | dict | None) -> tuple | None:
    """The fields of a struct, which workers get as a row or as a dictionary."""
    return None if struct is None else tuple(struct.values() if isinstance(struct, dict) else struct)


def _last(rows: Iterable[Row], name: str) -> tuple | None:
    """The last filled struct of a name, by `at`; of equal moments the largest, so that a repeated run agrees."""
    found = [(row["at"], _values(row[name])) for row in rows if row[name] is not None]
    return max(found, key=lambda f: (f[0] is not None, f[0], [(v is not None, v) for v in f[1]]))[1] if found else None


class _Processor(StatefulProcessor):
    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def close(self) -> None:
        pass


class Lines(_Processor):
    """Key: line id. Emits the line with what is known of it whenever that changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        known = T.StructType([T.StructField(name, kind) for name, kind in _PARTS.items()])
        self.known = handle.getValueState("known", known, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        before = self.known.get()
        before = [None] * len(_PARTS) if before is None else [_values(part) for part in before]
        after = []
        for name, old in zip(_PARTS, before):
            new = _last(rows, name)
            after.append(old if new is None else new)
        if after == before:
            return
        self.known.update(tuple(after))
        line, activity, coupon = after
        if line is not None:
            wide = (*line[:-1], *(activity or [None] * len(_ACTIVITY)), *(coupon or [None] * len(_COUPON)), line[-1])
            at = max((row["at"] for row in rows if row["at"] is not None), default=None)
            yield Row(order_id=line[0], id=key[0], wide=Row(**dict(zip(_WIDE.names, wide))), at=at)


    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.known.update(tuple(_values(initialState[name]) for name in _PARTS))


class Orders(_Processor):
    """Key: order. Emits a line when it or its order changes, once both are known."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.order = handle.getValueState("order", _ORDER_TYPE, self.ttl_ms)
        self.lines = handle.getMapState("lines", "id string", _WIDE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        order, new_order = self.order.get(), _last(rows, "order")
        of_line: dict[str, list[Row]] = {}
        for row in rows:
            if row["wide"] is not None:
                of_line.setdefault(row["id"], []).append(row)
        fresh = {id_: _last(found, "wide") for id_, found in of_line.items()}
        for id_, wide in fresh.items():
            self.lines.updateValue((id_,), wide)
        if new_order is not None and (order is None or tuple(order) != new_order):
            order = new_order
            self.order.update(order)
            fresh = {id_[0]: _values(wide) for id_, wide in self.lines.iterator()}
        if order is not None:
            for id_, wide in fresh.items():
                values = {"id": id_, **dict(zip(_WIDE.names, wide)), **dict(zip(_ORDER, order))}
                yield Row(**{name: values[name] for name in schemas.ORDER_DETAIL})


    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        if initialState["order"] is not None:
            self.order.update(_values(initialState["order"]))
        if initialState["wide"] is not None:
            self.lines.updateValue((initialState["id"],), _values(initialState["wide"]))


def _inserted(envelope: DataFrame, database: str | None) -> DataFrame:
    rows = envelope.filter(F.col("type").isin(*cdc.INSERTS))
    return rows if database is None else rows.filter(F.col("database") == database)


def _filled(table: str, fields: dict[str, str], kind: T.StructType, *more: Column) -> Column:
    """The fields of a record of one table as a struct; null for records of other tables."""
    values = [F.col("data")[key].alias(field) for field, key in fields.items()]
    return F.when(F.col("table") == table, F.struct(*values, *more).cast(kind))


def _records(envelope: DataFrame, database: str | None) -> tuple[DataFrame, DataFrame]:
    """Records keyed by line (id, line, activity, coupon, at) and by order (order_id, order, at)."""
    inserted = _inserted(envelope, database)
    names = ("order_detail", "order_detail_activity", "order_detail_coupon")
    parts = (_filled(names[0], {name: name for name in _LINE}, _LINE_TYPE, F.col("ts")),
             _filled(names[1], _ACTIVITY, _PARTS["activity"]), _filled(names[2], _COUPON, _PARTS["coupon"]))
    line_id = F.when(F.col("table") == names[0], F.col("data")["id"]).otherwise(F.col("data")["order_detail_id"])
    of_line = inserted.filter(F.col("table").isin(*names)).select(
        line_id.alias("id"), *[part.alias(name) for name, part in zip(_PARTS, parts)], F.col("ts").alias("at"))
    of_order = inserted.filter(F.col("table") == "order_info").select(
        F.col("data")["id"].alias("order_id"), _filled("order_info", _ORDER, _ORDER_TYPE).alias("order"), F.col("ts").alias("at"))
    return of_line.filter("id IS NOT NULL"), of_order.filter("order_id IS NOT NULL")


def _last_of(rows: DataFrame, key: str, names: Iterable[str]) -> DataFrame:
    """Per key the last filled struct of each name: what the state holds after these rows."""
    return rows.groupBy(key).agg(*[
        F.max(F.when(F.col(name).isNotNull(), F.struct("at", name)))[name].alias(name) for name in names])


def _wide() -> Column:
    """The line with its activity and coupon."""
    parts = [*[("line", name) for name in _LINE], *[("activity", name) for name in _ACTIVITY],
             *[("coupon", name) for name in _COUPON], ("line", "ts")]
    return F.when(F.col("line").isNotNull(), F.struct(*[F.col(part)[name].alias(name) for part, name in parts])).cast(_WIDE)


def _part(spread: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int").alias("part")


def _every_part(spread: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part")


def order_details(envelope: DataFrame, database: str | None = None, ttl: str | None = None, spread: int = 1,
                  past: DataFrame | None = None) -> DataFrame:
    """Versions of order lines from a stream of change records: the columns of `plans.dwd.order_detail`.

    Whenever a line, its order, activity or coupon is inserted, the lines this changes come out as they are now, whatever
    their age; the last version of a line is the row that the batch job gives. Of several records of one key the last one counts, by
    `ts` within a micro-batch and by arrival across them. Records without their key are left out, as in a join.

    State is kept for good, or with `ttl` for so long after it was written, in processing time; such a query goes on
    until it is stopped. An order with very many lines may be dealt over `spread` keys, each of which keeps the
    order. Records of `past`, a batch, came before the stream: they are in the state from the start, and lines they
    complete do not come out again.
    """
    ttl_ms = None if ttl is None else int(times.seconds(ttl) * 1000)

    def stateful(rows: DataFrame, keys: list[str], processor: _Processor, out: T.StructType, start: DataFrame | None) -> DataFrame:
        return rows.groupBy(*keys).transformWithState(
            statefulProcessor=processor, outputStructType=out, outputMode="Append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
            initialState=None if start is None else start.groupBy(*keys))

    def dealt(lines: DataFrame, orders: DataFrame) -> DataFrame:
        no_order = F.lit(None).cast(_ORDER_TYPE).alias("order")
        return lines.filter("order_id IS NOT NULL").select("*", _part(spread), no_order).unionByName(
            orders.select("*", _every_part(spread)), allowMissingColumns=True)

    line_start = order_start = None
    if past is not None:
        known, placed = _records(past, database)
        line_start = session.settled(_last_of(known, "id", _PARTS))
        lines = line_start.select(F.col("line.order_id").alias("order_id"), "id", _wide().alias("wide"))
        order_start = dealt(lines, _last_of(placed, "order_id", ["order"]))
    of_line, of_order = _records(envelope, database)
    wide = stateful(of_line, ["id"], Lines(ttl_ms), _KEYED_LINE, line_start)
    result = T.StructType([*_struct(schemas.ORDER_DETAIL[:-1]).fields, T.StructField("ts", T.LongType())])
    return stateful(dealt(wide, of_order), ["order_id", "part"], Orders(ttl_ms), result, order_start)


def order_detail_versions(envelope: DataFrame, checkpoint: str, out: str, once: bool = False, database: str | None = None,
                          ttl: str | None = None) -> StreamingQuery:
    """Append the versions of `order_details` to the version log `out`; the last one per id counts (`sinks.upserts.read`)."""
    versions = order_details(envelope, database, ttl)
    return queries.each_batch(versions, checkpoint, lambda rows, batch: upserts.append(rows, out, batch), once)


_ARRIVED = [T.StructField("arrived", T.LongType()), T.StructField("at", T.LongType())]
_PLACED = T.StructType([*_ARRIVED, *_struct(_LINE).fields, T.StructField("order", T.StructType([*_ARRIVED, *_ORDER_TYPE.fields]))])
_TABLE_PARTS = {"placed": _PLACED, **{name: T.StructType([*_ARRIVED, *_PARTS[name].fields]) for name in ("activity", "coupon")}}


def order_detail_parts(envelope: DataFrame, database: str | None = None) -> DataFrame:
    """What a stream of change records tells of order lines: id, and `placed`, `activity` or `coupon` as one struct.

    A line and its order meet in the state of a stream join, whatever their age. Activities and coupons pass as they come;
    a table of `parts_table` puts them to their line. Each struct begins with its arrival and its `ts`, so the greatest one
    of a key is the last: by arrival across micro-batches, by `ts` within one. Records without their key are left out.
    """
    inserted = _inserted(envelope, database).withColumn("_arrived", F.unix_micros(F.current_timestamp()))

    def of(table: str, fields: Iterable[str], kind: T.StructType, *more: Column) -> Column:
        values = [F.col("data")[name] for name in fields]
        return F.when(F.col("table") == table, F.struct("_arrived", "ts", *values, *more).cast(kind))

    lines = inserted.filter("table = 'order_detail'").select(
        F.col("data")["id"].alias("id"), *[F.col("data")[name].alias(name) for name in _LINE],
        F.col("_arrived").alias("arrived"), F.col("ts").alias("at")).filter("id IS NOT NULL AND order_id IS NOT NULL")
    orders = inserted.select(F.col("data")["id"].alias("_of"), of("order_info", _ORDER.values(), _PLACED["order"].dataType).alias("order")
                             ).filter("_of IS NOT NULL AND order IS NOT NULL")
    placed = lines.join(orders, F.col("order_id") == F.col("_of")).select(
        "id", F.struct("arrived", "at", *_LINE, "order").cast(_PLACED).alias("placed"))
    added = inserted.filter(F.col("table").isin("order_detail_activity", "order_detail_coupon")).select(
        F.col("data")["order_detail_id"].alias("id"), F.lit(None).cast(_PLACED).alias("placed"),
        of("order_detail_activity", _ACTIVITY.values(), _TABLE_PARTS["activity"]).alias("activity"),
        of("order_detail_coupon", _COUPON.values(), _TABLE_PARTS["coupon"]).alias("coupon")).filter("id IS NOT NULL")
    return added.unionByName(placed, allowMissingColumns=True)


def _last_parts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(*[F.max(name).alias(name) for name in (*_TABLE_PARTS, upserts.BATCH)])


def parts_table(spark: SparkSession, path: str, buckets: int = merge_tables.BUCKETS) -> merge_tables.MergeTable:
    """A merge table of the parts of order lines: of each line the last part of each kind counts."""
    schema = T.StructType([T.StructField("id", T.StringType()), *[T.StructField(n, kind) for n, kind in _TABLE_PARTS.items()]])
    return merge_tables.MergeTable(spark, path, schema, ("id",), buckets=buckets, combine=lambda rows: rows, reduce=_last_parts,
                                   codec="zstd")


def order_detail_table(envelope: DataFrame, checkpoint: str, table: merge_tables.MergeTable, once: bool = False,
                       database: str | None = None) -> StreamingQuery:
    """Merge the parts of order lines into a table made by `parts_table`; no Python runs per line."""
    with queries.packed_state(envelope.sparkSession):
        return queries.each_batch(order_detail_parts(envelope, database), checkpoint, table.merge, once)


def current(table: merge_tables.MergeTable) -> DataFrame:
    """The order lines of a table made by `parts_table`, as `plans.dwd.order_detail` gives them."""
    where = {**{name: f"placed.{name}" for name in _LINE}, **{name: f"placed.order.{name}" for name in _ORDER}, "ts": "placed.at",
             **{name: f"activity.{name}" for name in _ACTIVITY}, **{name: f"coupon.{name}" for name in _COUPON}, "id": "id"}
    return table.read().filter("placed IS NOT NULL").select(*[F.col(where[name]).alias(name) for name in schemas.ORDER_DETAIL])
