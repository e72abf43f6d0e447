"""Per-key history in streams: custom state where the built-in stateful operators do not reach.

Rows of one key and micro-batch meet the state in event-time order; across batches arrival order counts. First-ever and
first-of-day hold one row per key and day of the micro-batch. The others hold a key's rows of one micro-batch, so
sources limit what a micro-batch reads (see `sources.messages`).

A stream may take over from a batch: with `past` the state each key has after those rows is computed in batch and loaded
once, when the query first starts, so results go on as if all rows had come through the stream.
"""

from __future__ import annotations

import datetime as dt
import json
import pickle
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import times

_DAY_MS = 86_400_000
_AT, _DAY, _GROUP, _PACKED = "_at", "_day", "_group", "_packed"
# Groups of keys, where the session names no number. Checkpoints depend on it: with another one a key would not find its state.
GROUPS = 1 << 18
GROUPS_CONF = "rillmart.history.groups"
# Types that go to Python as a text, and what makes a value of the text there.
_TEXTS = {T.StringType: None, T.ByteType: int, T.ShortType: int, T.IntegerType: int, T.LongType: int, T.DecimalType: Decimal}


class _Out(dict):
    """An output row in the form that PySpark makes of a `Row`."""

    def asDict(self, recursive: bool = False) -> dict:
        return self


class _Ordered(StatefulProcessor):
    """Walks the rows of each key in order, with the state loaded once and stored once per micro-batch.

    Keys are dealt to `GROUPS` groups, and Spark is asked per group: a call, its messages and its batch of output rows cost far
    more than a row does. The state of a group maps its keys to theirs, a micro-batch rewrites the groups it touches. So
    micro-batches of many rows do better with fewer groups (`queries.key_groups`).

    `step(row, last)` gets a row as a tuple and gives the output values (None for no output) and the new state. `place` holds
    the positions of the columns.
    """

    def __init__(self, keys: list[str], order: list[str], out: list[str], ts: str, keep: dt.timedelta | None = None):
        self.keys, self.order, self.out, self.keep = keys, order, out, keep
        # The time goes back as microseconds, which Arrow takes for a timestamp.
        self.taken = [_AT if name == ts else name for name in out]
        self.place: dict[str, int] | None = None
        # Names and types of the columns in the text of a row, where `_packed` has put them there.
        self.packed: dict[str, type | None] = {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "packed binary")

    def _load(self) -> dict[tuple, tuple]:
        found = self.state.get()
        return {} if found is None else dict(pickle.loads(found[0]))

    def _store(self, known: dict[tuple, tuple]) -> None:
        """In order of the keys, so that a repeated run leaves the same state."""
        if not known:
            self.state.clear()
            return
        self.state.update((pickle.dumps(sorted(known.items(), key=lambda item: _sortable(item[0])), protocol=4),))
        if self.keep is not None:
            self.handle.registerTimer(min(map(self._expiry, known.values())))

    def _bind(self, names: list[str]) -> None:
        self.place = {name: names.index(name) for name in dict.fromkeys([*names])}
        self.at, self.day = self.place[_AT], self.place.get(_DAY)
        self.key_at = [self.place[name] for name in self.keys]
        self.order_at = [self.place[name] for name in self.order]
        self.out_at = [self.place.get(name) for name in self.taken]

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        known, changed = self._load(), False
        of_key: dict[tuple, list[tuple]] = {}
        for row in self.needed(self._plain(rows)):
            of_key.setdefault(self.key(row), []).append(row)
        for own, found in of_key.items():
            before = last = known.get(own)
            if len(found) > 1:
                found.sort(key=self.moment)
            for row in found:
                values, last = self.step(row, last)
                if values is not None:
                    yield _Out(zip(self.out, values))
            if last is not None and last != before:
                known[own], changed = last, True
        if changed:
            self._store(known)

    def _plain(self, rows: Iterable[Row]) -> Iterator[tuple]:
        if not self.packed:
            for row in rows:
                if self.place is None:
                    self._bind(list(row.__fields__))
                yield tuple(row)
            return
        typed = [(i, kind) for i, kind in enumerate(self.packed.values()) if kind is not None]
        for row in rows:
            if self.place is None:
                names = list(row.__fields__)
                self.text_at = names.index(_PACKED)
                self._bind([*self.packed, *names])
            texts = json.loads(row[self.text_at])
            for i, kind in typed:
                if texts[i] is not None:
                    texts[i] = kind(texts[i])
            yield (*texts, *row)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        # One row per group, with all its keys and their states.
        self._store({tuple(_fields(one["key"])): tuple(_fields(one["last"])) for one in initialState["known"]})

    def key(self, row: tuple) -> tuple:
        return tuple([row[i] for i in self.key_at])

    def moment(self, row: tuple) -> list:
        return [(row[i] is not None, row[i]) for i in self.order_at]

    def values(self, row: tuple) -> list:
        return [row[i] for i in self.out_at]

    def needed(self, rows: Iterable[tuple]) -> Iterable[tuple]:
        """The rows that can change the outcome."""
        return rows

    def _firsts(self, rows: Iterable[tuple], group: Callable[[tuple], object]) -> Iterable[tuple]:
        found: dict[object, tuple] = {}
        for row in rows:
            known = found.setdefault(group(row), row)
            if known is not row and self.moment(row) < self.moment(known):
                found[group(row)] = row
        return found.values()

    def _expiry(self, last: tuple) -> int:
        """When a key whose last day is known may go, in milliseconds."""
        return last[0] * _DAY_MS + int(self.keep.total_seconds() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # A timer of an earlier value finds newer ones and leaves them; the next of the group is set with what stays.
        due, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        known = self._load()
        if known:
            self._store({own: last for own, last in known.items() if not (self._expiry(last) <= due or self._expiry(last) < now)})
        return iter(())

    def step(self, row: tuple, last: tuple | None) -> tuple[list | None, tuple | None]:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _sortable(values: tuple) -> list:
    return [(value is not None, value) for value in values]


def _fields(struct: Row | dict) -> Iterable:
    """The values of a struct, which workers get as a row or as a dictionary."""
    return struct.values() if isinstance(struct, dict) else struct


class RepairIsNew(_Ordered):
    """State: the day a visitor counts as known from."""

    def __init__(self, keys: list[str], order: list[str], out: list[str], ts: str, flag: str):
        super().__init__(keys, order, out, ts)
        self.flag = flag

    def step(self, row, last):
        flag, day = row[self.place[self.flag]], row[self.day]
        if flag == "1" and last is None:
            last = (day,)
        elif flag == "1" and day != last[0]:
            flag = "0"
        elif flag == "0":
            last = (day - 1,)
        values = self.values(row)
        values[self.out.index(self.flag)] = flag
        return values, last


class DayChanges(_Ordered):
    """Rows on another day than the key's previous row, with that day last. State: the last day."""

    def needed(self, rows):
        # In time order days never go back, so only the first row of each day meets a change.
        return self._firsts(rows, lambda row: (self.key(row), row[self.day]))

    def step(self, row, last):
        previous = last[0] if last else None
        if row[self.day] == previous:
            return None, last
        return [*[row[i] for i in self.out_at[:-1]], previous], (row[self.day],)


class FirstEver(_Ordered):
    """The first row of a key. State: its time."""

    def needed(self, rows):
        return self._firsts(rows, self.key)

    def _expiry(self, last):
        return last[0] // 1000 + int(self.keep.total_seconds() * 1000)

    def step(self, row, last):
        if last is not None:
            return None, last
        return self.values(row), (row[self.at],)


class Delta(_Ordered):
    """Measures replaced by their change. State: the time and measures of the last version."""

    def __init__(self, keys: list[str], order: list[str], out: list[str], ts: str, measures: list[str],
                 keep: dt.timedelta | None):
        super().__init__(keys, order, out, ts, keep)
        self.measures = measures

    def _expiry(self, last):
        return last[0] // 1000 + int(self.keep.total_seconds() * 1000)

    def step(self, row, last):
        after = tuple([row[self.place[name]] for name in self.measures])
        known = last is not None and (self.keep is None or (row[self.at] - last[0]) / 1e6 <= self.keep.total_seconds())
        values = self.values(row)
        if known:
            for name, before, now in zip(self.measures, last[1:], after):
                values[self.out.index(name)] = now - before
        return values, (row[self.at], *after)


def _dated(df: DataFrame, ts: str, zone: str | None) -> DataFrame:
    # Order and day are fixed here, so that no clock or zone of a Python worker takes part. A day is its number.
    return df.withColumn(_AT, F.unix_micros(ts)).withColumn(_DAY, F.unix_date(times.day(F.col(ts), zone)))


def _group(df: DataFrame, keys: list[str]) -> Column:
    groups = int(df.sparkSession.conf.get(GROUPS_CONF, str(GROUPS)))
    return F.pmod(F.xxhash64(*keys), F.lit(groups).cast("bigint")).alias(_GROUP)


def _packed(dated: DataFrame, keys: list[str], ts: str, processor: _Ordered) -> DataFrame:
    """The columns in few cells, for processors that need no day. PySpark takes each cell of a row by itself, a timestamp with its
    zone, and that costs more than the work on the row.

    Texts and numbers go as one text. The time goes as its number, under the mark by which Spark tells late rows.
    """
    kinds = {field.name: _TEXTS[type(field.dataType)] for field in dated.schema.fields
             if type(field.dataType) in _TEXTS and field.name not in (_AT, _DAY)}
    processor.packed = kinds
    others = [name for name in dated.columns if name not in kinds and name not in (ts, _AT, _DAY)]
    text = F.to_json(F.array(*[F.col(name).cast("string") for name in kinds]))
    at = F.col(_AT).alias(_AT, metadata=dated.schema[ts].metadata)
    return dated.select(_group(dated, keys), at, text.alias(_PACKED), *others)


def _run(df: DataFrame, keys: list[str], ts: str, zone: str | None, processor: _Ordered, schema: T.StructType,
         past: DataFrame | None = None, packed: bool = False) -> DataFrame:
    """`past` holds the state at the start: one row per key with the columns of the state. `packed` is for rows of short values."""
    start = None
    if past is not None:
        own, last = F.struct(*keys).alias("key"), F.struct(*[n for n in past.columns if n not in keys]).alias("last")
        start = past.groupBy(_group(df, keys)).agg(F.collect_list(F.struct(own, last)).alias("known")).groupBy(_GROUP)
    dated = _dated(df, ts, zone)
    rows = _packed(dated, keys, ts, processor) if packed else dated.select(_group(df, keys), "*")
    return rows.groupBy(_GROUP).transformWithState(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
        initialState=start,
        eventTimeColumnName=ts,
    )


def _moment(order: tuple[str, ...]) -> Column:
    return F.struct(_AT, *order)


def repair_is_new(
    df: DataFrame, keys: list[str], ts: str, flag: str, order: tuple[str, ...] = (), zone: str | None = None,
    past: DataFrame | None = None,
) -> DataFrame:
    """`operators.state.repair_is_new` for a watermarked stream. Rows of `past`, a batch, came before it."""
    if past is not None:
        old, new = F.col(flag) == "0", F.col(flag) == "1"
        known = _dated(past, ts, zone).groupBy(*keys).agg(
            F.max_by(F.col(_DAY) - 1, F.when(old, _moment(order))).alias("_old"),
            F.min_by(F.col(_DAY), F.when(new, _moment(order))).alias("_new"))
        past = known.select(*keys, F.coalesce("_old", "_new").alias("day")).filter("day IS NOT NULL")
    return _run(df, keys, ts, zone, RepairIsNew(keys, [_AT, *order], df.columns, ts, flag), df.schema, past)


def day_changes(
    df: DataFrame, keys: list[str], ts: str, order: tuple[str, ...] = (), zone: str | None = None,
    keep_days: int | None = None, past: DataFrame | None = None,
) -> DataFrame:
    """First-of-day rows of a watermarked stream with `prev_day`; remembers only the last day, in arrival order.

    With `keep_days` a key is forgotten that many days after the end of its last day. Rows of `past`, a batch, came
    before the stream, in order of time.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("prev_day", T.DateType())])
    keep = None if keep_days is None else dt.timedelta(days=keep_days + 1)
    if past is not None:
        past = _dated(past, ts, zone).groupBy(*keys).agg(F.max(_DAY).alias("day"))
    return _run(df, keys, ts, zone, DayChanges(keys, [_AT, *order], schema.names, ts, keep), schema, past)


def first_of_day(
    df: DataFrame, keys: list[str], ts: str, order: tuple[str, ...] = (), zone: str | None = None,
    past: DataFrame | None = None,
) -> DataFrame:
    """`operators.state.first_of_day` for a watermarked stream; a key is forgotten one day after its last day."""
    return day_changes(df, keys, ts, order, zone, keep_days=1, past=past).drop("prev_day")


def first_ever(
    df: DataFrame, keys: list[str], ts: str, order: tuple[str, ...] = (), forget: bool = False,
    past: DataFrame | None = None,
) -> DataFrame:
    """`operators.state.first_ever` for a watermarked stream. Rows of `past`, a batch, came before it."""
    keep = dt.timedelta() if forget else None
    if past is not None:
        past = _dated(past, ts, None).groupBy(*keys).agg(F.min(_AT).alias("at"))
    return _run(df, keys, ts, None, FirstEver(keys, [_AT, *order], df.columns, ts, keep), df.schema, past)


def delta(
    df: DataFrame, keys: list[str], ts: str, order: list[str], measures: list[str], ttl: str | None = None,
    past: DataFrame | None = None,
) -> DataFrame:
    """`operators.state.delta` for a watermarked stream, ordered by `ts` and `order`. Measures must not be null.

    With `ttl` a key is forgotten once the watermark is that far past its last version. Rows of `past`, a batch, came
    before the stream.
    """
    keep = None if ttl is None else dt.timedelta(seconds=times.seconds(ttl))
    if past is not None:
        last = F.max_by(F.struct(F.col(_AT).alias("at"), *measures), _moment(tuple(order)))
        past = _dated(past, ts, None).groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
    return _run(df, keys, ts, None, Delta(keys, [_AT, *order], df.columns, ts, measures, keep), df.schema, past, packed=True)
