"""Epoch, date and date-time conversions with one explicit time zone.

`zone=None` means the session zone; both formatting and parsing honour the same argument.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
PARTITION = "yyyyMMdd"
_UNITS = {"millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600, "day": 86400}


def at_zone(ts: Column, zone: str | None) -> Column:
    """The wall clock of `ts` in `zone`."""
    return ts if zone is None else F.convert_timezone(None, F.lit(zone), ts)


def text(ts: Column, pattern: str = DATE_TIME, zone: str | None = None) -> Column:
    return F.date_format(at_zone(ts, zone), pattern)


def day(ts: Column, zone: str | None = None) -> Column:
    return F.to_date(at_zone(ts, zone))


def parse(value: Column, pattern: str = DATE_TIME, zone: str | None = None) -> Column:
    """Text to an instant; a text that does not fit gives null."""
    if zone is None:
        return F.try_to_timestamp(value, F.lit(pattern))
    return F.try_to_timestamp(F.concat(value, F.lit(f" {zone}")), F.lit(f"{pattern} VV"))


def date_time_to_ms(value: Column, zone: str | None = None) -> Column:
    return F.unix_millis(parse(value, DATE_TIME, zone))


def date_to_ms(value: Column, zone: str | None = None) -> Column:
    return date_time_to_ms(F.concat(value, F.lit(" 00:00:00")), zone)


def ms_to_date(ms: Column, zone: str | None = None) -> Column:
    return text(F.timestamp_millis(ms), DATE, zone)


def ms_to_date_time(ms: Column, zone: str | None = None) -> Column:
    return text(F.timestamp_millis(ms), DATE_TIME, zone)


def ms_to_partition(ms: Column, zone: str | None = None) -> Column:
    return text(F.timestamp_millis(ms), PARTITION, zone)


def from_epoch(value: Column, unit: str) -> Column:
    """Epoch number to timestamp; `unit` is 's' or 'ms'."""
    return {"s": F.timestamp_seconds, "ms": F.timestamp_millis}[unit](value)


def as_of_day(as_of: str | Column | None = None, pattern: str = DATE) -> Column:
    """The report day: the given one, or today."""
    if as_of is None:
        return F.date_format(F.current_date(), pattern)
    return F.lit(as_of) if isinstance(as_of, str) else as_of


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days from one instant to a later one."""
    return F.floor((F.unix_millis(later) - F.unix_millis(earlier)) / F.lit(86_400_000)).cast("bigint")


def seconds(interval: str) -> float:
    """Length of an interval text such as '15 seconds' or '-1 hour'."""
    amount, unit = re.fullmatch(r"\s*(-?\d+)\s+(\w+?)s?\s*", interval).groups()
    return int(amount) * _UNITS[unit]
