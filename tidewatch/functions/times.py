"""Reference times, intervals and time text."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros_of(width: str) -> int:
    """Microseconds in a fixed-length interval such as ``"5 minutes"``."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", width.lower())
    if not found or found.group(2) not in _UNIT_MICROS:
        raise ValueError(f"not a fixed-length interval: {width!r}")
    return int(found.group(1)) * _UNIT_MICROS[found.group(2)]


def moment(as_of: str | dt.datetime | Column | None) -> Column:
    """``as_of`` as a timestamp column; the current time when it is ``None``."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def before(as_of: str | dt.datetime | Column | None, width: str) -> Column:
    """The moment ``width`` before ``as_of``."""
    return moment(as_of) - F.expr(f"INTERVAL {width}")


def lenient_timestamp(text: Column | str) -> Column:
    """Timestamp of ISO text; unreadable text gives NULL."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def lenient_date(text: Column | str) -> Column:
    """The date written in the text, before any zone shift; unreadable gives NULL."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("date")


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text with six fraction digits, none when the fraction is zero."""
    column = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.unix_micros(column) % 1_000_000 == 0, whole).otherwise(
        F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
