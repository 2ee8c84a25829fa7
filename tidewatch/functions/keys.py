"""Surrogate keys of the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: attributes that make up a place, in hashing order.
PLACE = ("city", "district", "ward", "street")


def date_key(ts: Column | str) -> Column:
    """``yyyyMMdd`` as int, by arithmetic instead of a per-row formatter."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)


def time_key(ts: Column | str) -> Column:
    """``yyyyMMddHHmm`` as long."""
    return date_key(ts).cast("long") * 10000 + F.hour(ts) * 100 + F.minute(ts)


def place_key() -> Column:
    """Hash of the place attributes; NULL attributes are skipped by ``concat_ws``."""
    return F.sha2(F.concat_ws("|", *PLACE), 256)


def row_key(*parts: Column | str) -> Column:
    """Hash of the parts joined by a dash; timestamps read ``yyyy-MM-dd HH:mm:ss``."""
    return F.sha2(F.concat_ws("-", *[F.col(p) if isinstance(p, str) else p for p in parts]), 256)
