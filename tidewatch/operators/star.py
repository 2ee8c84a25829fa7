"""Star schema over the rollup: keys, dimensions, fact, retrieval events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.functions import keys
from tidewatch.operators.rollup import GRAIN


def with_keys(rollup: DataFrame, full_grain_id: bool = False) -> DataFrame:
    """The rollup beside its surrogate keys.

    ``fact_id`` hashes camera and window, as readers expect. With
    ``full_grain_id`` it hashes the whole grain, which stays unique when a
    camera changes attributes inside a window.
    """
    id_parts = (*GRAIN, "window_start") if full_grain_id else ("camera_id", "window_start")
    return rollup.select(
        "*",
        keys.date_key("window_start").alias("date_key"),
        keys.time_key("window_start").alias("time_key"),
        keys.place_key().alias("location_key"),
        F.col("camera_id").alias("camera_key"),
        keys.row_key(*id_parts).alias("fact_id"),
    )


def fact_rows(keyed: DataFrame) -> DataFrame:
    """Fact columns of a keyed rollup."""
    return keyed.select(*schemas.columns(schemas.FACT))


def time_rows(keyed: DataFrame) -> DataFrame:
    """Distinct windows with their calendar parts."""
    return keyed.select(
        "time_key",
        "date_key",
        F.hour("window_start").alias("hour"),
        F.minute("window_start").alias("minute"),
    ).distinct()


def _one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The least row of each key, so that joins on the key cannot fan out."""
    attributes = [c for c in rows.columns if c != key]
    least = rows.groupBy(key).agg(F.min(F.struct(*attributes)).alias("least"))
    return least.select(key, "least.*")


def location_rows(keyed: DataFrame, every_variant: bool = False) -> DataFrame:
    """Places. ``every_variant`` keeps each distinct row, several per key if they differ."""
    rows = keyed.select(*schemas.columns(schemas.DIM_LOCATION))
    return rows.distinct() if every_variant else _one_per_key(rows, "location_key")


def camera_rows(keyed: DataFrame, every_variant: bool = False) -> DataFrame:
    """Cameras, with the same choice as :func:`location_rows`."""
    rows = keyed.select(*schemas.columns(schemas.DIM_CAMERA))
    return rows.distinct() if every_variant else _one_per_key(rows, "camera_key")


def new_rows(candidates: DataFrame, stored: DataFrame | None, key: str) -> DataFrame:
    """Candidates whose key is not stored yet; all of them on the first run.

    Stored rows are never updated.
    """
    if stored is None:
        return candidates
    return candidates.join(stored.select(key), key, "left_anti")


def violent_windows(fact: DataFrame) -> DataFrame:
    """Rows whose flag is true; NULL is left out."""
    return fact.where("is_violent_window")


def retrieval_events(keyed: DataFrame) -> DataFrame:
    """Violent windows under the names the retrieval index reads.

    ``label`` and ``date`` are added because the index filters and words by them.
    """
    return violent_windows(keyed).select(
        F.col("fact_id").alias("event_id"),
        F.col("window_start").alias("timestamp_utc"),
        "camera_id",
        *keys.PLACE,
        F.col("max_risk_score").alias("score"),
        F.lit("VIOLENCE").alias("label"),
        F.date_format("window_start", "yyyy-MM-dd").alias("date"),
    )
