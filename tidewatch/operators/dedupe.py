"""Last-wins selection and set difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import without


def latest_per_key(
    rows: DataFrame, key: str | Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """One row per key, the first under ``newest_first``.

    The ``row_number() = 1`` filter is planned with a group limit before the
    shuffle, so each task forwards at most one row per key and a hot key costs
    no more than a cold one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        rows.withColumn("_place", F.row_number().over(order))
        .where("_place = 1")
        .drop("_place")
    )


def union_upsert(
    stored: DataFrame | None,
    incoming: DataFrame,
    key: str = "id",
    version: str = "version",
) -> DataFrame:
    """Stored rows with ``incoming`` laid over them by key.

    Incoming rows replace stored ones; of several incoming rows of a key the
    highest version counts. Stored rows, one per key, are only filtered, and not
    shuffled while the incoming keys turn out small enough to be broadcast.
    """
    fresh = latest_per_key(incoming, key, [F.col(version).desc()])
    if stored is None:
        return fresh
    kept = without(stored, incoming, [key])
    return kept.unionByName(fresh, allowMissingColumns=True)


def id_difference(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Candidates whose key, read as text, is not known; repeated candidates stay.

    A NULL key is never known, so it stays too.
    """
    named = candidates.withColumn("_id", F.col(key).cast("string"))
    seen = known.select(F.col(key).cast("string").alias("_id"))
    return without(named, seen, ["_id"]).select(*candidates.columns)


def known_ids(documents: DataFrame, key: str = "event_id") -> DataFrame:
    """Distinct non-empty ids that are already indexed."""
    return documents.select(key).where(F.col(key) != "").distinct()
