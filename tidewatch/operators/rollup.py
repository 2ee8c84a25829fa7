"""Tumbling rollup of alerts per camera."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import keys

# Fixed value: grain of the rollup beside the window.
GRAIN = ("camera_id", *keys.PLACE, "rtsp_url", "risk_level")


def violent_count() -> Column:
    """Violent rows; a NULL flag counts zero."""
    return F.count_if(F.col("is_violent"))


def riskiest() -> Column:
    """Greatest (score, evidence_url) of the group, both from one row.

    NULL ranks lowest and NaN highest, ties go to the greater URL. ``max_by``
    treats ties and NULLs differently and is no substitute.
    """
    return F.max(F.struct("score", "evidence_url"))


def least_place() -> Column:
    """The least (latitude, longitude) of the group, both from one row."""
    place = F.struct("latitude", "longitude")
    whole = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return F.coalesce(F.min(F.when(whole, place)), F.min(place))


def rollup_tumbling(alerts: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One row per window and grain; rows without event time are dropped.

    Coordinates are constant within a group in practice; the least pair makes the
    result repeatable where they are not, and is a place some row has. Pairs with a
    NULL count only where there are no others.
    """
    span = F.window("event_time", width)
    if alerts.isStreaming:
        # The whole window carries the watermark that closes it.
        placed, grain, start = alerts.withColumn("_window", span), [], F.col("_window")["start"]
    else:
        # The struct maximum makes Spark sort by the grain. A hash in front of it
        # decides nearly every comparison on one long; groups stay the same.
        placed, start = alerts.withColumn("_window", span["start"]), F.col("_window")
        grain = [F.xxhash64("_window", *GRAIN).alias("_order")]
    totals = placed.groupBy(*grain, "_window", *GRAIN).agg(
        least_place().alias("_place"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.avg("fps").alias("avg_fps"),
        violent_count().alias("alert_count"),
        riskiest().alias("_riskiest"),
    )
    return totals.select(
        start.alias("window_start"),
        (start + F.expr(f"INTERVAL {width}")).alias("window_end"),
        *GRAIN,
        "_place.latitude",
        "_place.longitude",
        "avg_latency_ms",
        "avg_fps",
        "alert_count",
        (F.col("alert_count") > 0).alias("is_violent_window"),
        F.col("_riskiest.score").alias("max_risk_score"),
        F.col("_riskiest.evidence_url").alias("evidence_url"),
    )


def rollup_states(alerts: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One row per window and grain that holds what :func:`merge_states` can add to others.

    Counts and sums stand for means, greatest and least pairs for themselves. ``rows``
    counts alerts; rows without event time are dropped.
    """
    place = F.struct("latitude", "longitude")
    whole = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    placed = alerts.withColumn("window_start", F.window("event_time", width)["start"])
    return placed.groupBy("window_start", *GRAIN).agg(
        F.count("*").alias("rows"),
        F.count("latency_ms").alias("latency_n"),
        F.sum("latency_ms").alias("latency_sum"),
        F.count("fps").alias("fps_n"),
        F.sum("fps").alias("fps_sum"),
        violent_count().alias("violent"),
        riskiest().alias("riskiest"),
        F.min(F.when(whole, place)).alias("whole_place"),
        F.min(place).alias("any_place"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of the same window and grain as one; states without rows are dropped."""
    add = ("rows", "latency_n", "latency_sum", "fps_n", "fps_sum", "violent")
    merged = states.groupBy("window_start", *GRAIN).agg(
        *[F.sum(c).alias(c) for c in add],
        F.max("riskiest").alias("riskiest"),
        F.min("whole_place").alias("whole_place"),
        F.min("any_place").alias("any_place"),
    )
    return merged.where("rows > 0")


def finish_states(states: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Merged states as :func:`rollup_tumbling` gives them."""
    place = F.coalesce("whole_place", "any_place")
    mean = lambda c: (F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0)))
    return states.select(
        "window_start",
        (F.col("window_start") + F.expr(f"INTERVAL {width}")).alias("window_end"),
        *GRAIN,
        place["latitude"].alias("latitude"),
        place["longitude"].alias("longitude"),
        mean("latency").alias("avg_latency_ms"),
        mean("fps").alias("avg_fps"),
        F.col("violent").alias("alert_count"),
        (F.col("violent") > 0).alias("is_violent_window"),
        F.col("riskiest.score").alias("max_risk_score"),
        F.col("riskiest.evidence_url").alias("evidence_url"),
    )
