"""Questions the alert dashboards ask of the fact table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import keys
from tidewatch.functions.times import before, moment
from tidewatch.operators.ingest import prune_dates
from tidewatch.operators.positions import with_positions
from tidewatch.operators.star import violent_windows

When = str | dt.datetime | Column | None


def since(fact: DataFrame, as_of: When, width: str) -> DataFrame:
    """Windows that start at or after ``as_of - width``; there is no upper end.

    The ``date_key`` bound repeats the condition on the column the stored fact is
    partitioned by, so that older partitions are not listed or read.
    """
    lower = before(as_of, width)
    kept = fact.where(F.col("window_start") >= lower)
    return kept.where(F.col("date_key") >= keys.date_key(lower)) if "date_key" in fact.columns else kept


def last_24h(fact: DataFrame, as_of: When = None) -> DataFrame:
    return since(fact, as_of, "24 HOURS")


def last_7d(fact: DataFrame, as_of: When = None) -> DataFrame:
    return since(fact, as_of, "7 DAYS")


def in_range(fact: DataFrame, start: When, end: When = None) -> DataFrame:
    """Windows that start between ``start`` and ``end``, both included."""
    low, high = moment(start), moment(end)
    kept = fact.where(F.col("window_start").between(low, high))
    if "date_key" not in fact.columns:
        return kept
    return kept.where(F.col("date_key").between(keys.date_key(low), keys.date_key(high)))


def for_cameras(fact: DataFrame, cameras: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen cameras; ``None`` means all."""
    return fact if cameras is None else fact.where(F.col("camera_key").isin(*cameras))


def violent_count_since(fact: DataFrame, as_of: When, width: str) -> DataFrame:
    """Number of violent windows since ``as_of - width``."""
    return violent_windows(since(fact, as_of, width)).agg(F.count("*").alias("value"))


def average_latency(fact: DataFrame, as_of: When = None, width: str = "7 DAYS") -> DataFrame:
    """Mean of the window means, each window counting once."""
    return since(fact, as_of, width).agg(F.avg("avg_latency_ms").alias("value"))


def risk_trend(fact: DataFrame, start: When, end: When = None) -> DataFrame:
    """Risk in percent per violent window, in time order."""
    return (
        violent_windows(in_range(fact, start, end))
        .select(
            F.col("window_start").alias("time"),
            "fact_id",
            (F.col("max_risk_score") * 100).alias("risk"),
        )
        .orderBy("time", "fact_id")
    )


def join_location(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Fact rows with their place. Spark broadcasts the dimension when it is small
    and splits hot keys of a sort-merge join otherwise."""
    return fact.join(locations, "location_key")


def hotspots(fact: DataFrame, locations: DataFrame, start: When, end: When = None) -> DataFrame:
    """Per coordinate: first violent window and number of violent windows.

    Counts per place come first, so the join sees one row per place however many
    windows a hot place has.
    """
    per_place = (
        violent_windows(in_range(fact, start, end))
        .groupBy("location_key")
        .agg(F.min("window_start").alias("first"), F.count("*").alias("n"))
    )
    return (
        join_location(per_place, locations)
        .groupBy("latitude", "longitude")
        .agg(F.min("first").alias("time"), F.sum("n").alias("value"))
        .select("time", "latitude", "longitude", "value")
    )


def rank_wards(fact: DataFrame, locations: DataFrame, as_of: When = None) -> DataFrame:
    """Violent windows per ward over seven days, most first; no ward is cut off."""
    per_place = (
        violent_windows(last_7d(fact, as_of))
        .groupBy("location_key")
        .agg(F.count("*").alias("n"))
    )
    return (
        join_location(per_place, locations)
        .groupBy("ward")
        .agg(F.sum("n").alias("total_events"))
        .orderBy(F.desc("total_events"), "ward")
    )


def distinct_cameras(cameras: DataFrame) -> DataFrame:
    """Camera ids in order, for the dashboard's selector."""
    return cameras.select("camera_id").distinct().orderBy("camera_id")


def daily_trend(fact: DataFrame, as_of: When = None) -> DataFrame:
    """Violent windows per day over seven days."""
    return (
        violent_windows(last_7d(fact, as_of))
        .groupBy("date_key")
        .agg(F.count("*").alias("violent_windows"))
        .orderBy("date_key")
    )


def incidents_of_day(fact: DataFrame, locations: DataFrame, day: str) -> DataFrame:
    """How many violent windows on one day, when and where.

    One row per window with its ward's total and the day's total. Totals are
    aggregated apart and joined back, so no ward is gathered into one task.
    """
    start = F.lit(day).cast("date").cast("timestamp")
    end = start + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND")
    hits = join_location(
        violent_windows(in_range(fact, start, end)).select(
            "location_key", "fact_id", "camera_key", "window_start"
        ),
        locations.select("location_key", "ward", "street"),
    )
    per_ward = hits.groupBy("ward").agg(F.count("*").alias("ward_total"))
    day_total = Window.partitionBy(F.lit(1))
    totals = per_ward.withColumn("day_total", F.sum("ward_total").over(day_total))
    same_ward = F.col("ward").eqNullSafe(F.col("_ward"))
    return (
        hits.join(totals.withColumnRenamed("ward", "_ward"), same_ward)
        .select("ward", "ward_total", "day_total", "window_start", "street", "camera_key", "fact_id")
        .orderBy("ward", "window_start", "fact_id")
    )


def order_rank(rows: DataFrame, major: str, minor: str, name: str = "position") -> DataFrame:
    """Position of each row under (major, minor), from 1; nulls come first.

    Rows are sorted by ranges, so neither a window over all rows nor one over a hot major is
    needed. Rows that agree in both are numbered in any order.
    """
    placed = with_positions(rows, [F.asc_nulls_first(major), F.asc_nulls_first(minor)], name)
    return placed.withColumn(name, F.col(name) + 1)


def newest_alerts(
    bronze: DataFrame, first: str | None = None, last: str | None = None, most: int = 100
) -> DataFrame:
    """The ``most`` newest raw alerts of a range of dates: time, camera, risk, evidence.

    Each task hands on no more than ``most`` rows. Equal times are in the order of the
    camera and of the other columns; rows without a time come last.
    """
    shown = prune_dates(bronze, first, last).select("event_time", "camera_id", "score", "evidence_url")
    return shown.orderBy(F.desc_nulls_last("event_time"), "camera_id", "score", "evidence_url").limit(most)
