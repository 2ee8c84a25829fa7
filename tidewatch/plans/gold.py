"""Bronze to star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import star
from tidewatch.operators.ingest import soft_delete
from tidewatch.operators.rollup import rollup_tumbling
from tidewatch.session import materialize, remove, shared_dir
from tidewatch.sources import tables


@dataclass(frozen=True)
class GoldTables:
    """Names of the five tables; ``path`` puts their files below one folder."""

    time: str = "dim_time"
    location: str = "dim_location"
    camera: str = "dim_camera"
    fact: str = "fact_camera_monitoring"
    retrieval: str = "violence_events_for_rag"
    path: str | None = None

    def where(self, name: str) -> str | None:
        return f"{self.path}/{name}" if self.path else None


def bronze_of_dates(
    bronze: DataFrame, first: str | None, last: str | None, width: str = "0 minutes"
) -> DataFrame:
    """Rows of the windows of ``width`` that start in the UTC dates ``first`` to ``last``.

    The last window may reach into the day after ``last`` and beyond.
    ``event_date`` is the date written in the message and may be a day off the
    UTC date, so partitions are pruned with a day to spare on both sides.
    """
    reach = F.expr(f"INTERVAL {width}")
    kept = bronze
    if first is not None:
        day = F.lit(first).cast("date")
        kept = kept.where(
            (F.col("event_date") >= F.date_sub(day, 1))
            & (F.col("event_time") >= day.cast("timestamp"))
        )
    if last is not None:
        end = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp") + reach
        kept = kept.where(
            (F.col("event_date") <= F.date_add(end.cast("date"), 1)) & (F.col("event_time") < end)
        )
    return kept


def windows_of_dates(rollup: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Windows that start in the UTC dates ``first`` to ``last``."""
    kept = rollup
    if first is not None:
        kept = kept.where(F.col("window_start") >= F.lit(first).cast("date").cast("timestamp"))
    if last is not None:
        end = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp")
        kept = kept.where(F.col("window_start") < end)
    return kept


def build_gold(
    spark: SparkSession,
    bronze: DataFrame,
    names: GoldTables = GoldTables(),
    width: str = "5 minutes",
    first: str | None = None,
    last: str | None = None,
    append: bool = False,
    every_variant: bool = False,
    full_grain_id: bool = False,
    work_path: str | None = None,
    retractions: DataFrame | None = None,
    windows: DataFrame | None = None,
) -> bool:
    """Update the star schema from bronze; whether there was anything to do.

    Windows that start in the dates ``first`` to ``last`` are computed, without the
    alerts that ``retractions`` (camera_id, event_time) withdraw; ``windows`` gives them
    instead, as :func:`tidewatch.plans.increments.current_rollup` does. The rollup is written
    once, to ``work_path`` or a shared folder that is removed at the end, and the five
    tables read their columns from it. Fact and retrieval rows replace all dates of that range, also those
    that have no rows any more, so a rerun changes nothing, late rows are taken in and
    withdrawn ones go; without a bound the range is open. ``append`` adds rows blindly
    instead. Dimensions gain the keys they lack.
    """
    if windows is None:
        rows = bronze_of_dates(bronze, first, last, width)
        if retractions is not None:
            rows = soft_delete(rows, retractions)
        windows = rollup_tumbling(rows, width)
    windows = windows_of_dates(windows, first, last)
    work = work_path or shared_dir(spark, "rollup")
    keyed = materialize(star.with_keys(windows, full_grain_id), "rollup", work)
    bounds = [text.replace("-", "") if text else None for text in (first, last)]
    targets = [
        (name, part, layout, tables.partition_values(spark, name, part))
        for name, part, layout in (
            (names.fact, "date_key", schemas.FACT),
            (names.retrieval, "date", schemas.RETRIEVAL_EVENT),
        )
    ]
    if keyed.isEmpty() and (append or not any(values for *_, values in targets)):
        if work_path is None:
            remove(spark, work)
        return False
    dimensions = (
        (names.time, schemas.DIM_TIME, star.time_rows(keyed), "time_key"),
        (names.location, schemas.DIM_LOCATION, star.location_rows(keyed, every_variant), "location_key"),
        (names.camera, schemas.DIM_CAMERA, star.camera_rows(keyed, every_variant), "camera_key"),
    )
    for name, layout, candidates, key in dimensions:
        stored = spark.table(name) if spark.catalog.tableExists(name) else None
        fresh = star.new_rows(candidates, stored, key)
        tables.create_or_append(fresh, name, layout, path=names.where(name))

    outputs = (star.fact_rows(keyed), star.retrieval_events(keyed))
    for (name, part, layout, values), output in zip(targets, outputs, strict=True):
        # Rebalancing sizes the files of a date and splits a date that is too large.
        tables.create_table(spark, name, layout, [part], path=names.where(name))
        sized = output.hint("rebalance", part)
        if append:
            tables.append_by_name(sized, name)
            continue
        tables.overwrite_partitions(sized, name)
        present = {str(row[part]) for row in output.select(part).distinct().collect()}  # one per day
        low, high = bounds
        for value in values - present:
            day = value.replace("-", "")
            if (low is None or day >= low) and (high is None or day <= high):
                tables.clear_partition(spark, name, part, value)
    if work_path is None:
        remove(spark, work)
    return True
