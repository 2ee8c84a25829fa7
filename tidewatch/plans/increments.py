"""The rollup kept up to date by mergeable states, so that late rows and withdrawals touch only their windows.

States lie as parquet below one folder, partitioned by the UTC date of their window and the
number of the batch that wrote them. New rows add states of their own; bronze is not read.
Greatest and least values can't be taken back, so windows with withdrawn rows are computed
anew from bronze, from those windows' spans alone, and replace what earlier batches have of
them. Each batch writes partitions of its own number, so a batch that is written again
replaces itself and one that failed half-way is repaired by its repetition. Batches are
numbered upwards and run one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.ingest import soft_delete
from tidewatch.operators.rollup import GRAIN, finish_states, merge_states, rollup_states
from tidewatch.session import materialize, release, remove

STATES = (
    "window_start timestamp, " + ", ".join(f"{c} string" for c in GRAIN) + ", rows long, latency_n long, latency_sum double, "
    "fps_n long, fps_sum double, violent long, riskiest struct<score:double,evidence_url:string>, "
    "whole_place struct<latitude:double,longitude:double>, any_place struct<latitude:double,longitude:double>, "
    "replaces boolean, date string, batch long"
)


def _write(states: DataFrame, path: str, batch: int, replaces: bool) -> None:
    date = F.date_format("window_start", "yyyy-MM-dd")
    marked = states.withColumns({"replaces": F.lit(replaces), "date": date, "batch": F.lit(batch).cast("long")})
    writer = marked.hint("rebalance", "date").write.partitionBy("date", "batch").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def add_rows(rows: DataFrame, path: str, batch: int, width: str = "5 minutes") -> None:
    """Add the states of new bronze rows, however late they are."""
    _write(rollup_states(rows, width), path, batch, False)


def bronze_of_windows(bronze: DataFrame, windows: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Bronze rows whose window is one of ``windows`` (window_start).

    For each day the span of its windows reaches the scan, and its date with one to spare on
    either side, since ``event_date`` is the date written in the message. The driver gets a
    row per day.
    """
    day = F.to_date("window_start").alias("day")
    reach = F.expr(f"INTERVAL {width}")
    spans = windows.groupBy(day).agg(F.min("window_start").alias("low"), (F.max("window_start") + reach).alias("high"))
    near = F.lit(False)
    for span in spans.collect():
        inside = (F.col("event_time") >= F.lit(span.low)) & (F.col("event_time") < F.lit(span.high))
        near = near | (F.col("event_date").between(F.date_sub(F.lit(span.day), 1), F.date_add(F.lit(span.day), 1)) & inside)
    start = F.window("event_time", width)["start"]
    return bronze.where(near).withColumn("window_start", start).join(windows, "window_start", "left_semi").drop("window_start")


def withdraw(
    bronze: DataFrame, retractions: DataFrame, path: str, batch: int, width: str = "5 minutes", fresh: DataFrame | None = None
) -> None:
    """Take back alerts: the windows of ``fresh`` ones are computed anew without any of ``retractions``.

    Both hold (camera_id, event_time). ``fresh`` are those that came since the last call and
    are all where it is not given. ``bronze`` has every row that was added, withdrawn ones too.
    """
    starts = (retractions if fresh is None else fresh).select(F.window("event_time", width)["start"].alias("window_start"))
    windows = materialize(starts.where("window_start IS NOT NULL").distinct(), "withdrawn-windows")
    states = rollup_states(soft_delete(bronze_of_windows(bronze, windows, width), retractions), width)
    emptied = windows.withColumn("rows", F.lit(0).cast("long"))  # marks windows that may have no rows left
    _write(states.unionByName(emptied, allowMissingColumns=True), path, batch, True)
    release(windows)


def current_states(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Merged states of the windows that start in the UTC dates ``first`` to ``last``."""
    stored = spark.read.schema(STATES).parquet(path)
    if first is not None:
        stored = stored.where(F.col("date") >= first)
    if last is not None:
        stored = stored.where(F.col("date") <= last)
    since = stored.where("replaces").groupBy("window_start").agg(F.max("batch").alias("since"))
    valid = stored.join(since, "window_start", "left").where("since IS NULL OR batch >= since")
    return merge_states(valid)


def current_rollup(
    spark: SparkSession, path: str, width: str = "5 minutes", first: str | None = None, last: str | None = None
) -> DataFrame:
    """What :func:`tidewatch.operators.rollup.rollup_tumbling` gives for all rows that are not withdrawn."""
    return finish_states(current_states(spark, path, first, last), width)


def compact(spark: SparkSession, path: str, batch: int, last: str) -> None:
    """Merge the states of settled dates up to ``last`` into one batch and delete what they replace.

    Readers see the same windows at every step: the merged states replace the others before
    those go, oldest first.
    """
    merged = materialize(current_states(spark, path, last=last), "compacted-states")
    _write(merged, path, batch, True)
    release(merged)
    stored = spark.read.schema(STATES).parquet(path).where((F.col("date") <= last) & (F.col("batch") < batch))
    for part in stored.select("batch", "date").distinct().orderBy("batch", "date").collect():  # a row per date and batch
        remove(spark, f"{path}/date={part.date}/batch={part.batch}")
