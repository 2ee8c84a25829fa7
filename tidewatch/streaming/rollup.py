"""Rollup on a stream.

Three ways to treat late rows: :func:`stream_rollup` gives each window once, when it can no
longer change; :func:`start_updates` gives windows as soon as they have rows and again
whenever late rows change them; :func:`states_writer` takes rows of any age.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.dedupe import latest_per_key
from tidewatch.operators.rollup import GRAIN, rollup_tumbling
from tidewatch.plans import increments
from tidewatch.session import materialize, release, remove

#: A window as stored by :func:`start_updates`.
WINDOWS = (
    "window_start timestamp, window_end timestamp, " + ", ".join(f"{c} string" for c in GRAIN) + ", latitude double, "
    "longitude double, avg_latency_ms double, avg_fps double, alert_count long, is_violent_window boolean, "
    "max_risk_score double, evidence_url string, date string, batch long"
)


def stream_rollup(
    alerts: DataFrame, width: str = "5 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """Windows of a stream in append mode, each once the watermark has passed its end."""
    return rollup_tumbling(alerts.withWatermark("event_time", lateness), width)


def _write(windows: DataFrame, path: str) -> None:
    writer = windows.hint("rebalance", "date").write.partitionBy("date", "batch").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_updates(windows: DataFrame, path: str, batch: int) -> None:
    """Store the windows that a micro-batch changed, with their present values.

    They lie below their UTC date under the number of the batch, so a batch that comes again
    replaces itself, and a later batch stands for the windows it has.
    """
    date = F.date_format("window_start", "yyyy-MM-dd")
    _write(windows.withColumns({"date": date, "batch": F.lit(batch).cast("long")}), path)


def start_updates(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "5 minutes",
    lateness: str = "1 hour",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Run the rollup in update mode; rows up to ``lateness`` late change windows already written.

    Spark keeps the state of a window until the watermark has passed its end.
    """
    windows = stream_rollup(alerts, width, lateness)
    writer = windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda rows, batch: write_updates(rows, path, batch)).trigger(**(trigger or {"processingTime": "1 minute"})).start()


def _newest(stored: DataFrame) -> DataFrame:
    return latest_per_key(stored, ["window_start", *GRAIN], [F.col("batch").desc()])


def current_windows(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The newest values of the windows that start in the UTC dates ``first`` to ``last``."""
    stored = spark.read.schema(WINDOWS).parquet(path)
    if first is not None:
        stored = stored.where(F.col("date") >= first)
    if last is not None:
        stored = stored.where(F.col("date") <= last)
    return _newest(stored).drop("date", "batch")


def settle(spark: SparkSession, path: str, before: int, last: str) -> list[str]:
    """Drop superseded values of the dates up to ``last``; returns the dates that were rewritten.

    A date with rows of batch ``before`` or a later one is left alone, since the newest batch
    may come again. The newest values are staged in the shared folder first and stay there
    if replacing them breaks off.
    """
    stored = spark.read.schema(WINDOWS).parquet(path).where(F.col("date") <= last)
    parts = stored.select("date", "batch").distinct().collect()  # a row per date and batch
    batches: dict[str, list[int]] = {}
    for part in parts:
        batches.setdefault(part.date, []).append(part.batch)
    settled = {d: sorted(b) for d, b in batches.items() if len(b) > 1 and max(b) < before}
    if not settled:
        return []
    chosen = _newest(stored.where(F.col("date").isin(*settled)))
    numbers = stored.groupBy("date").agg(F.max("batch").alias("batch"))
    merged = chosen.drop("batch").join(F.broadcast(numbers), "date")
    staged = materialize(merged.select(*stored.columns), "settled-windows")
    _write(staged, path)
    for date, old in settled.items():
        for batch in old[:-1]:
            remove(spark, f"{path}/date={date}/batch={batch}")
    release(staged)
    return sorted(settled)


def states_writer(path: str, width: str = "5 minutes") -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: adds the mergeable states of each micro-batch, without a watermark.

    Rows of any age count, Spark keeps no state, and
    :func:`tidewatch.plans.increments.current_rollup` reads the windows.
    """
    return lambda rows, batch: increments.add_rows(rows, path, batch, width)
