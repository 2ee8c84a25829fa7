"""Pipeline metrics out of a query's own progress reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidewatch import schemas

# Metric names the pipeline dashboard reads.
RECORDS = "bronze_records_total"
DURATION = "bronze_batch_duration_seconds"
THROUGHPUT = "processed_rows_per_second"
DELAY = "end_to_end_delay_seconds"

# Name under which a query counts its records; see :func:`records_of`.
OBSERVED = "bronze"


def records_of(progress: dict) -> int:
    """Records of a batch: those the query observed, else the source's own count.

    The source counts what was read, and a batch that is read twice counts twice.
    """
    observed = (progress.get("observedMetrics") or {}).get(OBSERVED)
    if observed is None:
        return progress.get("numInputRows") or 0
    return observed["records"]


def _newest(progress: dict) -> float | None:
    """Seconds since 1970 of the newest event of a batch, if it is known."""
    observed = (progress.get("observedMetrics") or {}).get(OBSERVED)
    if observed is not None and "newest" in observed and observed["newest"] is not None:
        return observed["newest"] / 1_000_000
    newest = (progress.get("eventTime") or {}).get("max")
    return dt.datetime.fromisoformat(newest.replace("Z", "+00:00")).timestamp() if newest else None


def _finish(progress: dict) -> dt.datetime:
    begun = dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    return begun + dt.timedelta(milliseconds=progress["durationMs"].get("triggerExecution", 0))


def samples_of(reports: Iterable[dict], instance: str = "driver") -> list[tuple]:
    """Samples of the non-empty batches among a query's progress reports.

    The record counter runs over the reports given, which must begin with the query's
    first batch: a query keeps only its last reports, and a counter over those would be
    too small. :class:`ProgressLog` sees every batch. Delay is the time from the newest
    event, observed or of the watermark, to the batch's end.
    """
    reports = list(reports)
    if reports and reports[0].get("batchId", 0) > 0:
        raise ValueError("reports of earlier batches are missing; use ProgressLog")
    return _samples(reports, instance)


def _samples(reports: Iterable[dict], instance: str) -> list[tuple]:
    samples, total = [], 0
    for progress in reports:
        rows = records_of(progress)
        if not rows:
            continue
        total += rows
        done = _finish(progress)
        at = done.replace(tzinfo=None)
        values = {
            RECORDS: float(total),
            DURATION: progress["durationMs"].get("triggerExecution", 0) / 1000,
            THROUGHPUT: float(progress.get("processedRowsPerSecond") or 0.0),
        }
        event = _newest(progress)
        if event is not None:
            values[DELAY] = done.timestamp() - event
        samples += [(name, instance, None, at, value) for name, value in values.items()]
    return samples


def progress_samples(
    spark: SparkSession, reports: Iterable[dict], instance: str = "driver"
) -> DataFrame:
    """:func:`samples_of` as a frame the metric operators take.

    ``query.recentProgress`` is a bounded list, so it is small.
    """
    return spark.createDataFrame(samples_of(reports, instance), schemas.SAMPLE)


class ProgressLog(StreamingQueryListener):
    """Writes each batch's samples as parquet below ``path`` while queries run."""

    def __init__(self, spark: SparkSession, path: str, instance: str = "driver") -> None:
        self.spark, self.path, self.instance = spark, path, instance
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        import json

        progress = json.loads(event.progress.json)
        rows = _samples([progress], self.instance)
        if not rows:
            return
        key = str(event.progress.id)
        self.totals[key] = self.totals.get(key, 0) + records_of(progress)
        rows = [(n, i, m, at, float(self.totals[key]) if n == RECORDS else v) for n, i, m, at, v in rows]
        frame = self.spark.createDataFrame(rows, schemas.SAMPLE)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
