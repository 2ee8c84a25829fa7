"""Throttle on a stream: one kept time per camera as state.

:func:`stream_throttle` gives a stream that can be processed further. As in the batch
operator only small summaries of a camera's time chunks meet in one task, so a camera that
sends a large share of all rows is spread over tasks; its kept time lies in the state store
until it can't matter any more. :func:`throttle_batches` runs the batch operator on every
micro-batch.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.throttle import (
    _NEVER,
    ALERT_SECONDS,
    IDLE_SECONDS,
    _run_ids,
    _selection,
    _starts,
    _summaries,
    throttle,
)
from tidewatch.session import materialize

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: No name begins with an underscore: the state API hands rows over as named tuples.
_SUMMARY = "camera string, chunk long, last timestamp, limits array<long>, exits array<long>"

#: Groups that the (camera, chunk) pairs of a micro-batch are dealt to, and the cameras for their state.
BUCKETS = 512


class KeptTimes(StatefulProcessor):
    """State: the last kept times of a bucket's cameras. Takes summaries of chunks, gives each chunk's incoming time."""

    def __init__(self, forget_after: int | None):
        self._forget_after = forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = handle.getMapState("kept", "camera string", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chunks, entries = pd.concat(rows).sort_values("chunk", kind="stable"), []
        cameras = [None if pd.isna(c) else c for c in chunks["camera"]]
        before: dict[str | None, int | None] = {}
        now: dict[str | None, int | None] = {}
        for camera, limits, exits in zip(cameras, chunks["limits"], chunks["exits"], strict=True):
            if camera not in now:
                before[camera] = now[camera] = self._held(camera)
            kept = now[camera]
            entries.append(kept)
            step = 0 if kept is None else bisect_left(limits, kept)
            if step < len(limits):
                now[camera] = int(exits[step])
        changed = {c: kept for c, kept in now.items() if kept != before[c]}
        for camera, kept in changed.items():
            self._kept.updateValue(self._name(camera), (kept,))
        if changed and self._forget_after is not None and not list(self._handle.listTimers()):
            self._handle.registerTimer(self._due(max(changed.values())))
        yield pd.DataFrame(
            {"_key": pd.Series(cameras, dtype=object), "_chunk": chunks["chunk"].to_numpy(), "_entry": pd.array(entries, dtype="Int64")}
        )

    @staticmethod
    def _name(camera: str | None) -> tuple[str]:
        """A camera as a key of the state, which takes no NULL."""
        return ("" if camera is None else f"={camera}",)

    def _held(self, camera: str | None) -> int | None:
        held = self._kept.getValue(self._name(camera))
        return None if held is None else held[0]

    def _due(self, kept: int) -> int:
        """Milliseconds of the watermark at which a kept time can't hold back any row that is still taken."""
        return -(-(kept + self._forget_after) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, later = expiredTimerInfo.getExpiryTimeInMs(), []
        for camera, due in [(camera, self._due(kept)) for camera, (kept,) in self._kept.iterator()]:
            if due <= now:
                self._kept.removeKey(camera)
            else:
                later.append(due)
        if later:  # a bucket has one timer at a time
            self._handle.registerTimer(max(later))
        yield pd.DataFrame({"_key": [], "_chunk": [], "_entry": []}).astype({"_key": str, "_chunk": "int64", "_entry": "Int64"})

    def close(self) -> None:
        pass


def stream_throttle(
    events: DataFrame,
    key: str = "camera_id",
    time: str = "event_time",
    flag: str = "is_violent",
    tie: str | None = None,
    alert_seconds: float = ALERT_SECONDS,
    idle_seconds: float = IDLE_SECONDS,
    chunk_seconds: float | None = None,
    lateness: str | None = "1 hour",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Kept rows of a stream, the same as :func:`tidewatch.operators.throttle.throttle`.

    In each micro-batch the chunks of all cameras are summarised, the summaries of a camera
    pass its state in time order, and the chunks select their rows. Chunks are dealt to
    ``buckets`` groups by a hash of camera and chunk, so a call of Python takes many of them;
    a group is what a task holds. Chunks default to 12 idle intervals. The state of a
    checkpoint is kept by bucket, so their number stays as it is while the stream lives.

    Rows are sorted inside a micro-batch; across batches a camera's rows have to arrive in
    time order, as they do when a camera is one broker partition. A row older than the kept
    time counts as too early. Chunks that lie wholly behind the newest row of the stream by
    more than ``lateness`` are left out, and a camera's state goes once all rows that are
    still taken are far enough from its kept time. Without ``lateness`` nothing is left out
    and state stays. Rows without a time are dropped, those without a camera are one camera.
    The state store has to be RocksDB's; it is set if the session has another.
    """
    short, long = round(alert_seconds * 1e6), round(idle_seconds * 1e6)
    if min(short, long) <= 0:
        raise ValueError("intervals must be positive")
    spark, names = events.sparkSession, events.columns
    if spark.conf.get(_PROVIDER, None) != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)
    chunk_length = round((chunk_seconds or 12 * idle_seconds) * 1e6)
    order = [(n, "ascending") for n in ("_key", "_chunk", "_order", *([tie] if tie else []))]
    summarised, selected = _summaries(short, long, chunk_length, True), _selection(short, long, names)
    at = F.unix_micros(time)
    placed = events.where(F.col(time).isNotNull()).withColumns(
        {
            "_key": F.col(key).cast("string"),
            "_chunk": F.floor(at / chunk_length),
            "_at": at,
            "_violent": F.coalesce(flag, F.lit(False)),
        }
    )
    group = F.pmod(F.xxhash64("_key", "_chunk"), F.lit(buckets)).alias("_group")

    def in_runs(rows: pa.Table) -> pa.Table:
        """Sorted into (camera, chunk) runs; the marker that holds a run's entry has no time and leads it."""
        first = pa.compute.fill_null(rows["_at"], _NEVER)
        return rows.append_column("_order", first).sort_by(order).drop_columns(["_order"]).combine_chunks()

    def summarise(rows: pa.Table) -> pa.Table:
        rows = in_runs(rows)
        out = pa.Table.from_batches(summarised(iter(rows.to_batches())))
        ends = np.append(_starts(rows)[1:], rows.num_rows) - 1
        last = rows["_at"].take(pa.array(ends)).cast(pa.timestamp("us", "UTC"))
        return out.add_column(2, "last", last).rename_columns(["camera", "chunk", "last", "limits", "exits"])

    def select(rows: pa.Table) -> pa.Table:
        rows = in_runs(rows)
        starts, run = _run_ids(rows)
        entered = rows["_at"].is_null().combine_chunks().to_numpy(zero_copy_only=False)[starts]
        rows = rows.filter(pa.array(entered[run])).combine_chunks()  # other chunks came too late
        return pa.Table.from_batches(selected(iter(rows.to_batches())), rows.select(names).schema)

    summaries = (
        placed.select("_key", "_chunk", "_at", "_violent", *([tie] if tie else []))
        .groupBy(group)
        .applyInArrow(summarise, _SUMMARY)
    )
    forget_after = None
    if lateness is not None:
        summaries = summaries.withWatermark("last", lateness)
        forget_after = max(short, long) + chunk_length
    summaries = summaries.withColumn("bucket", F.pmod(F.xxhash64("camera"), F.lit(buckets)))
    entries = summaries.groupBy("bucket").transformWithStateInPandas(
        KeptTimes(forget_after), "_key string, _chunk long, _entry long", "append", "none" if lateness is None else "eventTime"
    )
    marked = placed.withColumn("_entry", F.lit(None).cast("long")).unionByName(entries, allowMissingColumns=True)
    return marked.groupBy(group).applyInArrow(select, T.StructType(events.schema.fields))


def throttle_batches(
    sink: Callable[[DataFrame, int], None],
    state_path: str,
    key: str = "camera_id",
    time: str = "event_time",
    **options,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: throttle each micro-batch, then ``sink`` it.

    The kept times before batch ``n`` lie in one of three folders below
    ``state_path``, by ``n`` modulo three. A batch reads its own folder and
    writes the next, so a replayed batch starts from the same state; ``sink`` has
    to replace what it wrote for a replayed batch, as numbered commits do.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        layout = batch.select(key, time).schema
        before = (
            spark.read.schema(layout).parquet(f"{state_path}/{batch_id % 3}")
            if batch_id
            else spark.createDataFrame([], layout)
        )
        kept = materialize(
            throttle(batch, key=key, time=time, kept_before=before, **options),
            "kept",
            f"{state_path}/kept",
        )
        sink(kept, batch_id)
        after = before.unionByName(kept.select(key, time)).groupBy(key).agg(F.max(time).alias(time))
        after.write.mode("overwrite").parquet(f"{state_path}/{(batch_id + 1) % 3}")

    return write
