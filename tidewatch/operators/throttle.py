"""Per-camera throttle: keep an alert when enough time passed since the last kept one.

The needed gap depends on the current row: short for a violent one, long
otherwise. What is kept depends on what was kept before, so no window frame
expresses it, and handing one camera to one task would put a hot camera's rows
into that task. Time is therefore cut into chunks:

1. every (camera, chunk) is summarised apart as a step function from the last
   kept time before the chunk to the last kept time after it;
2. per camera the step functions are chained in time order, which gives each
   chunk its incoming time; a chunk is one row here, whatever its size;
3. every (camera, chunk) selects its rows, knowing the incoming time.

Steps 1 and 3 run over all chunks of all cameras in parallel.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds between kept alerts, violent and other.
ALERT_SECONDS = 0.5
IDLE_SECONDS = 5.0

_NEVER = int(np.iinfo(np.int64).min // 2)


def next_kept(
    at: np.ndarray, violent: np.ndarray, run: np.ndarray, short: int, long: int
) -> np.ndarray:
    """For each row the row kept after it, or ``len(at)`` when there is none.

    Rows are sorted by (run, time). The row after ``i`` is the first of its run
    that is violent and ``short`` later, or ``long`` later. Times are replaced by
    their ranks, so that run and time fit one number whatever range the clocks span.
    """
    size = len(at)
    times = np.unique(at)
    place = run * (len(times) + 1) + np.searchsorted(times, at)

    def earliest(gap: int) -> np.ndarray:
        return run * (len(times) + 1) + np.searchsorted(times, at + gap)

    bounds = np.append(run, -1)
    any_row = np.searchsorted(place, earliest(long))
    violent_rows = np.append(np.flatnonzero(violent), size)
    violent_row = violent_rows[np.searchsorted(place[violent], earliest(short))]
    any_row[bounds[any_row] != run] = size
    violent_row[bounds[violent_row] != run] = size
    return np.minimum(any_row, violent_row)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Integers that differ where neighbouring values differ; NULL is a value."""
    encoded = column.combine_chunks().dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _starts(table: pa.Table) -> np.ndarray:
    """First row of every (key, chunk) run."""
    key, chunk = _codes(table["_key"]), table["_chunk"].to_numpy()
    new = np.flatnonzero((key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])) + 1
    return np.append(0, new)


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that no (key, chunk) run is split."""
    held: list[pa.Table] = []

    def mark(table: pa.Table, row: int) -> tuple:
        return table["_key"][row].as_py(), table["_chunk"][row].as_py()

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = int(_starts(table)[-1])
        if held and mark(held[-1], held[-1].num_rows - 1) != mark(table, 0):
            yield pa.concat_tables(held)
            held = []
        if last:
            yield pa.concat_tables([*held, table.slice(0, last)])
            held = []
        held.append(table.slice(last))
    if held:
        yield pa.concat_tables(held)


def _run_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    starts = _starts(table)
    run = np.zeros(table.num_rows, dtype=np.int64)
    run[starts[1:]] = 1
    return starts, np.cumsum(run)


def _summaries(short: int, long: int, chunk_length: int, resumed: bool):
    """Step 1: ``limits`` and ``exits`` per chunk.

    A chunk entered with last kept time ``s`` is left with ``exits[j]`` for the
    first ``j`` with ``s <= limits[j]``, and with ``s`` when there is none. ``s``
    lies before the chunk, which bounds the limits to be listed; only a run that
    was ``resumed`` may enter a chunk in its middle.
    """

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches):
            starts, run = _run_ids(table)
            at = table["_at"].to_numpy()
            violent = table["_violent"].to_numpy().astype(bool)
            size = len(at)
            follow = next_kept(at, violent, run, short, long)
            last = np.where(follow < size, follow, np.arange(size))
            while True:
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            # A row is the first kept one for s <= limit unless an earlier row took s.
            limit = at - np.where(violent, short, long)
            chunk_start = table["_chunk"].to_numpy() * chunk_length
            stride = 2 * (chunk_length + max(short, long))
            ranked = run * stride + (limit - chunk_start)
            taken = np.append(ranked[:1] - 1, np.maximum.accumulate(ranked)[:-1])
            first_of_run = np.zeros(size, dtype=bool)
            first_of_run[starts] = True
            wanted = ranked > taken
            if not resumed:
                wanted &= taken - run * stride < -1
            head = np.flatnonzero(first_of_run | wanted)
            exits = at[last[head]]
            keep = np.append((exits[1:] != exits[:-1]) | (run[head][1:] != run[head][:-1]), True)
            head, exits = head[keep], exits[keep]
            offsets = np.append(np.searchsorted(run[head], np.arange(len(starts))), len(head))
            offsets = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    table["_key"].combine_chunks().take(pa.array(starts)),
                    table["_chunk"].combine_chunks().take(pa.array(starts)),
                    pa.ListArray.from_arrays(offsets, pa.array(limit[head])),
                    pa.ListArray.from_arrays(offsets, pa.array(exits)),
                ],
                names=["_key", "_chunk", "limits", "exits"],
            )

    return run_all


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the incoming last kept time of every chunk, in time order per camera."""
    camera, kept = object(), _NEVER
    for batch in batches:
        steps = batch.column("limits")
        ends = steps.offsets.to_pylist()
        limits = steps.values.to_pylist()
        exits = batch.column("exits").values.to_pylist()
        entries = []
        for row, key in enumerate(batch.column("_key").to_pylist()):
            if key != camera:
                camera, kept = key, _NEVER
            entries.append(kept)
            step = bisect_left(limits, kept, ends[row], ends[row + 1])
            if step < ends[row + 1]:
                kept = exits[step]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("_chunk"), pa.array(entries, pa.int64())],
            names=["_key", "_chunk", "_entry"],
        )


def _selection(short: int, long: int, names: list[str]):
    """Step 3: the kept rows. Each run starts with the marker that holds its entry.

    With the entry known a run needs no more than the last kept time to go on in
    the next batch, so a batch is all that is held.
    """

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = _NEVER
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            starts, run = _run_ids(table)
            marker = table["_at"].is_null().combine_chunks().to_numpy(zero_copy_only=False)
            entry = table["_entry"].combine_chunks().take(pa.array(starts))
            entry = entry.fill_null(_NEVER).to_numpy(zero_copy_only=False).copy()
            if not marker[0]:
                entry[0] = carried
            rows = table.filter(pa.array(~marker))
            run = run[~marker]
            at = rows["_at"].to_numpy()
            violent = rows["_violent"].to_numpy().astype(bool)
            follow = next_kept(at, violent, run, short, long)
            eligible = np.flatnonzero(at - np.where(violent, short, long) >= entry[run])
            _, where = np.unique(run[eligible], return_index=True)
            kept = np.zeros(rows.num_rows, dtype=bool)
            path = eligible[where]
            while len(path):
                kept[path] = True
                path = follow[path]
                path = path[path < len(at)]
            last = at[kept & (run == len(starts) - 1)]
            carried = last[-1] if len(last) else entry[-1]
            yield from rows.filter(pa.array(kept)).select(names).to_batches()

    return run_all


def throttle(
    events: DataFrame,
    key: str = "camera_id",
    time: str = "event_time",
    flag: str = "is_violent",
    tie: str | None = None,
    alert_seconds: float = ALERT_SECONDS,
    idle_seconds: float = IDLE_SECONDS,
    chunk_seconds: float | None = None,
    kept_before: DataFrame | None = None,
) -> DataFrame:
    """Kept rows of ``events``; rows without a time are dropped.

    Rows of one camera at one instant are taken in the order of ``tie``. Chunks
    default to 12 idle intervals; of one chunk, a task holds the times and flags.
    ``kept_before`` continues an earlier run: per camera the ``time`` of the last
    row that was kept.
    """
    short, long = round(alert_seconds * 1e6), round(idle_seconds * 1e6)
    if min(short, long) <= 0:
        raise ValueError("intervals must be positive")
    chunk_length = round((chunk_seconds or 12 * idle_seconds) * 1e6)
    at = F.unix_micros(time)
    placed = events.where(F.col(time).isNotNull()).withColumns(
        {
            "_key": F.col(key).cast("string"),
            "_chunk": F.floor(at / chunk_length),
            "_at": at,
            "_violent": F.coalesce(flag, F.lit(False)),
        }
    )
    tie_break = [tie] if tie else []

    summaries = (
        placed.select("_key", "_chunk", "_at", "_violent", *tie_break)
        .repartition("_key", "_chunk")
        .sortWithinPartitions("_key", "_chunk", "_at", *tie_break)
        .select("_key", "_chunk", "_at", "_violent")
        .mapInArrow(
            _summaries(short, long, chunk_length, kept_before is not None),
            "_key string, _chunk long, limits array<long>, exits array<long>",
        )
    )
    if kept_before is not None:
        # An earlier kept time is a first chunk that is always left with it.
        summaries = summaries.unionByName(
            kept_before.select(
                F.col(key).cast("string").alias("_key"),
                F.lit(_NEVER).alias("_chunk"),
                F.array(F.lit(-_NEVER)).alias("limits"),
                F.array(F.unix_micros(time)).alias("exits"),
            )
        )
    entries = (
        summaries.repartition("_key")
        .sortWithinPartitions("_key", "_chunk")
        .mapInArrow(_chain, "_key string, _chunk long, _entry long")
        .where(F.col("_chunk") > _NEVER)
    )
    marked = placed.withColumn("_entry", F.lit(None).cast("long")).unionByName(
        entries, allowMissingColumns=True
    )
    names = events.columns
    return (
        marked.repartition("_key", "_chunk")
        .sortWithinPartitions("_key", "_chunk", F.col("_at").asc_nulls_first(), *tie_break)
        .mapInArrow(_selection(short, long, names), T.StructType(events.schema.fields))
    )
