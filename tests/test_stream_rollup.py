"""Streams with late rows against the batch rollup."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators.rollup import rollup_tumbling
from tidewatch.plans import increments
from tidewatch.streaming import rollup

T0 = dt.datetime(2025, 3, 1)
HOURS = 60


def alerts(late_hours, seed=4):
    """(arrival hour, row): a third of the rows come up to ``late_hours`` late, one camera has most."""
    rng, out = random.Random(seed), []
    for n in range(400):
        seconds = rng.randint(0, HOURS * 3600)
        at = T0 + dt.timedelta(seconds=seconds) if n % 40 else None
        late = rng.uniform(0, late_hours) if n % 3 == 0 else 0
        row = (f"cam{0 if n % 3 else n % 7}", "c", "d", f"w{n % 2}" if n % 9 else None, "s", 1.0, 2.0, "r", "high", at,
               at.date() if at else None, "", rng.choice([True, False, None]), rng.random(), 25.0, float(n), f"u{n}", None)
        out.append((seconds / 3600 + late, row))
    return [row for _, row in sorted(out, key=lambda pair: pair[0])]


@pytest.fixture(params=[5, 50], ids=["hours", "days"])
def source(request, spark, tmp_path):
    rows, path = alerts(request.param), str(tmp_path / "in")
    for n in range(0, len(rows), 100):
        spark.createDataFrame(rows[n : n + 100], schemas.BRONZE).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schemas.BRONZE).option("maxFilesPerTrigger", 1).parquet(path)
    return stream, spark.read.schema(schemas.BRONZE).parquet(path), request.param


def listed(windows):
    rounded = windows.withColumns({c: F.round(c, 6) for c in ("avg_latency_ms", "avg_fps")})
    return sorted(repr(r) for r in rounded.select(*sorted(rounded.columns)).collect())


def test_updates_replace_windows(spark, tmp_path, source):
    stream, rows, late = source
    path = str(tmp_path / "windows")
    run = rollup.start_updates(stream, path, str(tmp_path / "cp"), "1 hour", f"{late + 1} hours", {"availableNow": True})
    run.awaitTermination()
    want = listed(rollup_tumbling(rows, "1 hour"))
    assert listed(rollup.current_windows(spark, path)) == want
    stored = spark.read.schema(rollup.WINDOWS).parquet(path)
    assert stored.count() > len(want) and stored.select("batch").distinct().count() >= 4  # some were written twice
    last = stored.agg(F.max("batch")).first()[0]
    settled = rollup.settle(spark, path, last + 1, "2025-03-02")
    assert settled and all(d <= "2025-03-02" for d in settled)
    assert listed(rollup.current_windows(spark, path)) == want
    left = spark.read.schema(rollup.WINDOWS).parquet(path).where("date <= '2025-03-02'")
    assert left.groupBy("date").agg(F.count_distinct("batch").alias("n")).where("n > 1").count() == 0
    assert rollup.settle(spark, path, last + 1, "2025-03-02") == []


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "windows")
    rows = spark.createDataFrame(alerts(0), schemas.BRONZE)
    windows = rollup_tumbling(rows, "1 hour")
    rollup.write_updates(windows, path, 7)
    rollup.write_updates(windows, path, 7)
    assert spark.read.schema(rollup.WINDOWS).parquet(path).count() == windows.count()
    assert rollup.settle(spark, path, 7, "2026-01-01") == []  # the newest batch may come again


def test_states_take_rows_of_any_age(spark, tmp_path, source):
    stream, rows, _ = source
    path = str(tmp_path / "states")
    run = (
        stream.writeStream.foreachBatch(rollup.states_writer(path, "1 hour"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    assert listed(increments.current_rollup(spark, path, "1 hour")) == listed(rollup_tumbling(rows, "1 hour"))
