"""The incremental rollup against a full one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators.ingest import soft_delete
from tidewatch.operators.rollup import rollup_tumbling
from tidewatch.plans import increments
from tidewatch.plans.gold import GoldTables, build_gold

T0 = dt.datetime(2025, 3, 1)


def bronze_rows(count=600, seed=1):
    rng = random.Random(seed)
    out = []
    for n in range(count):
        at = T0 + dt.timedelta(seconds=rng.randint(0, 3 * 86400)) if n % 50 else None
        camera = f"cam{0 if n % 3 else n % 7}"  # one camera has two thirds
        score = rng.choice([None, float("nan"), 0.1, 0.5, rng.random()])
        place = rng.choice([(1.0, 2.0), (None, 2.0), (0.5, None), (0.5, 3.0)])
        out.append(
            (camera, "c", "d", f"w{n % 2}" if n % 9 else None, "s", *place, "r", "high", at, at.date() if at else None, "",
             rng.choice([True, False, None]), score, rng.choice([None, 25.0]), rng.choice([None, 1.0, float(n)]),
             rng.choice([None, f"u{n}"]), None)
        )
    return out


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    spark.createDataFrame(bronze_rows(), schemas.BRONZE).write.partitionBy("event_date").mode("overwrite").parquet(path)
    return spark.read.schema(schemas.BRONZE).parquet(path)


def listed(rollup):
    rounded = rollup.withColumns({c: F.round(c, 6) for c in ("avg_latency_ms", "avg_fps")})
    return sorted(repr(r) for r in rounded.select(*sorted(rounded.columns)).collect())


def test_late_rows_withdrawals_and_compaction(spark, tmp_path, bronze):
    path = str(tmp_path / "states")
    late = F.xxhash64("event_time") % 5 == 0
    late = F.coalesce(late, F.lit(False))
    increments.add_rows(bronze.where(~late), path, 0)
    increments.add_rows(bronze.where(late), path, 1)
    increments.add_rows(bronze.where(late), path, 1)  # runs again
    assert listed(increments.current_rollup(spark, path)) == listed(rollup_tumbling(bronze))

    gone = bronze.where("event_time IS NOT NULL AND is_violent").select("camera_id", "event_time")
    first = gone.where(F.col("event_time") < T0 + dt.timedelta(hours=30))
    increments.withdraw(bronze, first, path, 2)
    assert listed(increments.current_rollup(spark, path)) == listed(rollup_tumbling(soft_delete(bronze, first)))
    increments.withdraw(bronze, gone, path, 3, fresh=gone.exceptAll(first))
    want = listed(rollup_tumbling(soft_delete(bronze, gone)))
    assert listed(increments.current_rollup(spark, path)) == want

    increments.compact(spark, path, 4, "2025-03-02")
    assert listed(increments.current_rollup(spark, path)) == want
    parts = spark.read.schema(increments.STATES).parquet(path).select("date", "batch").distinct().collect()
    assert {r.batch for r in parts if r.date <= "2025-03-02"} == {4} and {r.batch for r in parts if r.date > "2025-03-02"} > {0}
    increments.compact(spark, path, 4, "2025-03-02")  # runs again
    assert listed(increments.current_rollup(spark, path)) == want


def test_emptied_window_goes(spark, tmp_path, bronze):
    path = str(tmp_path / "states")
    increments.add_rows(bronze, path, 0)
    hour = bronze.where(F.col("event_time") < T0 + dt.timedelta(hours=1))
    increments.withdraw(bronze, hour.select("camera_id", "event_time"), path, 1)
    left = increments.current_rollup(spark, path)
    assert hour.count() and left.where(F.col("window_start") < T0 + dt.timedelta(hours=1)).count() == 0


def test_a_late_hour_reads_its_hour(spark, bronze):
    hour = spark.createDataFrame([(T0 + dt.timedelta(hours=26, minutes=m),) for m in (0, 55)], "window_start timestamp")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        found = increments.bronze_of_windows(bronze, hour)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [" in plan and "(event_date#" in plan
    assert "GreaterThanOrEqual(event_time,2025-03-02 02:00:00" in plan and "LessThan(event_time,2025-03-02 03:00:00" in plan
    assert found.where("hour(event_time) <> 2 OR day(event_time) <> 2").count() == 0


def test_no_rows(spark, tmp_path, bronze):
    path = str(tmp_path / "states")
    increments.add_rows(bronze.limit(0), path, 0)
    increments.withdraw(bronze, bronze.limit(0).select("camera_id", "event_time"), path, 1)
    assert increments.current_rollup(spark, path).count() == 0


def test_gold_from_states(spark, tmp_path, bronze, name):
    path = str(tmp_path / "states")
    increments.add_rows(bronze, path, 0)
    names = [GoldTables(*[f"{name}_{way}_{t}" for t in "tlcfr"], path=str(tmp_path / way)) for way in ("whole", "states")]
    build_gold(spark, bronze, names[0])
    build_gold(spark, bronze, names[1], windows=increments.current_rollup(spark, path))
    one, other = (
        sorted(repr(r) for r in spark.table(n.fact).select("fact_id", "alert_count", F.round("avg_fps", 6), "evidence_url").collect())
        for n in names
    )
    assert one and one == other
