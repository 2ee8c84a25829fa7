import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.throttle import throttle

T0 = dt.datetime(2025, 1, 1)
LAYOUT = "camera_id string, event_time timestamp, is_violent boolean, n int"


def frame(spark, rows):
    full = [
        (c, None if t is None else T0 + dt.timedelta(microseconds=round(t * 1e6)), v, i)
        for i, (c, t, v) in enumerate(rows)
    ]
    return spark.createDataFrame(full, LAYOUT)


def greedy(rows, short=0.5, long=5.0):
    last, kept = {}, set()
    for n, (camera, t, violent) in sorted(
        ((i, r) for i, r in enumerate(rows) if r[1] is not None), key=lambda x: (x[1][1], x[0])
    ):
        if camera not in last or round((t - last[camera]) * 1e6) >= (short if violent else long) * 1e6:
            last[camera] = t
            kept.add(n)
    return kept


def kept(df):
    rows = [r.n for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("a", 0, False), ("a", 4.999999, False), ("a", 5, False)], {0, 2}),
        ([("a", 0, True), ("a", 0.499999, True), ("a", 0.5, True)], {0, 2}),
        ([("a", 0, True), ("a", 0.5, False), ("a", 5, False)], {0, 2}),
        ([("a", 0, False), ("a", 0.5, True), ("a", 5, False), ("a", 5.5, False)], {0, 1, 3}),
        ([("a", 0, False), ("b", 0.1, False), ("a", 1, False), ("b", 6, None)], {0, 1, 3}),
        ([("a", 0, False), ("a", 0, True), ("a", None, True)], {0}),
    ],
)
def test_gaps(spark, rows, want):
    assert greedy(rows) == want
    assert kept(throttle(frame(spark, rows), tie="n")) == want


@pytest.mark.parametrize("chunk", [1, 5, 7.3, 120, 100000])
def test_any_chunking_gives_the_sequential_result(spark, chunk):
    """A hot camera with dense and empty stretches beside cold ones and a NULL one."""
    rng = random.Random(int(chunk))
    rows = []
    for camera, count in (("hot", 1500), ("cold", 60), (None, 40), ("once", 1)):
        clock = 0.0
        for _ in range(count):
            clock += rng.choice([0, 0.05, 0.3, 0.5, 0.7, 2, 5, 40 if rng.random() < 0.1 else 0.1])
            rows.append((camera, round(clock, 3), rng.random() < 0.3))
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = throttle(frame(spark, rows), tie="n", chunk_seconds=chunk)
        assert kept(got) == greedy(rows)
        again = throttle(got, tie="n", chunk_seconds=chunk)
        assert kept(again) == kept(got)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_columns_pass_through(spark):
    rows = frame(spark, [("a", 0, False)])
    out = throttle(rows, tie="n")
    assert out.schema == rows.schema and out.collect() == rows.collect()


def test_intervals_must_be_positive(spark):
    with pytest.raises(ValueError):
        throttle(frame(spark, [("a", 0, False)]), alert_seconds=0)


def test_clocks_far_apart(spark):
    """One wrong clock among many cameras drops nothing."""
    rows = [(f"c{n}", dt.datetime(2025, 1, 1, 10, 0, n % 60), False, n) for n in range(20_000)]
    rows += [("c1", dt.datetime(1, 1, 1), False, -1), ("c2", dt.datetime(1970, 1, 1), True, -2), ("c3", dt.datetime(2099, 1, 1), False, -3)]
    frame = spark.createDataFrame(rows, "camera_id string, event_time timestamp_ntz, is_violent boolean, n long")
    frame = frame.withColumn("event_time", F.col("event_time").cast("timestamp"))
    kept = {r.n for r in throttle(frame, chunk_seconds=1e6).select("n").collect()}
    assert kept == {n for *_, n in rows}
