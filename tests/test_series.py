import datetime as dt
import random

import pytest

from tidewatch import schemas
from tidewatch.functions import bands, times
from tidewatch.operators import series

T0 = dt.datetime(2025, 1, 1)


def samples(spark, rows):
    full = [(s, "i", "idle", T0 + dt.timedelta(microseconds=round(t * 1e6)), float(v)) for s, t, v in rows]
    return spark.createDataFrame(full, schemas.SAMPLE)


def seconds(row):
    return (row.ts - T0).total_seconds()


def test_mean_over_a_left_open_range(spark):
    rows = [("a", 0, 1), ("a", 60, 3), ("a", 119.999999, 8), ("a", 120, 4)]
    got = {seconds(r): r["mean"] for r in series.avg_over_time(samples(spark, rows), width="1 minute").collect()}
    assert got == {0: 1, 60: 3, 119.999999: 5.5, 120: 6}


def test_rate_with_reset_and_single_sample(spark):
    rows = [("a", 0, 10), ("a", 30, 40), ("a", 60, 5), ("a", 600, 65), ("b", 0, 7)]
    got = {
        (r.series, seconds(r)): r.rate
        for r in series.counter_rate(samples(spark, rows)).collect()
    }
    assert got[("a", 0)] is None and got[("b", 0)] is None
    assert got[("a", 30)] == pytest.approx(30 / 60)
    assert got[("a", 60)] == pytest.approx(35 / 60)
    assert got[("a", 600)] == pytest.approx(60 / 60)


def test_against_brute_force(spark):
    """Dense and sparse stretches, a hot series, several widths."""
    rng = random.Random(3)
    rows = []
    for name, count in (("hot", 400), ("cold", 40), ("one", 1)):
        clock = 0.0
        for _ in range(count):
            clock += rng.choice([0.25, 1, 7, 50, 400])
            rows.append((name, clock, rng.randint(0, 50)))
    for width in (10, 60, 3600):
        frame = samples(spark, rows)
        got = series.trailing(frame, ["series"], "value", f"{width} seconds").collect()
        assert len(got) == len(rows)
        for r in got:
            here = [v for s, t, v in rows if s == r.series and seconds(r) - width < t <= seconds(r)]
            assert r.trail_count == len(here) and r.trail_sum == pytest.approx(sum(here))


def extrapolated(samples, width):
    """The rate at the last sample of each prefix, written out."""
    out = {}
    for n, (end, _) in enumerate(samples):
        frame = [(t, v) for t, v in samples[: n + 1] if t > end - width]
        if len(frame) < 2:
            out[end] = None
            continue
        rise = sum(b - a if b >= a else b for (_, a), (_, b) in zip(frame, frame[1:]))
        span = end - frame[0][0]
        gap = span / (len(frame) - 1)
        start = width - span
        start = gap / 2 if start >= 1.1 * gap else start
        if rise > 0 and frame[0][1] >= 0:
            start = min(start, span * frame[0][1] / rise)
        out[end] = rise * (span + start) / span / width
    return out


def test_extrapolated_rate(spark):
    rng = random.Random(8)
    clock, points = 0.0, []
    for _ in range(200):
        clock += rng.choice([5, 15, 15, 15, 40, 90])
        points.append((clock, rng.randint(0, 30)))
    frame = samples(spark, [("a", t, v) for t, v in points])
    got = {
        seconds(r): r.rate
        for r in series.counter_rate(frame, extrapolate=True).collect()
    }
    want = extrapolated(points, 60)
    assert {t: v is None for t, v in got.items()} == {t: v is None for t, v in want.items()}
    assert all(v is None or v == pytest.approx(want[t]) for t, v in got.items())


def test_busy_by_instance(spark):
    rows = [("c1", 0, 0), ("c1", 300, 270), ("c2", 0, 0), ("c2", 300, 210)]
    (got,) = series.busy_by_instance(samples(spark, rows)).collect()
    assert got.busy_percent == pytest.approx(100 - 80)
    assert got.at_time == T0 + dt.timedelta(seconds=300)


def test_gauges(spark):
    frame = samples(spark, [("a", 0, 1), ("a", 5, 3), ("b", 2, 7)])
    assert {r.series: r.value for r in series.gauge_latest(frame).collect()} == {"a": 3, "b": 7}
    assert series.gauge_avg(frame).first().value == 5


@pytest.mark.parametrize(
    "value, want", [(-1.0, "green"), (0.0, "green"), (9.9, "green"), (10.0, "orange"), (30.0, "red"), (None, None)]
)
def test_bands(spark, value, want):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(bands.threshold_band("v", bands.DELAY_SECONDS)).first()[0] == want


def test_widths():
    assert times.micros_of("5 minutes") == 300_000_000 and times.micros_of("1 day") == 86_400_000_000
    with pytest.raises(ValueError):
        times.micros_of("1 month")


def test_a_null_label_is_a_label(spark):
    """Its increase goes on over the edges of blocks."""
    rows = samples(spark, [(None, n * 1800, 3 * n) for n in range(6)])
    got = series.counter_increase(rows, ["series"], "1 hour").orderBy("ts").collect()
    assert [r.increase for r in got] == [None, 3.0, 3.0, 3.0, 3.0, 3.0]


def test_rate_against_brute_force(spark):
    """Gaps of several blocks, resets, NULL values and a NULL label; a hot series."""
    rng = random.Random(5)
    rows = []
    for name, count in (("hot", 500), ("cold", 60), (None, 60), ("one", 1)):
        clock = 0.0
        for _ in range(count):
            clock += rng.choice([0.25, 1, 7, 50, 61, 130, 400])
            rows.append((name, clock, rng.choice([None, *range(30)])))
    full = [(s, "i", "idle", T0 + dt.timedelta(seconds=t), None if v is None else float(v)) for s, t, v in rows]
    frame = spark.createDataFrame(full, schemas.SAMPLE)
    rises, last = {}, {}
    for s, t, v in rows:
        before = last.get(s)
        rises[s, t] = None if v is None or before is None else v - before if v >= before else v
        last[s] = v
    got = series.counter_increase(frame, ["series"], "1 minute").collect()
    assert {(r.series, seconds(r)): r.increase for r in got} == rises
    for width in (10, 60, 600):
        got = series.counter_rate(frame, width=f"{width} seconds").collect()
        assert len(got) == len(rows)
        for r in got:
            here = [x for (s, t), x in rises.items() if s == r.series and seconds(r) - width < t <= seconds(r)]
            here = [x for x in here if x is not None]
            assert (r.rate is None) == (not here) and (not here or r.rate == pytest.approx(sum(here) / width))


def test_rates_shuffle_samples_once(spark, tmp_path):
    """Of the exchanges only one carries samples; the others carry a row per series and block."""
    path = str(tmp_path / "samples")
    samples(spark, [("a", n, n) for n in range(10)]).write.parquet(path)
    frame = spark.read.schema(schemas.SAMPLE).parquet(path)
    for found in (series.counter_rate(frame), series.counter_rate(frame, extrapolate=True), series.counter_increase(frame, ["series"])):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for many samples
        try:
            plan = found._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.index("SortMergeJoin") < plan.index("Exchange")
        sides = [line.split("Exchange")[0] for line in plan.splitlines() if "Exchange" in line]
        assert len([before for before in sides if ":" in before]) == 1  # the join's left side: samples
