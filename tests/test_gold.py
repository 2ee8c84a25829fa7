import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import dashboard, star
from tidewatch.operators.rollup import rollup_tumbling
from tidewatch.plans.gold import GoldTables, build_gold

BASE = dict(
    camera_id="cam01", city="c", district="d", ward="w", street="s", latitude=1.0, longitude=2.0,
    rtsp_url="u", risk_level="high", is_violent=False, score=0.1, fps=10.0, latency_ms=5.0,
    evidence_url=None, ai_timestamp=None, ingest_time=None,
)


def bronze(spark, *rows):
    full = []
    for row in rows:
        at = row.get("event_time")
        full.append({**BASE, **row, "event_time": at, "event_date": at.date() if at else None})
    order = schemas.columns(schemas.BRONZE)
    return spark.createDataFrame([tuple(r[c] for c in order) for r in full], schemas.BRONZE)


def at(text):
    return dt.datetime.fromisoformat(f"2025-01-01 {text}")


def test_window_edges_and_null_time(spark):
    rows = bronze(
        spark,
        {"event_time": at("10:04:59.999")},
        {"event_time": at("10:05:00")},
        {"event_time": None},
    )
    got = {str(r.window_start): r.alert_count for r in rollup_tumbling(rows).collect()}
    assert got == {"2025-01-01 10:00:00": 0, "2025-01-01 10:05:00": 0}


def test_null_keys_form_a_group(spark):
    rows = bronze(
        spark,
        {"event_time": at("10:00:00"), "ward": None},
        {"event_time": at("10:01:00"), "ward": None, "is_violent": None},
        {"event_time": at("10:01:00"), "is_violent": True},
    )
    got = {r.ward: (r.alert_count, r.is_violent_window) for r in rollup_tumbling(rows).collect()}
    assert got == {None: (0, False), "w": (1, True)}


@pytest.mark.parametrize(
    "pairs, want",
    [
        ([(0.5, "a"), (0.5, "b"), (0.4, "z")], (0.5, "b")),
        ([(0.5, None), (0.5, "a")], (0.5, "a")),
        ([(None, "a"), (None, "q")], (None, "q")),
        ([(None, "q"), (0.0, None)], (0.0, None)),
    ],
)
def test_riskiest_row(spark, pairs, want):
    rows = [{"event_time": at("10:00:00"), "score": s, "evidence_url": u} for s, u in pairs]
    (got,) = rollup_tumbling(bronze(spark, *rows)).collect()
    assert (got.max_risk_score, got.evidence_url) == want


def test_nan_ranks_highest(spark):
    rows = [{"event_time": at("10:00:00"), "score": s, "evidence_url": "u"} for s in (1.0, float("nan"))]
    (got,) = rollup_tumbling(bronze(spark, *rows)).collect()
    assert got.max_risk_score != got.max_risk_score


def test_two_risk_levels_share_an_id_unless_the_grain_is_hashed(spark):
    rows = bronze(
        spark,
        {"event_time": at("10:00:00")},
        {"event_time": at("10:01:00"), "risk_level": "low"},
    )
    rollup = rollup_tumbling(rows)
    assert star.with_keys(rollup).select("fact_id").distinct().count() == 1
    assert star.with_keys(rollup, True).select("fact_id").distinct().count() == 2


def test_keys(spark):
    row = star.with_keys(rollup_tumbling(bronze(spark, {"event_time": at("10:07:00")}))).first()
    import hashlib

    assert (row.date_key, row.time_key) == (20250101, 202501011005)
    assert row.location_key == hashlib.sha256(b"c|d|w|s").hexdigest()
    assert row.fact_id == hashlib.sha256(b"cam01-2025-01-01 10:05:00").hexdigest()


def test_one_row_per_place_unless_every_variant_is_asked(spark):
    keyed = star.with_keys(
        rollup_tumbling(
            bronze(
                spark,
                {"event_time": at("10:00:00"), "latitude": 3.0, "longitude": 1.0},
                {"event_time": at("11:00:00"), "latitude": 1.0, "longitude": 9.0},
            )
        )
    )
    (place,) = star.location_rows(keyed).collect()
    assert (place.latitude, place.longitude) == (1.0, 9.0)
    assert star.location_rows(keyed, every_variant=True).count() == 2


def tables(spark, tmp_path, name):
    return GoldTables(
        *(f"{t}_{name}" for t in ("dt", "dl", "dc", "fact", "rag")), path=str(tmp_path)
    )


def counts(spark, names):
    return [
        spark.table(n).count()
        for n in (names.time, names.location, names.camera, names.fact, names.retrieval)
    ]


def test_gold_runs_twice_without_doubling(spark, tmp_path, name):
    names = tables(spark, tmp_path, name)
    rows = bronze(
        spark,
        {"event_time": at("10:00:00"), "is_violent": True, "evidence_url": "e"},
        {"event_time": at("10:06:00"), "camera_id": "cam02"},
    )
    assert build_gold(spark, rows, names)
    assert counts(spark, names) == [2, 1, 2, 2, 1]
    assert build_gold(spark, rows, names)
    assert counts(spark, names) == [2, 1, 2, 2, 1]
    for table, layout in (
        (names.fact, schemas.FACT),
        (names.retrieval, schemas.RETRIEVAL_EVENT),
        (names.location, schemas.DIM_LOCATION),
    ):
        assert set(spark.table(table).columns) == set(schemas.columns(layout))

    late = bronze(spark, {"event_time": at("10:01:00"), "is_violent": True, "score": 0.9})
    assert build_gold(spark, rows.unionByName(late), names)
    assert counts(spark, names) == [2, 1, 2, 2, 1]
    assert spark.table(names.fact).agg(F.max("max_risk_score")).first()[0] == 0.9

    build_gold(spark, rows, names, append=True)
    assert spark.table(names.fact).count() == 4


def test_other_dates_stay(spark, tmp_path, name):
    names = tables(spark, tmp_path, name)
    day = dt.datetime(2025, 1, 2, 10)
    first = bronze(spark, {"event_time": at("10:00:00"), "is_violent": True})
    both = first.unionByName(bronze(spark, {"event_time": day, "is_violent": True}))
    build_gold(spark, first, names)
    build_gold(spark, both, names, first="2025-01-02", last="2025-01-02")
    dates = [r.date_key for r in spark.table(names.fact).orderBy("date_key").collect()]
    assert dates == [20250101, 20250102]


@pytest.mark.parametrize("width", ["7 minutes", "2 days", "1 hour"])
def test_a_rerun_of_a_date_changes_nothing(spark, tmp_path, name, width):
    """Also where windows reach over midnight."""
    names = tables(spark, tmp_path, name)
    start = dt.datetime(2025, 1, 8)
    times = [start + dt.timedelta(minutes=13 * n) for n in range(450)]
    rows = bronze(spark, *({"event_time": t, "is_violent": n % 3 == 0} for n, t in enumerate(times)))
    build_gold(spark, rows, names, width)
    want = [sorted(map(tuple, spark.table(t).collect()), key=repr) for t in (names.fact, names.retrieval)]
    for day in ("2025-01-09", "2025-01-10"):
        build_gold(spark, rows, names, width, first=day, last=day)
    build_gold(spark, rows, names, width, first="2025-01-11")
    build_gold(spark, rows, names, width, last="2025-01-09")
    assert [sorted(map(tuple, spark.table(t).collect()), key=repr) for t in (names.fact, names.retrieval)] == want


def test_withdrawn_alerts_go(spark, tmp_path, name):
    names = tables(spark, tmp_path, name)
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    days = [dt.datetime(2025, 1, d, 10) for d in (1, 2, 3)]
    rows = bronze(spark, *({"event_time": day, "is_violent": True} for day in days))
    build_gold(spark, rows, names)

    def dates():
        return [
            sorted(str(r[0]) for r in spark.table(t).select(part).collect())
            for t, part in ((names.fact, "date_key"), (names.retrieval, "date"))
        ]

    flags = rows.withColumn("is_violent", F.col("event_time") != days[1])
    build_gold(spark, flags, names, first="2025-01-02", last="2025-01-02")
    assert dates() == [["20250101", "20250102", "20250103"], ["2025-01-01", "2025-01-03"]]
    gone = rows.where(F.col("event_time") == days[2]).select("camera_id", "event_time")
    assert build_gold(spark, rows, names, first="2025-01-03", last="2025-01-03", retractions=gone)
    assert dates() == [["20250101", "20250102"], ["2025-01-01"]]
    assert set(shared.iterdir()) == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_place_is_one_that_a_row_has(spark):
    rows = bronze(
        spark,
        {"event_time": at("10:00:00"), "latitude": 5.0, "longitude": 2.0},
        {"event_time": at("10:01:00"), "latitude": 1.0, "longitude": 9.0},
        {"event_time": at("10:02:00"), "latitude": None, "longitude": 0.0},
        {"event_time": at("11:00:00"), "latitude": None, "longitude": 3.0},
    )
    got = rollup_tumbling(rows).orderBy("window_start").collect()
    assert [(r.latitude, r.longitude) for r in got] == [(1.0, 9.0), (None, 3.0)]


def test_empty_bronze_writes_nothing(spark, tmp_path, name):
    names = tables(spark, tmp_path, name)
    assert not build_gold(spark, bronze(spark, {"event_time": at("10:00:00")}).limit(0), names)
    assert not spark.catalog.tableExists(names.fact)


def test_rollup_keeps_all_rows_with_a_time(spark):
    from suite.views import alerts

    rows = alerts(spark, "/root/testdata/sf0.001").withColumn("is_violent", F.lit(True))
    total = rollup_tumbling(rows, "1 hour").agg(F.sum("alert_count")).first()[0]
    assert total == rows.count()


def fact(spark, *starts):
    rows = [(f"f{i}", dt.datetime.fromisoformat(s), True, "L") for i, s in enumerate(starts)]
    return spark.createDataFrame(
        rows, "fact_id string, window_start timestamp, is_violent_window boolean, location_key string"
    ).withColumn("date_key", F.date_format("window_start", "yyyyMMdd").cast("int"))


def test_lower_bound_is_closed(spark):
    rows = fact(spark, "2025-01-01 00:00:00", "2025-01-01 23:59:59", "2025-01-09 00:00:00")
    got = dashboard.last_7d(rows, "2025-01-08 00:00:00").select("fact_id").collect()
    assert {r[0] for r in got} == {"f0", "f1", "f2"}
    got = dashboard.in_range(rows, "2025-01-01 00:00:00", "2025-01-01 23:59:59").collect()
    assert {r.fact_id for r in got} == {"f0", "f1"}


def test_now_is_the_default(spark):
    rows = fact(spark, "2020-01-01 00:00:00")
    assert dashboard.last_24h(rows).count() == 0


def test_all_cameras(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "camera_key string")
    assert dashboard.for_cameras(rows, None).count() == 2
    assert dashboard.for_cameras(rows, ["a"]).count() == 1


def test_wards_with_the_same_or_no_name(spark):
    rows = fact(spark, *["2025-01-01 01:00:00"] * 3).withColumn(
        "camera_key", F.lit("cam")
    ).withColumn("location_key", F.col("fact_id"))
    places = spark.createDataFrame(
        [("f0", None, "s"), ("f1", None, "s"), ("f2", "", "s")],
        "location_key string, ward string, street string",
    )
    got = dashboard.incidents_of_day(rows, places, "2025-01-01").collect()
    assert sorted((r.ward or "-", r.ward_total, r.day_total) for r in got if r.ward is None) == [("-", 2, 3)] * 2
    assert [(r.ward_total, r.day_total) for r in got if r.ward == ""] == [(1, 3)]


def test_order_rank(spark):
    rows = spark.createDataFrame([(2, "b"), (1, "z"), (2, "a"), (3, "c")], "t int, id string")
    ranked = {r.id: r.position for r in dashboard.order_rank(rows, "t", "id").collect()}
    assert ranked == {"z": 1, "a": 2, "b": 3, "c": 4}


def test_order_rank_keeps_nulls_and_skewed_keys(spark):
    rows = [(None, "n"), (None, None)] + [(7, f"camera-of-one-prefix-{n:05}") for n in range(3000)] + [(8, "z")]
    got = dashboard.order_rank(spark.createDataFrame(rows, "t int, id string").repartition(5), "t", "id").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == [None, "n", *sorted(i for t, i in rows if t == 7), "z"]
    assert sorted(r.position for r in got) == list(range(1, 3004))
