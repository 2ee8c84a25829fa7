import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import ingest, joins

GOOD = '{"camera_id": "cam01", "score": 0.5, "is_violent": true, "timestamp": "2025-01-01T10:00:00.000001"}'


def parsed(spark, *bodies):
    rows = [(i, b if b is None else bytearray(b.encode())) for i, b in enumerate(bodies)]
    raw = spark.createDataFrame(rows, "n int, value binary")
    return ingest.parse_alert_json(raw.orderBy("n")).collect()


def test_layout(spark):
    row = parsed(spark, GOOD)[0]
    assert list(row.asDict()) == schemas.columns(schemas.ALERT)
    assert (row.camera_id, row.score, row.is_violent) == ("cam01", 0.5, True)


@pytest.mark.parametrize("body", ['{"camera_id": "cam01", "fps": ', "", None, "[]"])
def test_unreadable_gives_a_row_of_nulls(spark, body):
    (row,) = parsed(spark, body)
    assert all(v is None for v in row)


def test_one_bad_field_leaves_the_others(spark):
    (row,) = parsed(spark, '{"camera_id": 5, "score": "1.5", "fps": 0, "is_violent": "yes", "Ward": "w", "x": 1}')
    assert row.camera_id == "5" and row.score is None and row.fps == 0.0
    assert row.is_violent is None and row.ward is None


def derived(spark, stamp):
    frame = spark.createDataFrame([("cam01", stamp)], "camera_id string, timestamp string")
    for column in schemas.columns(schemas.ALERT):
        if column not in frame.columns:
            frame = frame.withColumn(column, F.lit(None).cast("string"))
    return ingest.bronze_derive(frame).first()


@pytest.mark.parametrize(
    "stamp, time, date",
    [
        ("2025-01-01T10:00:00.000001", "2025-01-01 10:00:00.000001", "2025-01-01"),
        ("2025-01-01T10:00:00Z", "2025-01-01 10:00:00", "2025-01-01"),
        ("2025-01-01T01:00:00+07:00", "2024-12-31 18:00:00", "2025-01-01"),
        ("bad", None, None),
        (None, None, None),
    ],
)
def test_times(spark, stamp, time, date):
    row = derived(spark, stamp)
    assert str(row.event_time) == str(time) and str(row.event_date) == str(date)
    assert row.ingest_time is not None
    assert list(row.asDict()) == schemas.columns(schemas.BRONZE)


def test_quarantine_keeps_the_input(spark):
    raw = spark.createDataFrame([(GOOD,), ("oops",)], "value string")
    bronze = ingest.bronze_derive(ingest.parse_alert_json(raw, keep_raw=True))
    assert ingest.valid_rows(bronze).count() == 1
    assert [r.raw_json for r in ingest.quarantine_rows(bronze).collect()] == ["oops"]


def status(spark, **fields):
    row = {n: fields.get(n) for n in schemas.columns(schemas.STATUS)}
    return spark.createDataFrame([row], schemas.STATUS)


@pytest.mark.parametrize(
    "given, kept", [("offline", 0), ("error", 0), ("online", 1), (None, 1), ("Offline", 1)]
)
def test_offline_is_dropped(spark, given, kept):
    assert ingest.filter_online(status(spark, status=given)).count() == kept


def test_score_falls_back(spark):
    def score(**fields):
        return ingest.default_fields(status(spark, **fields)).first().score

    assert score(score=0.7, fight_prob=0.1) == 0.7
    assert score(fight_prob=0.1) == 0.1
    assert score() == 0.0


def test_enrichment_prefers_the_event_and_knows_only_registered(spark, monkeypatch):
    events = spark.createDataFrame(
        [("a", "event street", 1), ("b", None, 2), ("z", "x", 3)],
        "camera_id string, street string, n int",
    )
    registry = spark.createDataFrame(
        [("a", "registry street", "w1"), ("b", "registry street", "w2"), ("c", "s", "w3")],
        "camera_id string, street string, ward string",
    )
    want = {("a", "event street", 1, "w1"), ("b", None, 2, "w2")}
    for bound in (joins.BROADCAST_BYTES, 0):  # broadcast, and left to the planner over the bound
        monkeypatch.setattr(joins.reference_join, "__defaults__", ("inner", bound))
        out = ingest.enrich_with_registry(events, registry)
        got = out.select("camera_id", "street", "n", "ward").collect()
        assert {tuple(r) for r in got} == want


def test_soft_delete(spark):
    at = dt.datetime(2025, 1, 1)
    rows = spark.createDataFrame(
        [("a", at, 1), ("a", at + dt.timedelta(seconds=1), 2), ("b", at, 3)],
        "camera_id string, event_time timestamp, n int",
    )
    marks = spark.createDataFrame([("a", at)] * 2, "camera_id string, event_time timestamp")
    assert {r.n for r in ingest.soft_delete(rows, marks).collect()} == {2, 3}


def test_message_round_trip(spark, tmp_path):
    from tidewatch.sources import alerts

    rows = spark.createDataFrame(
        [("cam01", None, "Đường 1")], "camera_id string, score double, street string"
    )
    (value,) = [r.value for r in alerts.as_messages(rows).collect()]
    assert value == '{"camera_id":"cam01","score":null,"street":"Đường 1"}'
    alerts.write_alert_json(rows, "text", options={"path": str(tmp_path / "m")})
    assert spark.read.text(str(tmp_path / "m")).first().value == value


def test_status_to_message(spark):
    sent = dt.datetime(2025, 1, 1, 10)
    ready = ingest.default_fields(status(spark, camera_id="a", timestamp="then")).withColumn(
        "sent_at", F.lit(sent)
    )
    row = ingest.as_alert_message(ready).first()
    assert (row.timestamp, row.ai_timestamp) == ("2025-01-01T10:00:00", "then")
