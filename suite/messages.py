"""Messages, status records, registry files, retractions and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.catalog import query
from suite.views import (
    ALERTS_SQL,
    REGISTRY_SQL,
    STATUS_SQL,
    alerts,
    messages,
    raw_messages,
    readings,
    registry,
    statuses,
    table,
)
from tidewatch import schemas
from tidewatch.functions import keys, text, times
from tidewatch.operators import ingest
from tidewatch.session import shared_dir
from tidewatch.sources import alerts as alert_io
from tidewatch.sources import registry as registry_io

_RAW_SQL = """WITH raw AS (
  SELECT event_id, CASE event_type
    WHEN 'error' THEN printf('{"camera_id": "cam%d", "score": "%d", "is_violent": true, "timestamp": "%s"}',
      user_id, event_id, CAST(ts AS VARCHAR))
    WHEN 'view' THEN printf('{"camera_id": "cam%d", "fps": ', user_id)
    WHEN 'click' THEN printf('{"Camera_ID": "cam%d", "fps": %d, "city": %d, "timestamp": "no time"}',
      user_id, event_id, user_id)
    WHEN 'signup' THEN ''
    ELSE printf('{"camera_id": "cam%d", "latitude": %d, "image_preview": "x", "timestamp": "%s"}',
      user_id, event_id, CAST(ts AS VARCHAR)) END AS body
  FROM events
), valid AS (SELECT event_id, CASE WHEN json_valid(body) THEN body END AS j FROM raw
), parsed AS (
  SELECT event_id, json_extract_string(j, '$.camera_id') AS camera_id,
    json_extract_string(j, '$.city') AS city,
    CASE WHEN json_type(j, '$.latitude') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      THEN CAST(json_extract_string(j, '$.latitude') AS DOUBLE) END AS latitude,
    CASE WHEN json_type(j, '$.score') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      THEN CAST(json_extract_string(j, '$.score') AS DOUBLE) END AS score,
    CASE WHEN json_type(j, '$.fps') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      THEN CAST(json_extract_string(j, '$.fps') AS DOUBLE) END AS fps,
    CASE WHEN json_type(j, '$.is_violent') = 'BOOLEAN'
      THEN json_extract_string(j, '$.is_violent') = 'true' END AS is_violent,
    json_extract_string(j, '$.timestamp') AS timestamp
  FROM valid
)"""
_PARSED = "camera_id, city, latitude, score, fps, is_violent"


@query("parse_alert_json", _RAW_SQL + f" SELECT {_PARSED}, timestamp FROM parsed")
def parse_alert_json(spark, sf_dir):
    parsed = ingest.parse_alert_json(raw_messages(spark, sf_dir))
    return parsed.select(*_PARSED.split(", "), "timestamp")


@query(
    "bronze_derive",
    _RAW_SQL
    + f""" SELECT {_PARSED}, TRY_CAST(timestamp AS TIMESTAMP) AS event_time,
      TRY_CAST(substr(timestamp, 1, 10) AS DATE) AS event_date FROM parsed""",
)
def bronze_derive(spark, sf_dir):
    bronze = ingest.bronze_derive(ingest.parse_alert_json(raw_messages(spark, sf_dir)))
    return bronze.select(*_PARSED.split(", "), "event_time", "event_date")


_VALID = "camera_id IS NOT NULL AND TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL"


@query(
    "schema_enforce",
    _RAW_SQL
    + f""" SELECT camera_id, CAST(timestamp AS TIMESTAMP) AS event_time,
      CAST(NULL AS VARCHAR) AS rejected FROM parsed WHERE {_VALID}
    UNION ALL SELECT p.camera_id, TRY_CAST(p.timestamp AS TIMESTAMP), r.body
    FROM parsed p JOIN raw r ON p.event_id = r.event_id WHERE NOT ({_VALID})""",
)
def schema_enforce(spark, sf_dir):
    parsed = ingest.parse_alert_json(raw_messages(spark, sf_dir), keep_raw=True)
    bronze = ingest.bronze_derive(parsed)
    kept = ingest.valid_rows(bronze).select(
        "camera_id", "event_time", F.lit(None).cast("string").alias("rejected")
    )
    rejected = ingest.quarantine_rows(bronze)
    return kept.unionByName(
        rejected.select("camera_id", "event_time", F.col("raw_json").alias("rejected"))
    )


_MESSAGE_SQL = (
    "WITH "
    + ALERTS_SQL
    + """ SELECT camera_id, city, district, ward, street, latitude, longitude, rtsp_url,
      risk_level, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
      is_violent, score, fps, latency_ms, evidence_url FROM alerts"""
)


@query("prune_unknown_fields", _MESSAGE_SQL)
def prune_unknown_fields(spark, sf_dir):
    sent = alert_io.as_messages(messages(spark, sf_dir))
    return ingest.parse_alert_json(sent).drop("ai_timestamp")


@query("sink_alert_json", _MESSAGE_SQL)
def sink_alert_json(spark, sf_dir):
    path = shared_dir(spark, "messages")
    alert_io.write_alert_json(messages(spark, sf_dir), "text", options={"path": path})
    return ingest.parse_alert_json(spark.read.text(path)).drop("ai_timestamp")


@query(
    "filter_online",
    f"""WITH {STATUS_SQL} SELECT event_id, camera_id, status FROM statuses
    WHERE status IS NULL OR status NOT IN ('offline', 'error')""",
)
def filter_online(spark, sf_dir):
    online = ingest.filter_online(statuses(spark, sf_dir))
    return online.select("event_id", "camera_id", "status")


@query(
    "default_fields",
    f"""WITH {STATUS_SQL} SELECT event_id, coalesce(score, fight_prob, 0.0) AS score,
      coalesce(is_violent, false) AS is_violent, coalesce(fps, 0.0) AS fps,
      coalesce(latency_ms, 0.0) AS latency_ms, coalesce(image_preview, '') AS image_preview,
      evidence_url FROM statuses""",
)
def default_fields(spark, sf_dir):
    filled = ingest.default_fields(statuses(spark, sf_dir))
    return filled.drop("camera_id", "status", "timestamp")


@query(
    "enrich_with_registry",
    f"""WITH {REGISTRY_SQL} SELECT e.event_id, m.camera_id, m.city, m.ward, m.latitude,
      m.risk_level, 'moved' AS street
    FROM events e JOIN cameras m ON m.user_id = e.user_id WHERE m.risk_level <> 'low'""",
)
def enrich_with_registry(spark, sf_dir):
    """Cameras of low risk are not registered; the event's street replaces the camera's."""
    known = registry(spark, sf_dir).where("risk_level <> 'low'")
    moved = readings(spark, sf_dir).withColumn("street", F.lit("moved"))
    return ingest.enrich_with_registry(moved, known).select(
        "event_id", "camera_id", "city", "ward", "latitude", "risk_level", "street"
    )


@query(
    "soft_delete",
    "WITH "
    + ALERTS_SQL
    + """ SELECT event_id, camera_id, event_time FROM alerts WHERE NOT (is_violent AND score < 0.2)""",
)
def soft_delete(spark, sf_dir):
    bronze = alerts(spark, sf_dir)
    retracted = bronze.where("is_violent AND score < 0.2").select("camera_id", "event_time")
    return ingest.soft_delete(bronze, retracted).select("event_id", "camera_id", "event_time")


_REGISTRY_COLUMNS = ", ".join(schemas.columns(schemas.REGISTRY))


@query("sink_registry_csv", f"WITH {REGISTRY_SQL} SELECT {_REGISTRY_COLUMNS} FROM cameras")
def sink_registry_csv(spark, sf_dir):
    path = shared_dir(spark, "registry")
    registry_io.write_registry_csv(registry(spark, sf_dir), path)
    return registry_io.read_registry_csv(spark, path)


@query(
    "src_registry_csv",
    """WITH entries AS (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS p FROM events)
    SELECT concat('cam', CAST(user_id AS VARCHAR)) AS camera_id, event_type AS ward,
      CASE WHEN event_type <> 'click' THEN CAST(event_id AS DOUBLE) END AS latitude,
      value AS longitude FROM entries WHERE p = 1""",
)
def src_registry_csv(spark, sf_dir):
    """One entry per event, written in event order: the last of a camera wins."""
    path = shared_dir(spark, "registry-entries")
    blank = F.lit(None).cast("string")
    entries = table(spark, sf_dir, "events").select(
        F.concat(F.lit("cam"), F.col("user_id").cast("string")).alias("camera_id"),
        blank.alias("city"), blank.alias("district"),
        F.col("event_type").alias("ward"),
        blank.alias("street"),
        F.when(F.col("event_type") == "click", "unknown")
        .otherwise(F.col("event_id").cast("string"))
        .alias("latitude"),
        F.col("value").alias("longitude"),
        blank.alias("rtsp_url"), blank.alias("risk_level"),
        "event_id",
    )
    registry_io.write_registry_csv(entries.orderBy("event_id"), path)
    read = registry_io.read_registry_csv(spark, path)
    return read.select("camera_id", "ward", "latitude", "longitude")


# Scalar functions. ------------------------------------------------------------------


@query(
    "fn_time_keys",
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
      CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS time_key,
      CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events""",
)
def fn_time_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        keys.date_key("ts").alias("date_key"),
        keys.time_key("ts").alias("time_key"),
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
    )


@query(
    "fn_lenient_time",
    """SELECT event_id,
      CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN ts - INTERVAL '7 hours'
        ELSE ts END AS event_time,
      CASE event_type WHEN 'click' THEN NULL ELSE CAST(ts AS DATE) END AS event_date
    FROM events""",
)
def fn_lenient_time(spark, sf_dir):
    """Plain, Z, +07:00 and unreadable texts."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.col("event_type")
    written = (
        F.when(kind == "click", F.concat(F.lit("at "), iso))
        .when(kind == "view", F.concat(iso, F.lit("+07:00")))
        .when(kind == "error", F.concat(iso, F.lit("Z")))
        .otherwise(iso)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.lenient_timestamp(written).alias("event_time"),
        times.lenient_date(written).alias("event_date"),
    )


@query(
    "fn_iso_text",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
        ELSE strftime(l_shipdate + INTERVAL '1 microsecond', '%Y-%m-%dT%H:%M:%S.%f') END AS written
    FROM lineitem""",
)
def fn_iso_text(spark, sf_dir):
    moved = F.col("l_shipdate").cast("timestamp") + F.when(
        F.col("l_linenumber") % 2 == 0, F.expr("INTERVAL 0 MICROSECOND")
    ).otherwise(F.expr("INTERVAL 1 MICROSECOND"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", times.iso_text(moved).alias("written")
    )


@query(
    "fn_hash_keys",
    """SELECT user_id, event_id, sha256(concat_ws('|', city, district, ward, street)) AS place,
      sha256(concat_ws('-', ward, strftime(minute, '%Y-%m-%d %H:%M:%S'))) AS row_key
    FROM (SELECT *, CASE WHEN event_type <> 'click' THEN event_type END AS city,
        props AS district, CASE WHEN event_type <> 'view' THEN props END AS ward,
        CASE WHEN event_type <> 'click' THEN CAST(user_id AS VARCHAR) END AS street,
        date_trunc('minute', ts) AS minute FROM events) e""",
)
def fn_hash_keys(spark, sf_dir):
    """NULL parts are skipped, wherever they stand."""
    kind = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .select(
            "user_id",
            "event_id",
            F.when(kind != "click", kind).alias("city"),
            F.col("props").alias("district"),
            F.when(kind != "view", F.col("props")).alias("ward"),
            F.when(kind != "click", F.col("user_id").cast("string")).alias("street"),
            F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("minute"),
        )
        .select(
            "user_id",
            "event_id",
            keys.place_key().alias("place"),
            keys.row_key("ward", "minute").alias("row_key"),
        )
    )


@query(
    "fn_two_digits",
    """SELECT l_orderkey, l_partkey, printf('%.2f', l_discount / 8) AS eighth,
      printf('%.2f', l_extendedprice / 1000) AS thousandth,
      printf('%.2f', -l_tax / 16) AS negative,
      printf('%.2f', l_linenumber + 0.125) AS tie
    FROM lineitem""",
)
def fn_two_digits(spark, sf_dir):
    shown = table(spark, sf_dir, "lineitem")
    for name, value in (
        ("eighth", F.col("l_discount") / 8),
        ("thousandth", F.col("l_extendedprice") / 1000),
        ("negative", -F.col("l_tax") / 16),
        ("tie", F.col("l_linenumber") + 0.125),
    ):
        shown = text.with_two_digits(shown, value, name)
    return shown.select("l_orderkey", "l_partkey", "eighth", "thousandth", "negative", "tie")


@query(
    "fn_numbers",
    """SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN NULL
        ELSE value END AS as_number, value * 100 AS percent
    FROM events""",
)
def fn_numbers(spark, sf_dir):
    """Number texts, empty texts and words; bad ones become NULL."""
    kind = F.col("event_type")
    written = (
        F.when(kind == "view", "n/a").when(kind == "click", "").otherwise(F.col("value").cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        written.try_cast("double").alias("as_number"),
        (F.col("value") * 100).alias("percent"),
    )
