"""Table layouts as DDL strings, the form Spark readers and ``from_json`` take."""

from __future__ import annotations

# Column names and types shared with producers and readers.
ALERT = (
    "camera_id string, city string, district string, ward string, street string, "
    "latitude double, longitude double, rtsp_url string, risk_level string, "
    "timestamp string, ai_timestamp string, is_violent boolean, score double, "
    "fps double, latency_ms double, evidence_url string"
)

BRONZE = (
    "camera_id string, city string, district string, ward string, street string, "
    "latitude double, longitude double, rtsp_url string, risk_level string, "
    "event_time timestamp, event_date date, ai_timestamp string, is_violent boolean, "
    "score double, fps double, latency_ms double, evidence_url string, "
    "ingest_time timestamp"
)

REGISTRY = (
    "camera_id string, city string, district string, ward string, street string, "
    "latitude double, longitude double, rtsp_url string, risk_level string"
)

STATUS = (
    "camera_id string, status string, timestamp string, is_violent boolean, "
    "score double, fight_prob double, fps double, latency_ms double, "
    "image_preview string, evidence_url string"
)

DIM_TIME = "time_key long, date_key int, hour int, minute int"

DIM_LOCATION = (
    "location_key string, city string, district string, ward string, street string, "
    "latitude double, longitude double"
)

DIM_CAMERA = "camera_key string, camera_id string, rtsp_url string, risk_level string"

FACT = (
    "fact_id string, date_key int, time_key long, location_key string, "
    "camera_key string, window_start timestamp, avg_latency_ms double, "
    "avg_fps double, is_violent_window boolean, max_risk_score double, "
    "alert_count long, evidence_url string"
)

RETRIEVAL_EVENT = (
    "event_id string, timestamp_utc timestamp, camera_id string, city string, "
    "district string, ward string, street string, score double, "
    "label string, date string"
)

METADATA = (
    "event_id string, camera_id string, date string, label string, "
    "score double, frame_s3_path string"
)

SAMPLE = "series string, instance string, mode string, ts timestamp, value double"


def columns(ddl: str) -> list[str]:
    """Column names of a flat layout, in order; needs no session."""
    return [column.split()[0] for column in ddl.split(",")]
