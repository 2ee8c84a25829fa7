"""From raw bytes and camera status to typed, enriched alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.functions.times import iso_text, lenient_date, lenient_timestamp, moment
from tidewatch.operators.joins import reference_join, without


def parse_json(
    raw: DataFrame, layout: str, value: str = "value", keep_raw: bool = False
) -> DataFrame:
    """Decode a JSON byte or text column into the columns of ``layout``.

    Permissive: an unreadable value gives a row of NULLs, a badly typed field is
    NULL, fields outside the layout are dropped.
    """
    body = F.col(value).cast("string")
    extra = [body.alias("raw_json")] if keep_raw else []
    return raw.select(F.from_json(body, layout).alias("alert"), *extra).select(
        "alert.*", *(["raw_json"] if keep_raw else [])
    )


def parse_alert_json(raw: DataFrame, value: str = "value", keep_raw: bool = False) -> DataFrame:
    """Alert messages to flat columns."""
    return parse_json(raw, schemas.ALERT, value, keep_raw)


def bronze_derive(alerts: DataFrame, ingest_time: str | None = None) -> DataFrame:
    """Parsed alerts in the bronze layout; the raw ``timestamp`` text is dropped.

    Columns beyond the layout, such as ``raw_json``, are kept after it.
    """
    typed = alerts.withColumns(
        {
            "event_time": lenient_timestamp("timestamp"),
            "event_date": lenient_date("timestamp"),
            "ingest_time": moment(ingest_time),
        }
    )
    layout = schemas.columns(schemas.BRONZE)
    rest = [c for c in alerts.columns if c not in layout and c != "timestamp"]
    return typed.select(*layout, *rest)


def valid_rows(bronze: DataFrame) -> DataFrame:
    """Rows that carry a camera and a readable event time."""
    return bronze.where("camera_id IS NOT NULL AND event_time IS NOT NULL")


def quarantine_rows(bronze: DataFrame) -> DataFrame:
    """The rows :func:`valid_rows` rejects, with their input when it was kept."""
    return bronze.where("camera_id IS NULL OR event_time IS NULL")


def filter_online(status: DataFrame) -> DataFrame:
    """Drop cameras reported offline or in error; a missing status stays."""
    return status.where("status IS NULL OR status NOT IN ('offline', 'error')")


def default_fields(status: DataFrame) -> DataFrame:
    """Fill the fields a status record may omit.

    A parsed record does not tell a missing field from an explicit null, so both
    take the default.
    """
    return status.withColumns(
        {
            "score": F.coalesce("score", "fight_prob", F.lit(0.0)),
            "is_violent": F.coalesce("is_violent", F.lit(False)),
            "fps": F.coalesce("fps", F.lit(0.0)),
            "latency_ms": F.coalesce("latency_ms", F.lit(0.0)),
            "image_preview": F.coalesce("image_preview", F.lit("")),
        }
    ).drop("fight_prob")


def enrich_with_registry(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Events of registered cameras with the camera's attributes.

    A column present on both sides keeps the event's value.
    """
    clash = set(events.columns) - {"camera_id"}
    attributes = registry.drop(*clash)
    return reference_join(events, attributes, "camera_id")


def as_alert_message(status: DataFrame, sent_at: str = "sent_at") -> DataFrame:
    """Status rows under the message's field names: send time, then the camera's time."""
    renamed = status.withColumnRenamed("timestamp", "ai_timestamp")
    return renamed.withColumn("timestamp", iso_text(sent_at)).drop(sent_at, "status")


def soft_delete(bronze: DataFrame, retractions: DataFrame) -> DataFrame:
    """Bronze rows without those retracted by camera and event time."""
    return without(bronze, retractions, ["camera_id", "event_time"]).select(*bronze.columns)


def prune_dates(bronze: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Bronze rows of a date range, both ends included; prunes date partitions."""
    kept = bronze
    if first is not None:
        kept = kept.where(F.col("event_date") >= F.lit(first).cast("date"))
    if last is not None:
        kept = kept.where(F.col("event_date") <= F.lit(last).cast("date"))
    return kept
