"""Enrichment on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.operators.ingest import (
    as_alert_message,
    default_fields,
    enrich_with_registry,
    filter_online,
)
from tidewatch.streaming.throttle import stream_throttle


def stream_enrich(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Events of registered cameras with the camera's attributes.

    The registry is a fixed table that every micro-batch reads again. Its estimated size
    decides at start whether it is broadcast.
    """
    return enrich_with_registry(events, registry)


def camera_alerts(status: DataFrame, registry: DataFrame, time: str = "sent_at", **throttle) -> DataFrame:
    """Status stream to alert messages: filter, defaults, throttle, then attributes."""
    ready = default_fields(filter_online(status))
    kept = stream_throttle(ready, time=time, **throttle)
    return stream_enrich(as_alert_message(kept, time), registry)
