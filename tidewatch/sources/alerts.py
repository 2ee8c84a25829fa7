"""Alert messages in and out of a broker or files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def alert_stream(
    spark: SparkSession,
    format: str = "kafka",
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of messages with a ``value`` column.

    Kafka needs its connector on the class path and ``kafka.bootstrap.servers``
    among the options; it starts at the latest offsets. ``text`` reads message
    files below the option ``path``.
    """
    defaults = {"subscribe": topic, "startingOffsets": "latest"} if topic else {}
    return spark.readStream.format(format).options(**{**defaults, **(options or {})}).load()


def as_messages(alerts: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``, without a key; NULL fields are written out."""
    record = F.struct(*alerts.columns)
    return alerts.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def write_alert_json(
    alerts: DataFrame,
    format: str = "kafka",
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Publish alerts as UTF-8 JSON to the topic, or to text files below the option ``path``."""
    target = {**({"topic": topic} if topic else {}), **(options or {})}
    as_messages(alerts).write.format(format).options(**target).mode("append").save()
