"""Message stream to bronze commits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch import schemas
from tidewatch.functions.times import lenient_timestamp
from tidewatch.lake import commits
from tidewatch.operators import ingest
from tidewatch.streaming.metrics import OBSERVED

# Fixed value: how often a micro-batch is started.
TRIGGER = "60 seconds"


def create_bronze_lake(spark: SparkSession, table: str, path: str | None = None) -> None:
    """Bronze table with a commit log."""
    commits.create(spark, table, schemas.BRONZE, ["event_date"], path)


def batch_writer(
    table: str,
    enforce: bool = False,
    quarantine: str | None = None,
    retain: int = commits.RETAIN_COMMITS,
    expire_every: int = commits.EXPIRE_EVERY,
    on_batch: Callable[[int, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function run on every micro-batch of parsed alerts.

    An empty batch writes nothing. Others become the commit of their batch
    number; a replayed batch replaces itself. Errors are raised, so a failed
    batch is tried again instead of being lost. With ``enforce`` rows without
    camera or event time go to the ``quarantine`` path instead, which must then be named.
    """
    if enforce and not quarantine:
        raise ValueError("enforce needs a quarantine path for the rows it rejects")

    def write(batch: DataFrame, batch_id: int) -> None:
        bronze = ingest.bronze_derive(batch)
        if enforce:
            # Two writes, but the messages are fetched once.
            bronze = bronze.persist()
        try:
            kept = ingest.valid_rows(bronze) if enforce else bronze
            rows = commits.commit(kept, table, batch_id)
            if enforce:
                ingest.quarantine_rows(bronze).write.mode("overwrite").json(
                    f"{quarantine}/batch={batch_id}"
                )
        finally:
            if enforce:
                bronze.unpersist()
        if rows and batch_id % expire_every == 0:
            commits.expire(batch.sparkSession, table, retain)
        if rows and on_batch:
            on_batch(batch_id, rows)

    return write


def start_bronze(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    enforce: bool = False,
    quarantine: str | None = None,
    writer: Callable[[DataFrame, int], None] | None = None,
    **maintenance,
) -> StreamingQuery:
    """Start the stream; ``trigger={"availableNow": True}`` drains what is there and ends.

    A ``writer`` of its own, as ``dated.dated_writer`` gives, takes the place of
    :func:`batch_writer`; rules and quarantine are then its own.
    """
    parsed = ingest.parse_alert_json(messages, keep_raw=enforce or writer is not None).observe(
        OBSERVED,
        F.count(F.lit(1)).alias("records"),
        F.max(F.unix_micros(lenient_timestamp("timestamp"))).alias("newest"),
    )
    writer = writer or batch_writer(table, enforce, quarantine, **maintenance)
    return (
        parsed.writeStream.queryName(f"bronze {table}")
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
