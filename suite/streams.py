"""Streaming jobs over files written from the tables, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.catalog import query
from suite.storage import SLICES, _BRONZE_OUT, _BRONZE_SQL, _name
from suite.views import ALERTS_SQL, REGISTRY_SQL, messages, readings, registry, rollup_sql
from tidewatch.lake import commits
from tidewatch.operators import series
from tidewatch.operators.throttle import throttle
from tidewatch.session import shared_dir
from tidewatch.sources import alerts as alert_io
from tidewatch.streaming import bronze, enrich, metrics, rollup
from tidewatch.streaming import throttle as throttled

HOUR = 3600.0

#: Files of a slice of readings, and of a micro-batch.
FILES = 8

#: Most files of a slice of messages: micro-batches take three, however the slice was joined.
MESSAGE_FILES = 15


def ordered_files(spark, rows, time, write):
    """Five slices of rows in time order, written one slice after the other."""
    path = shared_dir(spark, "slices")
    for since, until in zip(SLICES, SLICES[1:]):
        part = rows.where(F.col(time) >= since)
        write(part.where(F.col(time) < until) if until else part, path)
    return path


def write_slice(rows, path):
    """A slice as ``FILES`` files, each with a range of times.

    Tasks end in any order, so only whole slices are batches in time order: where ranges
    are empty, empty files fill the slice up.
    """
    parts = rows.repartitionByRange(FILES, "event_time").sortWithinPartitions("event_time")
    parts.write.mode("append").parquet(path)
    for _ in range(-len(rows.sparkSession.read.parquet(path).inputFiles()) % FILES):
        rows.limit(0).coalesce(1).write.mode("append").parquet(path)


def reading_stream(spark, sf_dir):
    rows = readings(spark, sf_dir)
    path = ordered_files(spark, rows, "event_time", write_slice)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def drained(spark, stream):
    """Run the stream over what is there and return its output."""
    out = shared_dir(spark, "drained")
    query_run = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query_run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), query_run


def message_stream(spark, sf_dir):
    path = ordered_files(
        spark,
        messages(spark, sf_dir),
        "timestamp",
        lambda df, p: alert_io.write_alert_json(df.coalesce(MESSAGE_FILES), "text", options={"path": p}),
    )
    return alert_io.alert_stream(spark, "text", options={"path": path, "maxFilesPerTrigger": "3"})


def run_bronze(spark, sf_dir, **options):
    name = _name("bronze")
    bronze.create_bronze_lake(spark, name, shared_dir(spark, "bronze"))
    running = bronze.start_bronze(
        message_stream(spark, sf_dir),
        name,
        shared_dir(spark, "checkpoint"),
        {"availableNow": True},
        **options,
    )
    running.awaitTermination()
    return name, running


@query(
    "src_alert_stream",
    "WITH " + ALERTS_SQL + " SELECT camera_id, count(*) AS n FROM alerts GROUP BY camera_id",
)
def src_alert_stream(spark, sf_dir):
    """Messages as the source hands them over, unparsed until read back."""
    raw, _ = drained(spark, message_stream(spark, sf_dir))
    camera = F.get_json_object("value", "$.camera_id").alias("camera_id")
    return raw.groupBy(camera).agg(F.count("*").alias("n"))


@query("stream_bronze", "WITH " + ALERTS_SQL + _BRONZE_SQL)
def stream_bronze(spark, sf_dir):
    name, _ = run_bronze(spark, sf_dir)
    return commits.current(spark, name).select(*_BRONZE_OUT)


@query("stream_periodic_maintenance")
def stream_periodic_maintenance(spark, sf_dir):
    """Commits left after expiring to two on every second batch."""
    name, _ = run_bronze(spark, sf_dir, retain=2, expire_every=2)
    return commits.history(spark, name).select("commit_id", "rows")


@query(
    "stream_metrics",
    "SELECT 'bronze_records_total' AS series, 'driver' AS instance, "
    "CAST(count(*) AS DOUBLE) AS value FROM events",
)
def stream_metrics(spark, sf_dir):
    """The record counter after a bronze run, out of the query's progress reports."""
    _, running = run_bronze(spark, sf_dir)
    samples = metrics.progress_samples(spark, running.recentProgress)
    counter = samples.where(F.col("series") == metrics.RECORDS)
    return series.gauge_latest(counter, ["series", "instance"]).drop("ts")


_THROTTLE_SQL = """WITH RECURSIVE numbered AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
    CASE WHEN event_type = 'error' THEN 3600000000 ELSE 21600000000 END AS gap,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events
), walk AS (
  SELECT user_id, n, event_id, true AS kept, us AS last FROM numbered WHERE n = 1
  UNION ALL
  SELECT e.user_id, e.n, e.event_id, e.us - w.last >= e.gap,
    CASE WHEN e.us - w.last >= e.gap THEN e.us ELSE w.last END
  FROM walk w JOIN numbered e ON e.user_id = w.user_id AND e.n = w.n + 1
) SELECT event_id, concat('cam', lpad(CAST(user_id AS VARCHAR),
  CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS camera_id
FROM walk WHERE kept"""

_GAPS = {"alert_seconds": HOUR, "idle_seconds": 6 * HOUR, "tie": "event_id"}


@query("throttle", _THROTTLE_SQL)
def throttle_batch(spark, sf_dir):
    kept = throttle(readings(spark, sf_dir), **_GAPS)
    return kept.select("event_id", "camera_id")


@query("stream_throttle", _THROTTLE_SQL)
def stream_throttle(spark, sf_dir):
    kept, _ = drained(spark, throttled.stream_throttle(reading_stream(spark, sf_dir), **_GAPS))
    return kept.select("event_id", "camera_id")


@query("stream_throttle_batches", _THROTTLE_SQL)
def stream_throttle_batches(spark, sf_dir):
    """The chunked operator on every micro-batch, kept times carried between them."""
    out = shared_dir(spark, "kept")

    def sink(kept, batch_id):
        kept.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = throttled.throttle_batches(sink, shared_dir(spark, "state"), **_GAPS)
    running = (
        reading_stream(spark, sf_dir)
        .writeStream.foreachBatch(writer)
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(out).select("event_id", "camera_id")


@query(
    "stream_enrich",
    f"""WITH {REGISTRY_SQL} SELECT e.event_id, m.camera_id, m.city, m.ward, m.risk_level
    FROM events e JOIN cameras m ON m.user_id = e.user_id""",
)
def stream_enrich(spark, sf_dir):
    stream = enrich.stream_enrich(reading_stream(spark, sf_dir), registry(spark, sf_dir))
    out, _ = drained(spark, stream)
    return out.select("event_id", "camera_id", "city", "ward", "risk_level")


@query(
    "tumbling_window",
    rollup_sql("1 day")
    + """SELECT window_start, camera_id, alert_count, max_risk_score, evidence_url FROM keyed
    WHERE window_start + INTERVAL '1 day'
      <= (SELECT max(event_time) - INTERVAL '10 minutes' FROM alerts)""",
)
def tumbling_window(spark, sf_dir):
    """Windows still open when the stream ends are withheld."""
    stream = enrich.stream_enrich(reading_stream(spark, sf_dir), registry(spark, sf_dir))
    out, _ = drained(spark, rollup.stream_rollup(stream, "1 day"))
    return out.select("window_start", "camera_id", "alert_count", "max_risk_score", "evidence_url")


def late_stream(spark, sf_dir):
    """Readings that arrive up to three days late, by a hash of their id."""
    delay = F.make_dt_interval(hours=F.pmod(F.xxhash64("event_id"), F.lit(73)).cast("int"))
    rows = readings(spark, sf_dir)
    arriving = rows.withColumn("arrival", F.col("event_time") + delay)
    path = ordered_files(spark, arriving, "arrival", lambda part, p: write_slice(part.drop("arrival"), p))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


@query(
    "tumbling_window_updates",
    rollup_sql("1 day")
    + "SELECT window_start, camera_id, alert_count, max_risk_score, evidence_url FROM keyed",
)
def tumbling_window_updates(spark, sf_dir):
    """Late rows change windows already written; all windows, open ones too."""
    stream = enrich.stream_enrich(late_stream(spark, sf_dir), registry(spark, sf_dir))
    path, checkpoint = shared_dir(spark, "windows"), shared_dir(spark, "checkpoint")
    running = rollup.start_updates(stream, path, checkpoint, "1 day", "4 days", {"availableNow": True})
    running.awaitTermination()
    windows = rollup.current_windows(spark, path)
    return windows.select("window_start", "camera_id", "alert_count", "max_risk_score", "evidence_url")
