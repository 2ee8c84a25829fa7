"""The test tables seen as alerts, cameras, samples and documents.

Each view exists twice: as a DataFrame for the operators and as a SQL ``WITH``
clause for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.joins import fits_broadcast

# In mid-month, so that there are events before and after every bound.
AS_OF = "2024-01-21 00:00:00"
WEEK_START = "2024-01-14 00:00:00"
DAY_START = "2024-01-20 00:00:00"

#: Cameras are broadcast up to this size of the customers' file. Their rows are some ten times
#: larger, and queries that write slices send them to the driver for every slice.
CAMERA_BYTES = 2 << 20


# Layouts of the test tables: a given schema spares the job that would infer it.
LAYOUTS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
    "labels": "doc_id long, quality int, toxic int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Events, bounded on the stored time so that the bounds reach the scan."""
    rows = table(spark, sf_dir, "events")
    if since:
        rows = rows.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        rows = rows.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return rows


def camera_of(number) -> F.Column:
    """At least four digits; ``lpad`` alone would cut longer numbers."""
    digits = number.cast("string")
    return F.concat(F.lit("cam"), F.when(number < 10000, F.lpad(digits, 4, "0")).otherwise(digits))


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry: one camera per customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    place = key % 32
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("user_id"),
            camera_of(key).alias("camera_id"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("district"),
            F.col("c_mktsegment").alias("ward"),
            F.concat(F.lit("street"), (key % 15).cast("string")).alias("street"),
            ((1077000 + place * 50).cast("double") / 100000).alias("latitude"),
            ((10669000 + place * 60).cast("double") / 100000).alias("longitude"),
            F.concat(F.lit("rtsp://host/cam"), key.cast("string")).alias("rtsp_url"),
            F.when(key % 16 < 4, "high").when(key % 16 < 12, "medium").otherwise("low").alias(
                "risk_level"
            ),
        )
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cameras(spark, sf_dir).drop("user_id")


def readings(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """What a camera reports, without the camera's attributes."""
    e = events(spark, sf_dir, since, until)
    violent = F.col("event_type") == "error"
    return e.select(
        "user_id",
        camera_of(F.col("user_id")).alias("camera_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        violent.alias("is_violent"),
        (F.col("value") / (F.col("value") + 50)).alias("score"),
        (F.col("event_id") % 30).cast("double").alias("fps"),
        F.get_json_object("props", "$.k").cast("double").alias("latency_ms"),
        F.when(violent, F.concat(F.lit("s3://evidence/"), F.col("event_id").cast("string"))).alias(
            "evidence_url"
        ),
        "event_id",
    )


def alerts(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Readings with the camera's attributes: the bronze rows."""
    place = cameras(spark, sf_dir).drop("camera_id")
    # Three joined tables look larger to the planner than they are; a camera is a
    # customer, so the size of that file decides.
    if fits_broadcast(table(spark, sf_dir, "customer"), CAMERA_BYTES):
        place = F.broadcast(place)
    return readings(spark, sf_dir, since, until).join(place, "user_id").drop("user_id")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts as message fields, with the preview that bronze drops."""
    return alerts(spark, sf_dir).select(
        "camera_id", "city", "district", "ward", "street", "latitude", "longitude",
        "rtsp_url", "risk_level",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_time").cast("string").alias("ai_timestamp"),
        "is_violent", "score", "fps", "latency_ms", "evidence_url",
        F.lit("preview").alias("image_preview"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON in many states: the events' alerts, events with one wrong field, and
    documents that are no JSON at all."""
    e = table(spark, sf_dir, "events")
    cam = F.concat(F.lit("cam"), F.col("user_id").cast("string"))
    body = (
        F.when(
            F.col("event_type") == "error",
            F.format_string(
                '{"camera_id": "%s", "score": "%s", "is_violent": true, "timestamp": "%s"}',
                cam, F.col("event_id").cast("string"), F.col("ts").cast("string"),
            ),
        )
        .when(F.col("event_type") == "view", F.format_string('{"camera_id": "%s", "fps": ', cam))
        .when(
            F.col("event_type") == "click",
            F.format_string(
                '{"Camera_ID": "%s", "fps": %s, "city": %s, "timestamp": "no time"}',
                cam, F.col("event_id").cast("string"), F.col("user_id").cast("string"),
            ),
        )
        .when(F.col("event_type") == "signup", F.lit(""))
        .otherwise(
            F.format_string(
                '{"camera_id": "%s", "latitude": %s, "image_preview": "x", "timestamp": "%s"}',
                cam, F.col("event_id").cast("string"), F.col("ts").cast("string"),
            )
        )
    )
    return e.select("event_id", body.cast("binary").alias("value"))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera status records with the fields that may be absent."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        "event_id",
        camera_of(F.col("user_id")).alias("camera_id"),
        F.when(kind == "error", "online")
        .when(kind == "view", "offline")
        .when(kind == "click", "error")
        .alias("status"),
        F.col("ts").cast("timestamp").cast("string").alias("timestamp"),
        F.when(kind == "error", True).when(kind == "signup", False).alias("is_violent"),
        F.when(kind != "signup", F.col("value")).alias("score"),
        F.when(F.col("value") < 50, F.col("value") / 2).alias("fight_prob"),
        F.when(kind != "purchase", (F.col("event_id") % 30).cast("double")).alias("fps"),
        F.when(kind != "error", F.get_json_object("props", "$.k").cast("double")).alias(
            "latency_ms"
        ),
        F.when(kind == "error", "preview").alias("image_preview"),
        F.when(kind == "error", F.lit("s3://evidence")).alias("evidence_url"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples: a series per user, grouped by ward as the instance."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return e.join(c, F.col("user_id") == F.col("c_custkey")).select(
        F.col("user_id").cast("string").alias("series"),
        F.col("c_mktsegment").alias("instance"),
        F.when(F.col("event_type") == "view", "user").otherwise("idle").alias("mode"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value"),
        "event_id",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as documents: label as camera, a day out of the id."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        "embedding",
        F.concat(F.lit("cam"), F.col("label").cast("string")).alias("camera_id"),
        F.concat(
            F.lit("2024-01-"), F.lpad((F.col("vec_id") % 5 + 1).cast("string"), 2, "0")
        ).alias("date"),
    )


def vector_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a question, with both filters, one or none by its label."""
    v = vectors(spark, sf_dir)
    label = F.substring("camera_id", 4, 9).cast("int")
    return v.select(
        F.col("id").alias("question_id"),
        "embedding",
        F.when(label % 4 != 0, F.col("camera_id")).alias("camera_id"),
        F.when(label % 4 > 1, F.col("date")).alias("date"),
    )


# The same views for the oracle. -------------------------------------------------

REGISTRY_SQL = """cameras AS (
  SELECT c.c_custkey AS user_id,
    concat('cam', lpad(CAST(c.c_custkey AS VARCHAR),
      CAST(greatest(4, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0')) AS camera_id,
    r.r_name AS city, n.n_name AS district, c.c_mktsegment AS ward,
    concat('street', CAST(c.c_custkey % 15 AS VARCHAR)) AS street,
    CAST(1077000 + (c.c_custkey % 32) * 50 AS DOUBLE) / 100000 AS latitude,
    CAST(10669000 + (c.c_custkey % 32) * 60 AS DOUBLE) / 100000 AS longitude,
    concat('rtsp://host/cam', CAST(c.c_custkey AS VARCHAR)) AS rtsp_url,
    CASE WHEN c.c_custkey % 16 < 4 THEN 'high' WHEN c.c_custkey % 16 < 12 THEN 'medium'
         ELSE 'low' END AS risk_level
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

ALERTS_SQL = REGISTRY_SQL + """, alerts AS (
  SELECT m.camera_id, m.city, m.district, m.ward, m.street, m.latitude, m.longitude,
    m.rtsp_url, m.risk_level, e.ts AS event_time, CAST(e.ts AS DATE) AS event_date,
    e.event_type = 'error' AS is_violent, e.value / (e.value + 50) AS score,
    CAST(e.event_id % 30 AS DOUBLE) AS fps,
    CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS latency_ms,
    CASE WHEN e.event_type = 'error'
         THEN concat('s3://evidence/', CAST(e.event_id AS VARCHAR)) END AS evidence_url,
    e.event_id
  FROM events e JOIN cameras m ON m.user_id = e.user_id
)"""


def rollup_sql(width: str = "5 minutes") -> str:
    """Rollup and keys; the argmax row is found by ordering, not by a struct."""
    return "WITH " + ALERTS_SQL + f""", ranked AS (
  SELECT *, time_bucket(INTERVAL '{width}', event_time) AS window_start,
    row_number() OVER (
      PARTITION BY time_bucket(INTERVAL '{width}', event_time), camera_id, city, district,
        ward, street, rtsp_url, risk_level
      ORDER BY score DESC NULLS LAST, evidence_url DESC NULLS LAST) AS place,
    row_number() OVER (
      PARTITION BY time_bucket(INTERVAL '{width}', event_time), camera_id, city, district,
        ward, street, rtsp_url, risk_level
      ORDER BY latitude IS NULL OR longitude IS NULL, latitude NULLS FIRST,
        longitude NULLS FIRST) AS first_place
  FROM alerts
), rollup AS (
  SELECT window_start, camera_id, city, district, ward, street, rtsp_url, risk_level,
    max(CASE WHEN first_place = 1 THEN latitude END) AS latitude,
    max(CASE WHEN first_place = 1 THEN longitude END) AS longitude,
    avg(latency_ms) AS avg_latency_ms, avg(fps) AS avg_fps,
    CAST(sum(CASE WHEN is_violent THEN 1 ELSE 0 END) AS BIGINT) AS alert_count,
    sum(CASE WHEN is_violent THEN 1 ELSE 0 END) > 0 AS is_violent_window,
    max(CASE WHEN place = 1 THEN score END) AS max_risk_score,
    max(CASE WHEN place = 1 THEN evidence_url END) AS evidence_url
  FROM ranked
  GROUP BY window_start, camera_id, city, district, ward, street, rtsp_url, risk_level
), keyed AS (
  SELECT *, CAST(strftime(window_start, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(strftime(window_start, '%Y%m%d%H%M') AS BIGINT) AS time_key,
    sha256(concat_ws('|', city, district, ward, street)) AS location_key,
    camera_id AS camera_key,
    sha256(concat_ws('-', camera_id, strftime(window_start, '%Y-%m-%d %H:%M:%S'))) AS fact_id
  FROM rollup
), locations AS (
  SELECT location_key, city, district, ward, street, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY location_key
      ORDER BY city, district, ward, street, latitude, longitude) AS p FROM keyed) q
  WHERE p = 1
)"""


STATUS_SQL = """statuses AS (
  SELECT event_id, concat('cam', lpad(CAST(user_id AS VARCHAR),
      CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS camera_id,
    CASE event_type WHEN 'error' THEN 'online' WHEN 'view' THEN 'offline'
      WHEN 'click' THEN 'error' END AS status,
    CAST(ts AS VARCHAR) AS timestamp,
    CASE event_type WHEN 'error' THEN true WHEN 'signup' THEN false END AS is_violent,
    CASE WHEN event_type <> 'signup' THEN value END AS score,
    CASE WHEN value < 50 THEN value / 2 END AS fight_prob,
    CASE WHEN event_type <> 'purchase' THEN CAST(event_id % 30 AS DOUBLE) END AS fps,
    CASE WHEN event_type <> 'error'
      THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS latency_ms,
    CASE WHEN event_type = 'error' THEN 'preview' END AS image_preview,
    CASE WHEN event_type = 'error' THEN 's3://evidence' END AS evidence_url
  FROM events
)"""

SAMPLES_SQL = """samples AS (
  SELECT CAST(e.user_id AS VARCHAR) AS series, c.c_mktsegment AS instance,
    CASE WHEN e.event_type = 'view' THEN 'user' ELSE 'idle' END AS mode,
    e.ts, e.value, e.event_id
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
)"""

VECTORS_SQL = """vectors AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS embedding,
    concat('cam', CAST(label AS VARCHAR)) AS camera_id,
    concat('2024-01-', lpad(CAST(vec_id % 5 + 1 AS VARCHAR), 2, '0')) AS date, label
  FROM embeddings
), vector_questions AS (
  SELECT id AS question_id, embedding,
    CASE WHEN label % 4 <> 0 THEN camera_id END AS camera_id,
    CASE WHEN label % 4 > 1 THEN date END AS date
  FROM vectors
)"""
