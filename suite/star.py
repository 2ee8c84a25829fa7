"""Rollup, dimensions, fact and retrieval events."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.catalog import query, rounded
from suite.views import alerts, rollup_sql, table
from tidewatch import schemas
from tidewatch.operators import rollup, star
from tidewatch.plans import increments
from tidewatch.session import materialize, shared_dir

_ROLLUP_OUT = """SELECT window_start, camera_id, city, district, ward, street, rtsp_url,
  risk_level, latitude, longitude, round(avg_latency_ms, 6) AS avg_latency_ms,
  round(avg_fps, 6) AS avg_fps, alert_count, is_violent_window, max_risk_score, evidence_url
FROM rollup"""

_FACT_OUT = """SELECT fact_id, date_key, time_key, location_key, camera_key, window_start,
  round(avg_latency_ms, 6) AS avg_latency_ms, round(avg_fps, 6) AS avg_fps,
  is_violent_window, max_risk_score, alert_count, evidence_url
FROM keyed"""


def rollup_of(spark, sf_dir, width="5 minutes", since=None, until=None):
    return rollup.rollup_tumbling(alerts(spark, sf_dir, since, until), width)


def keyed_of(spark, sf_dir, width="5 minutes", since=None, until=None):
    """Keyed rollup; bounds have to lie on window edges and reach the event scan."""
    return star.with_keys(rollup_of(spark, sf_dir, width, since, until))


def fact_of(spark, sf_dir, width="5 minutes", since=None, until=None):
    return star.fact_rows(keyed_of(spark, sf_dir, width, since, until))


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark, sf_dir, width):
    """Folder of one gold run over all events, made once per session and width."""
    run = (spark.sparkContext.applicationId, sf_dir, width)
    if run not in _STORED:
        path = shared_dir(spark, "gold")
        keyed = materialize(keyed_of(spark, sf_dir, width), "keyed")
        fact = star.fact_rows(keyed).hint("rebalance", "date_key")
        fact.write.partitionBy("date_key").parquet(f"{path}/fact")
        for name, every in (("places", False), ("variants", True)):
            star.location_rows(keyed, every).write.parquet(f"{path}/{name}")
        star.camera_rows(keyed).write.parquet(f"{path}/cameras")
        _STORED[run] = path
    return _STORED[run]


def stored_fact(spark, sf_dir, width="5 minutes"):
    """The fact table as dashboards find it: stored, all of it, by date."""
    return spark.read.schema(schemas.FACT).parquet(f"{_stored(spark, sf_dir, width)}/fact")


def stored_places(spark, sf_dir, every_variant=False):
    name = "variants" if every_variant else "places"
    path = f"{_stored(spark, sf_dir, '5 minutes')}/{name}"
    return spark.read.schema(schemas.DIM_LOCATION).parquet(path)


def stored_cameras(spark, sf_dir):
    path = f"{_stored(spark, sf_dir, '5 minutes')}/cameras"
    return spark.read.schema(schemas.DIM_CAMERA).parquet(path)


def _rollup_out(df):
    exact = [c for c in df.columns if not c.startswith("avg_") and c != "window_end"]
    return df.select(*exact, *rounded("avg_latency_ms", "avg_fps"))


def _fact_out(df):
    exact = [c for c in df.columns if not c.startswith("avg_")]
    return df.select(*exact, *rounded("avg_latency_ms", "avg_fps"))


@query("rollup_tumbling", rollup_sql() + _ROLLUP_OUT)
def rollup_5m(spark, sf_dir):
    return _rollup_out(rollup_of(spark, sf_dir))


@query("rollup_tumbling_1d", rollup_sql("1 day") + _ROLLUP_OUT)
def rollup_1d(spark, sf_dir):
    return _rollup_out(rollup_of(spark, sf_dir, "1 day"))


@query("fact_build", rollup_sql() + _FACT_OUT)
def fact_5m(spark, sf_dir):
    return _fact_out(fact_of(spark, sf_dir))


@query("fact_build_1d", rollup_sql("1 day") + _FACT_OUT)
def fact_1d(spark, sf_dir):
    return _fact_out(fact_of(spark, sf_dir, "1 day"))


@query(
    "fact_full_grain_id",
    rollup_sql("1 day")
    + """SELECT sha256(concat_ws('-', camera_id, city, district, ward, street, rtsp_url,
      risk_level, strftime(window_start, '%Y-%m-%d %H:%M:%S'))) AS fact_id, alert_count
    FROM rollup""",
)
def fact_full_grain(spark, sf_dir):
    keyed = star.with_keys(rollup_of(spark, sf_dir, "1 day"), full_grain_id=True)
    return keyed.select("fact_id", "alert_count")


@query(
    "agg_first",
    rollup_sql("1 day") + "SELECT window_start, camera_id, latitude, longitude FROM rollup",
)
def agg_first(spark, sf_dir):
    return rollup_of(spark, sf_dir, "1 day").select(
        "window_start", "camera_id", "latitude", "longitude"
    )


@query(
    "agg_avg",
    rollup_sql("1 day")
    + """SELECT window_start, camera_id, round(avg_latency_ms, 6) AS avg_latency_ms,
      round(avg_fps, 6) AS avg_fps FROM rollup""",
)
def agg_avg(spark, sf_dir):
    return rollup_of(spark, sf_dir, "1 day").select(
        "window_start", "camera_id", *rounded("avg_latency_ms", "avg_fps")
    )


@query(
    "agg_conditional_sum",
    """SELECT user_id, CAST(sum(CASE WHEN flag THEN 1 ELSE 0 END) AS BIGINT) AS alert_count
    FROM (SELECT user_id, CASE WHEN event_type = 'error' THEN true
      WHEN event_type = 'view' THEN false END AS flag FROM events) e GROUP BY user_id""",
)
def agg_conditional_sum(spark, sf_dir):
    kind = F.col("event_type")
    flagged = table(spark, sf_dir, "events").withColumn(
        "is_violent", F.when(kind == "error", True).when(kind == "view", False)
    )
    return flagged.groupBy("user_id").agg(rollup.violent_count().alias("alert_count"))


@query(
    "agg_argmax_struct",
    """SELECT user_id, score, evidence_url FROM (
      SELECT user_id, score, evidence_url, row_number() OVER (PARTITION BY user_id
        ORDER BY score DESC NULLS LAST, evidence_url DESC NULLS LAST) AS p
      FROM (SELECT user_id, CASE WHEN event_type <> 'view' THEN floor(value / 40) END AS score,
          CASE WHEN event_type <> 'click' THEN CAST(event_id AS VARCHAR) END AS evidence_url
        FROM events) e) q
    WHERE p = 1""",
)
def agg_argmax_struct(spark, sf_dir):
    """Coarse scores make ties, and both columns have NULLs."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        F.when(kind != "view", F.floor(F.col("value") / 40).cast("double")).alias("score"),
        F.when(kind != "click", F.col("event_id").cast("string")).alias("evidence_url"),
    )
    best = rows.groupBy("user_id").agg(rollup.riskiest().alias("best"))
    return best.select("user_id", "best.score", "best.evidence_url")


@query(
    "window_flag",
    rollup_sql("1 day")
    + "SELECT window_start, camera_id, alert_count > 0 AS is_violent_window FROM rollup",
)
def window_flag(spark, sf_dir):
    return rollup_of(spark, sf_dir, "1 day").select(
        "window_start", "camera_id", "is_violent_window"
    )


@query(
    "project_star_plus",
    rollup_sql()
    + """SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, camera_id, street,
      alert_count, is_violent_window, max_risk_score, evidence_url, date_key, time_key,
      location_key, camera_key FROM keyed""",
)
def project_star_plus(spark, sf_dir):
    return keyed_of(spark, sf_dir).drop(
        "fact_id", "city", "district", "ward", "rtsp_url", "risk_level", "latitude",
        "longitude", "avg_latency_ms", "avg_fps",
    )


# Dimensions: a first run has stored what occurred on the first day. ---------------

_FIRST_DAY = "2024-01-02 00:00:00"


def _new_sql(layout: str, source: str, key: str) -> str:
    names = ", ".join(schemas.columns(layout))
    return rollup_sql() + f""", rows_of AS ({source})
    SELECT {names} FROM rows_of WHERE {key} NOT IN (
      SELECT {key} FROM keyed WHERE window_start < TIMESTAMP '{_FIRST_DAY}')"""


_TIME_SQL = """SELECT DISTINCT time_key, date_key,
  CAST(hour(window_start) AS INTEGER) AS hour, CAST(minute(window_start) AS INTEGER) AS minute
  FROM keyed"""
_CAMERA_SQL = """SELECT camera_key, camera_id, rtsp_url, risk_level FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_key
    ORDER BY camera_id, rtsp_url, risk_level) AS p FROM keyed) q WHERE p = 1"""


@query("dim_time_new", _new_sql(schemas.DIM_TIME, _TIME_SQL, "time_key"))
def dim_time_new(spark, sf_dir):
    stored = star.time_rows(keyed_of(spark, sf_dir, until=_FIRST_DAY))
    return star.new_rows(star.time_rows(keyed_of(spark, sf_dir)), stored, "time_key")


@query(
    "dim_location_new", _new_sql(schemas.DIM_LOCATION, "SELECT * FROM locations", "location_key")
)
def dim_location_new(spark, sf_dir):
    stored = star.location_rows(keyed_of(spark, sf_dir, until=_FIRST_DAY))
    return star.new_rows(star.location_rows(keyed_of(spark, sf_dir)), stored, "location_key")


@query("dim_camera_new", _new_sql(schemas.DIM_CAMERA, _CAMERA_SQL, "camera_key"))
def dim_camera_new(spark, sf_dir):
    stored = star.camera_rows(keyed_of(spark, sf_dir, until=_FIRST_DAY))
    return star.new_rows(star.camera_rows(keyed_of(spark, sf_dir)), stored, "camera_key")


@query(
    "distinct_dim_rows",
    rollup_sql()
    + """SELECT DISTINCT location_key, city, district, ward, street, latitude, longitude
    FROM keyed""",
)
def distinct_dim_rows(spark, sf_dir):
    return star.location_rows(keyed_of(spark, sf_dir), every_variant=True)


@query(
    "filter_violent_windows",
    rollup_sql("1 day") + "SELECT fact_id, alert_count FROM keyed WHERE is_violent_window",
)
def filter_violent_windows(spark, sf_dir):
    return star.violent_windows(fact_of(spark, sf_dir, "1 day")).select("fact_id", "alert_count")


@query(
    "project_rag_events",
    rollup_sql()
    + """SELECT fact_id AS event_id, window_start AS timestamp_utc, camera_id, city, district,
      ward, street, max_risk_score AS score, 'VIOLENCE' AS label,
      strftime(window_start, '%Y-%m-%d') AS date
    FROM keyed WHERE is_violent_window""",
)
def project_rag_events(spark, sf_dir):
    return star.retrieval_events(keyed_of(spark, sf_dir))


#: The rollup of all alerts that were not withdrawn.
_KEPT_SQL = rollup_sql().replace("  FROM alerts\n), rollup", "  FROM alerts WHERE NOT (is_violent AND score < 0.2)\n), rollup")
MIDDLE = "2024-01-16 00:00:00"


def incremental_states(spark, sf_dir):
    """Two batches in time order, then all violent alerts, late, then withdrawals, compacted up to the middle."""
    path, bronze = shared_dir(spark, "rollup-states"), materialize(alerts(spark, sf_dir), "bronze")
    calm = bronze.where("NOT is_violent")
    increments.add_rows(calm.where(F.col("event_time") < MIDDLE), path, 0)
    increments.add_rows(calm.where(F.col("event_time") >= MIDDLE), path, 1)
    increments.add_rows(bronze.where("is_violent"), path, 2)
    increments.add_rows(bronze.where("is_violent"), path, 2)  # a batch that runs again
    gone = bronze.where("is_violent AND score < 0.2").select("camera_id", "event_time")
    increments.withdraw(bronze, gone, path, 3)
    increments.compact(spark, path, 4, MIDDLE[:10])
    return path


@query("rollup_incremental", _KEPT_SQL + _ROLLUP_OUT)
def rollup_incremental(spark, sf_dir):
    return _rollup_out(increments.current_rollup(spark, incremental_states(spark, sf_dir)))


@query("fact_incremental", _KEPT_SQL + _FACT_OUT)
def fact_incremental(spark, sf_dir):
    windows = increments.current_rollup(spark, incremental_states(spark, sf_dir))
    return _fact_out(star.fact_rows(star.with_keys(windows)))
