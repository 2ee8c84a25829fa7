"""Dashboard panels on the stored tables of a gold run."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from suite.catalog import query
from suite.star import stored_cameras, stored_fact, stored_places
from suite.views import ALERTS_SQL, AS_OF, DAY_START, WEEK_START, alerts, rollup_sql
from tidewatch.operators import dashboard

_WEEK = f"TIMESTAMP '{WEEK_START}'"
_RANGE = f"window_start BETWEEN {_WEEK} AND TIMESTAMP '{AS_OF}'"
_JOINED = "keyed f JOIN locations l ON f.location_key = l.location_key"


@query(
    "filter_last_24h",
    rollup_sql() + f"SELECT fact_id, window_start FROM keyed WHERE window_start >= TIMESTAMP '{DAY_START}'",
)
def filter_last_24h(spark, sf_dir):
    fact = stored_fact(spark, sf_dir)
    return dashboard.last_24h(fact, AS_OF).select("fact_id", "window_start")


@query(
    "filter_last_7d",
    rollup_sql() + f"SELECT fact_id, window_start FROM keyed WHERE window_start >= {_WEEK}",
)
def filter_last_7d(spark, sf_dir):
    return dashboard.last_7d(stored_fact(spark, sf_dir), AS_OF).select("fact_id", "window_start")


@query(
    "filter_time_range",
    rollup_sql() + f"SELECT fact_id, window_start FROM keyed WHERE {_RANGE}",
)
def filter_time_range(spark, sf_dir):
    fact = stored_fact(spark, sf_dir)
    return dashboard.in_range(fact, WEEK_START, AS_OF).select("fact_id", "window_start")


@query(
    "filter_camera_multi",
    rollup_sql()
    + """SELECT fact_id, camera_key FROM keyed
    WHERE camera_key IN ('cam0001', 'cam0007', 'cam0042')""",
)
def filter_camera_multi(spark, sf_dir):
    chosen = ["cam0001", "cam0007", "cam0042"]
    return dashboard.for_cameras(stored_fact(spark, sf_dir), chosen).select("fact_id", "camera_key")


@query(
    "kpi_count_24h",
    rollup_sql()
    + f"""SELECT count(*) AS value FROM keyed
    WHERE is_violent_window AND window_start >= TIMESTAMP '{DAY_START}'""",
)
def kpi_count_24h(spark, sf_dir):
    fact = stored_fact(spark, sf_dir)
    return dashboard.violent_count_since(fact, AS_OF, "24 HOURS")


@query(
    "kpi_count_7d",
    rollup_sql()
    + f"SELECT count(*) AS value FROM keyed WHERE is_violent_window AND window_start >= {_WEEK}",
)
def kpi_count_7d(spark, sf_dir):
    return dashboard.violent_count_since(stored_fact(spark, sf_dir), AS_OF, "7 DAYS")


@query(
    "kpi_avg_latency_7d",
    rollup_sql()
    + f"""SELECT round(avg(avg_latency_ms), 6) AS value FROM keyed
    WHERE window_start >= {_WEEK}""",
)
def kpi_avg_latency_7d(spark, sf_dir):
    mean = dashboard.average_latency(stored_fact(spark, sf_dir), AS_OF)
    return mean.select(F.round("value", 6).alias("value"))


@query(
    "risk_trend_series",
    rollup_sql()
    + f"""SELECT window_start AS time, fact_id, round(max_risk_score * 100, 6) AS risk
    FROM keyed WHERE is_violent_window AND {_RANGE}""",
)
def risk_trend_series(spark, sf_dir):
    trend = dashboard.risk_trend(stored_fact(spark, sf_dir), WEEK_START, AS_OF)
    return trend.withColumn("risk", F.round("risk", 6))


@query(
    "sort_time_asc",
    rollup_sql("1 day")
    + """SELECT window_start AS time, fact_id,
      row_number() OVER (ORDER BY window_start, fact_id) AS position
    FROM keyed WHERE is_violent_window
      AND window_start BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '"""
    + AS_OF
    + "'",
)
def sort_time_asc(spark, sf_dir):
    trend = dashboard.risk_trend(stored_fact(spark, sf_dir, "1 day"), "2024-01-01", AS_OF)
    return dashboard.order_rank(trend.select("time", "fact_id"), "time", "fact_id")


@query(
    "fact_join_location",
    rollup_sql()
    + f"SELECT f.fact_id, f.window_start, l.ward, l.street, l.latitude, l.longitude FROM {_JOINED}",
)
def fact_join_location(spark, sf_dir):
    joined = dashboard.join_location(stored_fact(spark, sf_dir), stored_places(spark, sf_dir))
    return joined.select("fact_id", "window_start", "ward", "street", "latitude", "longitude")


@query(
    "hotspot_by_point",
    rollup_sql()
    + f"""SELECT min(f.window_start) AS time, l.latitude, l.longitude, count(*) AS value
    FROM {_JOINED} WHERE f.is_violent_window AND f.{_RANGE}
    GROUP BY l.latitude, l.longitude""",
)
def hotspot_by_point(spark, sf_dir):
    return dashboard.hotspots(
        stored_fact(spark, sf_dir), stored_places(spark, sf_dir), WEEK_START, AS_OF
    )


_WARDS_SQL = f"""SELECT l.ward, CAST(count(*) AS BIGINT) AS total_events FROM {_JOINED}
    WHERE f.is_violent_window AND f.window_start >= {_WEEK} GROUP BY l.ward"""


@query("rank_wards", rollup_sql() + _WARDS_SQL)
def rank_wards(spark, sf_dir):
    return dashboard.rank_wards(stored_fact(spark, sf_dir), stored_places(spark, sf_dir), AS_OF)


@query(
    "rank_wards_every_variant",
    rollup_sql()
    + f""", variants AS (
      SELECT DISTINCT location_key, city, district, ward, street, latitude, longitude FROM keyed)
    SELECT l.ward, CAST(count(*) AS BIGINT) AS total_events
    FROM keyed f JOIN variants l ON f.location_key = l.location_key
    WHERE f.is_violent_window AND f.window_start >= {_WEEK} GROUP BY l.ward""",
)
def rank_wards_every_variant(spark, sf_dir):
    """The reading in which a place with two coordinates counts twice."""
    places = stored_places(spark, sf_dir, every_variant=True)
    return dashboard.rank_wards(stored_fact(spark, sf_dir), places, AS_OF)


@query(
    "sort_count_desc",
    rollup_sql()
    + f"""SELECT ward, total_events,
      CAST(row_number() OVER (ORDER BY total_events DESC, ward) AS INTEGER) AS position
    FROM ({_WARDS_SQL}) w""",
)
def sort_count_desc(spark, sf_dir):
    """One row per ward is left to be numbered."""
    most_first = Window.orderBy(F.desc("total_events"), "ward")
    return rank_wards(spark, sf_dir).withColumn("position", F.row_number().over(most_first))


@query(
    "distinct_cameras",
    rollup_sql() + "SELECT DISTINCT camera_id FROM keyed",
)
def distinct_cameras(spark, sf_dir):
    return dashboard.distinct_cameras(stored_cameras(spark, sf_dir))


@query(
    "sort_camera",
    rollup_sql()
    + """SELECT camera_id, row_number() OVER (ORDER BY camera_id) AS position
    FROM (SELECT DISTINCT camera_id FROM keyed) c""",
)
def sort_camera(spark, sf_dir):
    """Numbered by ranges of ids, so no task sees all cameras."""
    return dashboard.order_rank(distinct_cameras(spark, sf_dir), "camera_id", "camera_id")


@query(
    "daily_trend",
    rollup_sql()
    + f"""SELECT date_key, count(*) AS violent_windows FROM keyed
    WHERE is_violent_window AND window_start >= {_WEEK} GROUP BY date_key""",
)
def daily_trend(spark, sf_dir):
    return dashboard.daily_trend(stored_fact(spark, sf_dir), AS_OF)


@query(
    "incident_answer",
    rollup_sql()
    + f"""SELECT l.ward, count(*) OVER (PARTITION BY l.ward) AS ward_total,
      count(*) OVER () AS day_total, f.window_start, l.street, f.camera_key, f.fact_id
    FROM {_JOINED} WHERE f.is_violent_window
      AND f.window_start >= TIMESTAMP '{DAY_START}' AND f.window_start < TIMESTAMP '{AS_OF}'""",
)
def incident_answer(spark, sf_dir):
    fact = stored_fact(spark, sf_dir)
    return dashboard.incidents_of_day(fact, stored_places(spark, sf_dir), DAY_START[:10])


@query(
    "bronze_viewer",
    f"""WITH {ALERTS_SQL} SELECT event_time, camera_id, score, evidence_url FROM alerts
    WHERE CAST(event_time AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'
    ORDER BY event_time DESC, camera_id, score, evidence_url NULLS FIRST LIMIT 100""",
)
def bronze_viewer(spark, sf_dir):
    return dashboard.newest_alerts(alerts(spark, sf_dir), "2024-01-14", "2024-01-20")
