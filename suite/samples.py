"""Metric operators on event values as samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.catalog import query
from suite.views import SAMPLES_SQL, samples, table
from tidewatch.functions import bands
from tidewatch.operators import series

_DAY_FRAME = "RANGE BETWEEN INTERVAL '86399.999999 seconds' PRECEDING AND CURRENT ROW"
_INCREASE_SQL = f"""WITH {SAMPLES_SQL}, previous AS (
  SELECT *, lag(value) OVER (PARTITION BY instance, series ORDER BY ts, value) AS p
  FROM samples WHERE {{keep}}
), increases AS (
  SELECT *, CASE WHEN value >= p THEN value - p WHEN value < p THEN value END AS increase
  FROM previous
)"""


@query(
    "counter_rate",
    _INCREASE_SQL.format(keep="true")
    + f""" SELECT event_id, series, ts, round(sum(increase) OVER (PARTITION BY series ORDER BY ts
      {_DAY_FRAME}) / 86400, 9) AS rate FROM increases""",
)
def counter_rate(spark, sf_dir):
    rates = series.counter_rate(samples(spark, sf_dir), width="1 day")
    return rates.select("event_id", "series", "ts", F.round("rate", 9).alias("rate"))


@query(
    "counter_rate_extrapolated",
    _INCREASE_SQL.format(keep="true")
    + f""", framed AS (
      SELECT event_id, series, ts, count(*) OVER w - 1 AS gaps, first_value(value) OVER w AS first,
        (epoch_us(ts) - first_value(epoch_us(ts)) OVER w) / 1000000.0 AS span,
        sum(coalesce(increase, 0)) OVER w - first_value(coalesce(increase, 0)) OVER w AS rise
      FROM increases WINDOW w AS (PARTITION BY series ORDER BY ts {_DAY_FRAME})
    ), started AS (
      SELECT *, CASE WHEN 86400 - span >= span / gaps * 1.1 THEN span / gaps / 2
        ELSE 86400 - span END AS to_start
      FROM framed WHERE gaps > 0
    )
    SELECT f.event_id, f.series, f.ts, round(s.rise * (s.span + CASE
        WHEN s.rise > 0 AND s.first >= 0 AND s.span * s.first / s.rise < s.to_start
        THEN s.span * s.first / s.rise ELSE s.to_start END) / s.span, 7) AS per_day
    FROM framed f LEFT JOIN started s ON s.event_id = f.event_id""",
)
def counter_rate_extrapolated(spark, sf_dir):
    rates = series.counter_rate(samples(spark, sf_dir), width="1 day", extrapolate=True)
    per_day = F.round(F.col("rate") * 86400, 7).alias("per_day")
    return rates.select("event_id", "series", "ts", per_day)


@query(
    "avg_over_time",
    f"""WITH {SAMPLES_SQL} SELECT event_id, series, ts,
      round(avg(value) OVER (PARTITION BY series ORDER BY ts {_DAY_FRAME}), 6) AS mean
    FROM samples""",
)
def avg_over_time(spark, sf_dir):
    means = series.avg_over_time(samples(spark, sf_dir), width="1 day")
    return means.select("event_id", "series", "ts", F.round("mean", 6).alias("mean"))


@query(
    "avg_by_instance",
    _INCREASE_SQL.format(keep="mode = 'idle'")
    + """, rates AS (
      SELECT time_bucket(INTERVAL '1 day', ts - INTERVAL '1 microsecond') + INTERVAL '1 day' AS at_time,
        instance, series, sum(increase) / 86400 AS rate FROM increases GROUP BY 1, 2, 3)
    SELECT at_time, instance, round(100 - avg(rate) * 100, 6) AS busy_percent
    FROM rates WHERE rate IS NOT NULL GROUP BY at_time, instance""",
)
def avg_by_instance(spark, sf_dir):
    busy = series.busy_by_instance(samples(spark, sf_dir), width="1 day", block="1 day")
    return busy.withColumn("busy_percent", F.round("busy_percent", 6))


@query(
    "gauge_latest",
    f"""WITH {SAMPLES_SQL} SELECT series, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS p FROM samples) q
    WHERE p = 1""",
)
def gauge_latest(spark, sf_dir):
    return series.gauge_latest(samples(spark, sf_dir))


@query(
    "gauge_avg",
    f"""WITH {SAMPLES_SQL} SELECT round(avg(value), 6) AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS p FROM samples) q
    WHERE p = 1""",
)
def gauge_avg(spark, sf_dir):
    mean = series.gauge_avg(samples(spark, sf_dir))
    return mean.select(F.round("value", 6).alias("value"))


@query(
    "threshold_band",
    """SELECT event_id,
      CASE WHEN value >= 30 THEN 'red' WHEN value >= 10 THEN 'orange' ELSE 'green' END AS delay,
      CASE WHEN value >= 80 THEN 'red' ELSE 'green' END AS panel,
      CASE WHEN value >= 512 THEN 'red' ELSE 'green' END AS memory,
      CASE WHEN event_id % 4 >= 2 THEN 'green' WHEN event_id % 4 >= 1 THEN 'orange'
        ELSE 'red' END AS workers
    FROM events""",
)
def threshold_band(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        bands.threshold_band("value", bands.DELAY_SECONDS).alias("delay"),
        bands.threshold_band("value", bands.ALERT_PANEL).alias("panel"),
        bands.threshold_band("value", bands.FREE_MEMORY_MB).alias("memory"),
        bands.threshold_band(F.col("event_id") % 4, bands.ALIVE_WORKERS).alias("workers"),
    )
