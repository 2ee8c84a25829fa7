"""Tables kept by date or by bucket, and trees of several layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.catalog import query
from suite.storage import _BRONZE_OUT, _BRONZE_SQL, _name, bronze_rows, slices
from suite.streams import message_stream
from suite.views import ALERTS_SQL, table
from tidewatch.operators import upserts
from tidewatch.session import shared_dir
from tidewatch.sources import trees
from tidewatch.streaming import bronze, dated


@query("stream_bronze_dated", "WITH " + ALERTS_SQL + _BRONZE_SQL)
def stream_bronze_dated(spark, sf_dir):
    """The bronze stream into date partitions; every second batch merges what is settled."""
    name = _name("dated")
    dated.create_dated_bronze(spark, name, shared_dir(spark, "dated"))
    running = bronze.start_bronze(
        message_stream(spark, sf_dir),
        name,
        shared_dir(spark, "checkpoint"),
        {"availableNow": True},
        writer=dated.dated_writer(name, merge_every=2, many_files=2),
    )
    running.awaitTermination()
    return spark.table(name).select(*_BRONZE_OUT)


@query(
    "sink_bronze_dated",
    "WITH "
    + ALERTS_SQL
    + " SELECT event_date, count(*) AS n, count(DISTINCT camera_id) AS cameras FROM alerts GROUP BY event_date",
)
def sink_bronze_dated(spark, sf_dir):
    """Five numbered batches, each written twice, then merged."""
    name = _name("dated")
    dated.create_dated_bronze(spark, name, shared_dir(spark, "dated"))
    for number, part in enumerate(slices(spark, sf_dir)):
        for again in (False, True):
            dated.append_batch(bronze_rows(part), name, number, again)
    dated.merge_settled(spark, name, 5, many_files=2)
    return spark.table(name).groupBy("event_date").agg(
        F.count("*").alias("n"), F.count_distinct("camera_id").alias("cameras")
    )


@query(
    "sink_vector_upsert_bucketed",
    """SELECT vec_id AS id, label, round(CAST(embedding[1] AS DOUBLE) * CASE WHEN label >= 5
        THEN -1 ELSE 1 END, 6) AS first, CASE WHEN label >= 5 THEN 2 ELSE 0 END AS version
      FROM embeddings
    UNION ALL SELECT vec_id + 1000000, label, round(CAST(embedding[1] AS DOUBLE), 6), 1
      FROM embeddings WHERE label >= 5""",
)
def sink_vector_upsert_bucketed(spark, sf_dir):
    """Three generations: all vectors, new ids beside a version that loses, and negated ones."""
    name, path = _name("vectors"), shared_dir(spark, "vectors")
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    again = vectors.where("label >= 5")
    added = again.withColumn("id", F.col("id") + 1000000).withColumn("version", F.lit(1))
    negated = again.withColumn("embedding", F.transform("embedding", lambda x: -x))
    late = again.withColumn("version", F.lit(1)).unionByName(negated.withColumn("version", F.lit(2)))
    for number, rows in enumerate((vectors.withColumn("version", F.lit(0)), added, late)):
        stored = upserts.upsert_bucketed(rows, name, number, path, buckets=8)
    first = F.col("embedding")[0].cast("double")
    return stored.select("id", "label", F.round(first, 6).alias("first"), "version")


@query(
    "src_parquet_layouts",
    """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN user_id END AS user_id,
      CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN event_type END AS event_type, ts
    FROM events""",
)
def src_parquet_layouts(spark, sf_dir):
    """Three layouts at several depths: columns that come and go, a number that gets wider."""
    root = shared_dir(spark, "layouts")
    rows = table(spark, sf_dir, "events")
    ts = F.col("ts")
    first, second = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-10", "2024-01-20"))
    early = rows.where(ts < first).select("event_id", F.col("user_id").cast("int").alias("user_id"), "ts")
    early.write.parquet(f"{root}/a/deep/er")
    middle = rows.where((ts >= first) & (ts < second))
    wider = middle.select("ts", "event_type", F.col("user_id").cast("long").alias("user_id"), "event_id")
    wider.write.parquet(f"{root}/a/other")
    rows.where(ts >= second).select("event_id", "event_type", "ts").write.parquet(f"{root}/b")
    read, _ = trees.read_layouts(spark, root)
    return read.select("event_id", "user_id", "event_type", "ts")
