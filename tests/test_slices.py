"""Slices of the test streams: several files each, batches in time order."""

from pyspark.sql import functions as F

from suite import streams
from suite.storage import SLICES


def test_batches_are_whole_slices_of_several_files(spark, tmp_path, monkeypatch):
    rows = None
    for n, since in enumerate(SLICES):
        start = F.lit(since).cast("timestamp").cast("long")
        step = 1 if n % 2 == 0 else 0  # every second slice has one time only
        part = spark.range(400).select((start + F.col("id") * step).cast("timestamp").alias("event_time"), "id")
        rows = part if rows is None else rows.union(part)
    monkeypatch.setattr(streams, "readings", lambda spark, sf_dir: rows)
    seen = {}

    def note(batch, number):
        times = batch.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high"), F.count("*").alias("n")).first()
        files = batch.select(F.col("_metadata.file_path").alias("f")).distinct().count()
        seen[number] = (times.low, times.high, times.n, files)

    stream = streams.reading_stream(spark, "").select("*", "_metadata")
    run = stream.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    run.awaitTermination()
    batches = [seen[number] for number in sorted(seen)]
    ranges = [(low, high) for low, high, n, _ in batches if n]
    assert sum(n for _, _, n, _ in batches) == rows.where(F.col("event_time") >= SLICES[0]).count()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(files for _, _, _, files in batches) == streams.FILES


def test_many_cameras_are_not_sent_to_the_driver(spark, tmp_path):
    """Each slice would send them again; rows and files of a slice stay as they are."""
    from pyspark.sql import functions as F

    from suite import streams, views

    customers = spark.range(300_000).select(
        F.col("id").alias("c_custkey"), F.md5(F.col("id").cast("string")).alias("c_name"),
        F.lit(1).alias("c_nationkey"), F.lit(0.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    )
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "N", 1)], views.LAYOUTS["nation"]).write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(1, "R")], views.LAYOUTS["region"]).write.parquet(f"{tmp_path}/region.parquet")
    events = spark.range(2000, numPartitions=40).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-02 00:00:00' AS ts", "id % 900 AS user_id",
        "'view' AS event_type", "1.0D AS value", "'{}' AS props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    rows = views.alerts(spark, str(tmp_path))
    assert "rightHint=(strategy=broadcast)" not in str(rows._jdf.queryExecution().analyzed())
    assert "ResolvedHint (strategy=broadcast)" not in str(rows._jdf.queryExecution().analyzed())
    assert rows.count() == 2000
    path = streams.ordered_files(
        spark, views.messages(spark, str(tmp_path)).repartition(60), "timestamp",
        lambda df, p: streams.alert_io.write_alert_json(df.coalesce(streams.MESSAGE_FILES), "text", options={"path": p}),
    )
    files = [f for f in spark.read.text(path).inputFiles()]
    assert len(files) <= streams.MESSAGE_FILES * 5
