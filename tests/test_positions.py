"""Global positions."""

import random

from pyspark.sql import functions as F

from tidewatch.operators.positions import with_positions


def test_positions_follow_the_order(spark):
    rng = random.Random(5)
    rows = [(None if rng.random() < 0.1 else rng.randint(0, 5) if n % 3 else 2, n) for n in range(5000)]
    frame = spark.createDataFrame(rows, "k int, n int").repartition(7)
    got = with_positions(frame, [F.asc_nulls_last("k"), F.desc("n")]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -r[1]))
    assert [(r.k, r.n) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(5000))


def test_hot_key_is_dealt_over_tasks(spark):
    frame = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one partition
    try:
        placed = with_positions(frame, [F.asc("k"), F.asc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = placed.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 15_000
    assert placed.where("position <> id").count() == 0


def test_no_rows(spark):
    assert with_positions(spark.createDataFrame([], "k int"), [F.asc("k")]).count() == 0
