import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewatch.streaming import bronze, dated


def message(camera, day, minute=0, score=0.5):
    at = dt.datetime(2025, 1, day, 10, minute).isoformat() if day else "no time"
    return json.dumps({"camera_id": camera, "timestamp": at, "score": score, "is_violent": False})


def batch(spark, *messages):
    from tidewatch.operators import ingest

    return ingest.parse_alert_json(spark.createDataFrame([(m,) for m in messages], "value string"), keep_raw=True)


@pytest.fixture
def table(spark, tmp_path, name):
    dated.create_dated_bronze(spark, name, str(tmp_path / "bronze"))
    return name


def cameras(spark, table):
    return sorted(r.camera_id for r in spark.table(table).collect())


def files(spark, table):
    return {r.event_date: r.n for r in dated.files_of(spark.table(table)).groupBy("event_date").agg(F.count("*").alias("n")).collect()}


def test_many_batches_leave_a_partition_per_date(spark, table):
    write = dated.dated_writer(table, merge_every=1000)
    for n in range(60):
        write(batch(spark, message(f"c{n}", 1 + n % 3)).coalesce(1), n)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    assert cameras(spark, table) == sorted(f"c{n}" for n in range(60))
    assert set(files(spark, table).values()) == {20}


def test_a_batch_that_comes_again_adds_nothing(spark, table):
    write = dated.dated_writer(table)
    for n in range(3):
        write(batch(spark, message(f"c{n}", 1), message(f"d{n}", None)), n)
    before = cameras(spark, table)
    write(batch(spark, message("c2", 1), message("d2", None)), 2)
    # A writer of a new start does not know what the one before it wrote.
    dated.dated_writer(table)(batch(spark, message("c2", 1), message("d2", None)), 2)
    assert cameras(spark, table) == before == ["c0", "c1", "c2", "d0", "d1", "d2"]


def test_what_a_broken_batch_left_is_replaced(spark, table):
    write = dated.dated_writer(table)
    write(batch(spark, message("a", 1)), 0)
    from tidewatch.operators import ingest

    half = ingest.bronze_derive(batch(spark, message("b", 1)))
    dated.append_batch(half, table, 1)
    dated.dated_writer(table)(batch(spark, message("b", 1), message("c", 2)), 1)
    assert cameras(spark, table) == ["a", "b", "c"]


def test_a_writer_that_failed_takes_the_batch_again(spark, table, tmp_path, monkeypatch):
    write = dated.dated_writer(table, enforce=True, quarantine=str(tmp_path / "rejected"))
    write(batch(spark, message("a", 1)), 0)
    with monkeypatch.context() as broken:
        broken.setattr(dated.ingest, "quarantine_rows", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(batch(spark, message("b", 1)), 1)
    write(batch(spark, message("b", 1)), 1)
    assert cameras(spark, table) == ["a", "b"]


def test_settled_dates_are_merged_and_late_rows_stay(spark, table):
    write = dated.dated_writer(table, merge_every=1000)
    for n in range(10):
        write(batch(spark, message(f"c{n}", 1), message(f"x{n}", None)).coalesce(1), n)
    write(batch(spark, message("new", 2)), 10)
    assert dated.merge_settled(spark, table, 9) == []  # batch 9 may come again
    assert dated.merge_settled(spark, table, 10, many_files=11) == []
    assert dated.merge_settled(spark, table, 10) == [dt.date(2025, 1, 1)]
    counts = files(spark, table)
    assert counts[dt.date(2025, 1, 1)] == 1 and counts[None] == 10
    write(batch(spark, message("late", 1)), 11)
    assert cameras(spark, table) == sorted([f"c{n}" for n in range(10)] + [f"x{n}" for n in range(10)] + ["new", "late"])
    write(batch(spark, message("late", 1)), 11)
    assert cameras(spark, table).count("late") == 1
    with pytest.raises(ValueError, match="merged"):
        write(batch(spark, message("c3", 1)), 3)


def test_the_writer_merges_by_itself(spark, table):
    write = dated.dated_writer(table, merge_every=10, many_files=3)
    for n in range(20):
        write(batch(spark, message(f"c{n}", 1 + n // 10)).coalesce(1), n)
    # The date that batch 9 wrote to was not settled then; by batch 19 it is.
    assert files(spark, table)[dt.date(2025, 1, 1)] == 1
    assert cameras(spark, table) == sorted(f"c{n}" for n in range(20))


def test_empty_batches_and_rejected_rows(spark, table, tmp_path):
    told = []
    out = str(tmp_path / "rejected")
    write = dated.dated_writer(table, enforce=True, quarantine=out, on_batch=lambda *seen: told.append(seen))
    write(batch(spark, message("a", 1)).limit(0), 0)
    write(batch(spark, message("a", 1), message(None, 1), message("b", None)), 1)
    assert cameras(spark, table) == ["a"] and told == [(1, 1)]
    assert spark.read.json(out).count() == 2
    with pytest.raises(ValueError):
        dated.dated_writer(table, enforce=True)


def test_the_stream_takes_this_writer(spark, table, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(3):
        (source / f"{n}.txt").write_text("\n".join(message(f"c{n}{m}", 1 + m % 2) for m in range(4)))
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    running = bronze.start_bronze(
        stream, table, str(tmp_path / "check"), {"availableNow": True}, writer=dated.dated_writer(table)
    )
    running.awaitTermination()
    assert spark.table(table).count() == 12
    assert spark.table(table).select("batch_id").distinct().count() == 3
