import pytest
from pyspark.sql import functions as F

from tidewatch.operators import blooms
from tidewatch.operators.dedupe import id_difference


def ids(spark, numbers, name="event_id"):
    return spark.createDataFrame([(None if n is None else f"e{n}", n) for n in numbers], f"{name} string, _segment long")


def rows(df):
    return sorted(df.collect(), key=repr)


def test_only_suspects_are_left_to_the_join(spark, tmp_path):
    """20,000 candidates, a tenth of them known: hardly more than those, and their ids, are shuffled."""
    path = str(tmp_path / "filter")
    known = spark.range(20_000).select(F.concat(F.lit("e"), "id").alias("event_id"))
    candidates = spark.range(18_000, 38_000).select(F.concat(F.lit("e"), "id").alias("event_id"), "id")
    blooms.append_filter(known.where("event_id < 'e5'"), "event_id", path, 0, 64)
    blooms.append_filter(known.where("event_id >= 'e5'"), "event_id", path, 1, 64)
    blooms.append_filter(known.where("event_id >= 'e5'"), "event_id", path, 1, 64)  # comes again
    stored = blooms.stored_filter(spark, path)
    assert stored.count() <= 2 * 64 * blooms.WORDS
    new, unsure, near = blooms.suspects(candidates, known, "event_id", stored, 64)
    assert 2000 <= unsure.count() <= 2100 and 2000 <= near.count() <= 2100
    got = blooms.new_rows(candidates, known, "event_id", stored, 64)
    assert rows(got) == rows(id_difference(candidates, known, "event_id")) and got.count() == 18_000


@pytest.mark.parametrize("known, candidates", [
    ([], []), ([], [1, 1, None]), ([1, 2], []), ([1, 1, None], [1, 2, 2, None, None]), (range(50), range(50)),
])
def test_small_cases(spark, known, candidates):
    """Empty tables, repeated and NULL ids, and a column of a name used inside."""
    stored, asked = ids(spark, known), ids(spark, candidates)
    got = blooms.new_rows(asked.withColumnRenamed("_segment", "n"), stored, "event_id", blooms.id_filter(stored, "event_id", 2), 2)
    want = id_difference(asked.withColumnRenamed("_segment", "n"), stored, "event_id")
    assert rows(got) == rows(want)


def test_an_overfull_filter_stays_right(spark):
    """One segment for 40,000 ids: everything is suspect, nothing is lost."""
    known = spark.range(40_000).select("id")
    candidates = spark.range(39_000, 41_000).select("id")
    got = blooms.new_rows(candidates, known, "id", blooms.id_filter(known, "id", 1), 1)
    assert {r.id for r in got.collect()} == set(range(40_000, 41_000))


def test_no_known_id_is_denied(spark):
    known = spark.range(5_000).select("id")
    marked = blooms.flagged(known, "id", blooms.id_filter(known, "id", 8), 8)
    assert marked.where("_maybe").count() == 5_000
