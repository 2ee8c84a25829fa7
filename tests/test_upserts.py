import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewatch.operators import upserts
from tidewatch.operators.dedupe import union_upsert

LAYOUT = "id long, version int, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "version", "text").collect()), key=str)


def test_the_stored_side_is_not_shuffled(spark, tmp_path, name):
    first = spark.range(1000).selectExpr("id", "0 AS version", "concat('t', id) AS text")
    upserts.upsert_bucketed(first, name, 0, str(tmp_path), buckets=5)
    incoming = spark.range(990, 1010).selectExpr("id", "1 AS version", "concat('u', id) AS text")
    merged = upserts.merged_by_key(spark.table(name), incoming, "id", "version")
    assert merged.count() == 1010
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Bucketed: true" in plan
    assert plan.count("Range (990, 1010") == 1
    # No exchange stands between the join and the stored scan.
    depth = lambda line: len(re.match(r"[\s:+|-]*", line)[0])
    lines = plan.splitlines()
    scan = next(n for n, line in enumerate(lines) if "FileScan" in line)
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    join = next(n for n, line in enumerate(above) if "Join" in line)
    assert not any("Exchange" in line for line in above[:join])


def test_generations_are_shown_once_and_old_ones_go(spark, tmp_path, name):
    for n in range(4):
        made = spark.createDataFrame([(1, n, f"t{n}"), (10 + n, n, "x")], LAYOUT)
        upserts.upsert_bucketed(made, name, n, str(tmp_path), buckets=2)
    again = spark.createDataFrame([(1, 9, "not again")], LAYOUT)
    shown = upserts.upsert_bucketed(again, name, 3, str(tmp_path), buckets=2)
    assert rows_of(shown) == [(1, 3, "t3"), (10, 0, "x"), (11, 1, "x"), (12, 2, "x"), (13, 3, "x")]
    assert upserts.generation_of(spark, name) == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["generation=2", "generation=3"]


def test_a_generation_that_broke_off_is_written_anew(spark, tmp_path, name):
    upserts.upsert_bucketed(spark.createDataFrame([(1, 0, "a")], LAYOUT), name, 0, str(tmp_path), buckets=2)
    half = spark.createDataFrame([(7, 7, "half")], LAYOUT)
    half.write.mode("overwrite").parquet(str(tmp_path / "generation=1"))
    shown = upserts.upsert_bucketed(
        spark.createDataFrame([(2, 1, "b")], LAYOUT), name, 1, str(tmp_path), buckets=2
    )
    assert rows_of(shown) == [(1, 0, "a"), (2, 1, "b")]


def test_columns_of_one_side_and_null_keys(spark):
    stored = spark.createDataFrame([(1, 0, "a"), (None, 0, "n")], LAYOUT)
    incoming = spark.createDataFrame(
        [(1, 1, "extra"), (2, 1, None), (None, 1, "e1"), (None, 2, "e2")], "id int, version int, more string"
    )
    got = upserts.merged_by_key(stored, incoming, "id", "version")
    assert got.columns == ["id", "version", "text", "more"] and got.schema["id"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, 1, None, "extra"), (2, 1, None, None), (None, 0, "n", None), (None, 2, None, "e2"),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sets(st.integers(0, 12), max_size=8),
    st.dictionaries(st.tuples(st.integers(0, 12), st.integers(1, 3)), st.sampled_from("abc"), max_size=12),
)
def test_equals_the_plain_upsert(spark, stored, incoming):
    old = spark.createDataFrame([(i, 0, "old") for i in stored], LAYOUT)
    new = spark.createDataFrame([(i, v, t) for (i, v), t in incoming.items()], LAYOUT)
    assert rows_of(upserts.merged_by_key(old, new, "id", "version")) == rows_of(union_upsert(old, new))
