import pytest
from pyspark.sql import functions as F

from tidewatch.sources import trees


def plain(rows, *names):
    return sorted(map(tuple, rows.select(*names).collect()), key=str)


@pytest.fixture
def tree(spark, tmp_path):
    root = tmp_path / "a tree"
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").coalesce(1).write.parquet(str(root / "x" / "y"))
    spark.createDataFrame([(3, 1.5)], "id long, score double").coalesce(1).write.parquet(str(root / "z"))
    spark.createDataFrame([], "id int, name string").coalesce(1).write.parquet(str(root / "none"))
    (root / "bad.parquet").write_bytes(b"no parquet at all")
    (root / "short.parquet.gz").write_bytes(b"")
    (root / "notes.txt").write_text("text")
    return str(root)


def test_layouts_are_read_together_and_files_told_apart(spark, tree):
    rows, left_out = trees.read_layouts(spark, tree)
    assert dict(rows.dtypes) == {"id": "bigint", "name": "string", "score": "double"}
    assert plain(rows, "id", "name", "score") == [(1, "a", None), (2, "b", None), (3, None, 1.5)]
    found = {r.path.rsplit("/", 1)[1]: r for r in left_out.collect()}
    assert found["bad.parquet"].error and found["bad.parquet"].rows is None
    assert found["short.parquet.gz"].error and found["short.parquet.gz"].bytes == 0
    empty = [r for r in found.values() if r.rows == 0]
    assert len(empty) == 1 and "/none/" in empty[0].path and empty[0].error is None
    assert len(found) == 3


def test_types_that_do_not_meet_are_text(spark, tmp_path):
    spark.createDataFrame([(1, "2025-01-01")], "v int, d string").coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("x",)], "V string").coalesce(1).write.parquet(str(tmp_path / "b"))
    spark.sql("SELECT true AS v, DATE'2025-01-02' AS d").write.parquet(str(tmp_path / "c"))
    rows, left_out = trees.read_layouts(spark, str(tmp_path))
    assert plain(rows, "v", "d") == [("1", "2025-01-01"), ("true", "2025-01-02"), ("x", None)]
    assert left_out.count() == 0


def test_names_with_dots_and_nested_columns(spark, tmp_path):
    spark.sql("SELECT 1 AS `a.b`, named_struct('x', 1) AS s").write.parquet(str(tmp_path / "a"))
    spark.sql("SELECT 'q' AS `a.b`, named_struct('x', 1, 'y', 2) AS s").write.parquet(str(tmp_path / "b"))
    rows, _ = trees.read_layouts(spark, str(tmp_path))
    got = rows.select(F.col("`a.b`").alias("n"), F.col("s.x").alias("x"), F.col("s.y").alias("y"))
    assert plain(got, "n", "x", "y") == [("1", 1, None), ("q", 1, 2)]


def test_a_schema_fixes_the_columns(spark, tree, tmp_path):
    rows, _ = trees.read_layouts(spark, tree, "id int, score float, more string")
    assert rows.dtypes == [("id", "int"), ("score", "float"), ("more", "string")]
    assert plain(rows, "id", "score", "more") == [(1, None, None), (2, None, None), (3, 1.5, None)]
    hollow = tmp_path / "hollow"
    hollow.mkdir()
    (hollow / "bad.parquet").write_bytes(b"PAR1")
    rows, left_out = trees.read_layouts(spark, str(hollow), "id int")
    assert rows.count() == 0 and rows.columns == ["id"] and left_out.count() == 1
    with pytest.raises(ValueError, match="no readable rows"):
        trees.read_layouts(spark, str(hollow))


def test_filters_reach_every_scan(spark, tree):
    rows, _ = trees.read_layouts(spark, tree)
    plan = rows.where("id > 2").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(id), GreaterThan(id,2") == 2
    assert "ReadSchema: struct<id:int>" in plan and "ReadSchema: struct<id:bigint>" in plan
