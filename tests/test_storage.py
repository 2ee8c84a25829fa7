import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.lake import commits
from tidewatch.operators import dedupe
from tidewatch.session import materialize, shared_dir
from tidewatch.sources import registry, tables

LAYOUT = "n long, day string"


@pytest.fixture
def lake(spark, tmp_path, name):
    commits.create(spark, name, LAYOUT, ["day"], str(tmp_path / name))
    return name


def rows(spark, *numbers, day="d1"):
    return spark.createDataFrame([(n, day) for n in numbers], LAYOUT)


def numbers(df):
    return sorted(r.n for r in df.collect())


def test_commits_add_up_and_can_be_travelled(spark, lake):
    t0 = dt.datetime(2025, 1, 1)
    assert commits.current(spark, lake).count() == 0
    for c in range(4):
        assert commits.commit(rows(spark, c, day=f"d{c % 2}"), lake, c, t0 + dt.timedelta(hours=c)) == 1
    assert numbers(commits.current(spark, lake)) == [0, 1, 2, 3]
    assert numbers(commits.as_of(spark, lake, "2025-01-01 01:00:00")) == [0, 1]
    assert numbers(commits.as_of(spark, lake, "2025-01-01 01:59:59")) == [0, 1]
    assert numbers(commits.as_of(spark, lake, "2024-12-31 00:00:00")) == []
    assert numbers(commits.version(spark, lake, 2)) == [0, 1, 2]


def test_a_replayed_commit_replaces_itself(spark, lake):
    commits.commit(rows(spark, 1, 2), lake, 0)
    commits.commit(rows(spark, 3), lake, 1)
    commits.commit(rows(spark, 3), lake, 1)
    assert numbers(commits.current(spark, lake)) == [1, 2, 3]


def test_rows_of_an_unlogged_commit_are_invisible(spark, lake):
    commits.commit(rows(spark, 1), lake, 0)
    half = rows(spark, 99).withColumn("commit_id", F.lit(1))
    tables.overwrite_partitions(half, lake)
    assert numbers(commits.current(spark, lake)) == [1]
    commits.commit(rows(spark, 2), lake, 1)
    assert numbers(commits.current(spark, lake)) == [1, 2]


def test_expiry_ends_travel_but_keeps_rows(spark, lake):
    t0 = dt.datetime(2025, 1, 1)
    for c in range(5):
        commits.commit(rows(spark, c), lake, c, t0 + dt.timedelta(hours=c))
    assert commits.expire(spark, lake, 10) == 0
    assert commits.expire(spark, lake, 2) == 3
    assert commits.expire(spark, lake, 2) == 0
    assert numbers(commits.current(spark, lake)) == [0, 1, 2, 3, 4]
    assert numbers(commits.version(spark, lake, 3)) == [0, 1, 2, 3]
    for gone in (lambda: commits.version(spark, lake, 1), lambda: commits.as_of(spark, lake, t0)):
        with pytest.raises(ValueError):
            gone()


def test_commit_filter_prunes_partitions(spark, lake):
    commits.commit(rows(spark, 1), lake, 0)
    plan = commits.current(spark, lake)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commit_id" in plan


def test_missing_columns_are_added(spark, tmp_path, name):
    tables.create_table(spark, name, "a int", path=str(tmp_path / name))
    tables.append_by_name(spark.createDataFrame([(1,)], "a int"), name)
    wider = spark.createDataFrame([("x", 2)], "b string, a int")
    tables.add_missing_columns(wider, name)
    tables.append_by_name(wider, name)
    assert sorted((r.a, r.b) for r in spark.table(name).collect()) == [(1, None), (2, "x")]


def test_tree_skips_other_names_and_corrupt_files(spark, tmp_path):
    good = spark.range(3)
    good.write.parquet(str(tmp_path / "x" / "y"))
    (tmp_path / "x" / "bad.parquet").write_bytes(b"no parquet at all")
    (tmp_path / "x" / "notes.txt").write_text("text")
    got = tables.read_parquet_tree(spark, str(tmp_path), "id long")
    assert sorted(r.id for r in got.collect()) == [0, 1, 2]


def test_registry_csv(spark, tmp_path):
    head = ",".join(schemas.columns(schemas.REGISTRY))
    lines = [
        head,
        "cam01,City,D,W,S,10.5,106.7,u1,high",
        'cam02,City,D,"Ward, with ""quotes""",S,north,106.7,u2,low',
        "cam01,City,D,W2,S,11.5,106.7,u1,medium",
    ]
    path = tmp_path / "registry.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = {r.camera_id: r for r in registry.read_registry_csv(spark, str(path)).collect()}
    assert (got["cam01"].ward, got["cam01"].latitude) == ("W2", 11.5)
    assert (got["cam02"].ward, got["cam02"].latitude) == ('Ward, with "quotes"', None)

    out = str(tmp_path / "out")
    registry.write_registry_csv(registry.read_registry_csv(spark, str(path)), out)
    again = registry.read_registry_csv(spark, out)
    assert sorted(again.collect()) == sorted(got.values())


def test_registry_values_may_hold_line_breaks(spark, tmp_path):
    head = ",".join(schemas.columns(schemas.REGISTRY))
    path = tmp_path / "registry.csv"
    body = 'cam01,City,D,"Ward\nof two lines, ""quoted""",S,10.5,106.7,u1,high\ncam02,City,D,W,S,1,2,u2,low\n'
    path.write_text(f"{head}\n{body}", encoding="utf-8")
    got = {r.camera_id: r for r in registry.read_registry_csv(spark, str(path)).collect()}
    assert set(got) == {"cam01", "cam02"}
    assert (got["cam01"].ward, got["cam01"].latitude) == ('Ward\nof two lines, "quoted"', 10.5)


def test_shared_dir_follows_the_session_setting(spark, monkeypatch):
    assert shared_dir(spark, "a") != shared_dir(spark, "a")

    class Conf:
        def get(self, *_):
            return "s3://shared/checkpoints/"

    class Session:
        conf = Conf()

    assert shared_dir(Session(), "a").startswith("s3://shared/checkpoints/a-")

    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Cluster:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError):
        shared_dir(Cluster(), "a")


def test_materialized_rows_prune_columns(spark):
    kept = materialize(spark.range(5).withColumn("other", F.lit("x")), "rows")
    plan = kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and kept.count() == 5


def test_latest_is_limited_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    out = dedupe.latest_per_key(frame, "k", [F.col("v").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(0, 99), (1, 97), (2, 98)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_repeated_and_null_candidates_stay(spark):
    rows_ = spark.createDataFrame([(1,), (1,), (2,), (None,)], "event_id int")
    known = spark.createDataFrame([("2",), ("2",), (None,)], "event_id string")
    got = [r.event_id for r in dedupe.id_difference(rows_, known, "event_id").collect()]
    assert sorted(got, key=str) == [1, 1, None]


def test_create_or_append_by_name(spark, tmp_path, name):
    first = spark.createDataFrame([(1, "a")], "n int, s string")
    tables.create_or_append(first, name, "s string, n int", path=str(tmp_path / name))
    tables.create_or_append(first.select("s", "n"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("a", 1)] * 2


def test_unread_files_are_named(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t" / "a.parquet"))
    (tmp_path / "t" / "bad.parquet").write_bytes(b"no parquet at all")
    rows = tables.read_parquet_tree(spark, str(tmp_path / "t"), "id long")
    assert rows.count() == 5
    named = [r.path for r in tables.unread_files(spark, str(tmp_path / "t"), rows).collect()]
    assert [p.rsplit("/", 1)[1] for p in named] == ["bad.parquet"]
