"""Every registered query beside its SQL, on the smallest tables; and its plan."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from suite.views import alerts
from tidewatch.operators import dashboard
from tidewatch.operators.rollup import rollup_tumbling

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = ordered(frame.columns, frame.collect())
    if name in ORACLE:
        result = tables.execute(ORACLE[name])
        columns = [d[0] for d in result.description]
        assert got == ordered(columns, result.fetchall())


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["ward", "total_events"]
    totals = [r.total_events for r in frame.collect()]
    assert totals and totals == sorted(totals, reverse=True)


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_time_bounds_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # else plans cut the list of filters
    try:
        plan = plan_of(spark, "kpi_count_7d")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(date_key" in plan and "(date_key#" in plan
    assert "GreaterThanOrEqual(window_start,2024-01-14" in plan
    assert "ReadSchema: struct<window_start:timestamp,is_violent_window:boolean>" in plan


BOUNDED = (
    "filter_last_24h filter_last_7d filter_time_range kpi_count_24h kpi_count_7d kpi_avg_latency_7d "
    "risk_trend_series daily_trend incident_answer hotspot_by_point rank_wards"
).split()


@pytest.mark.parametrize("name", BOUNDED)
def test_bounds_decide_the_result(spark, monkeypatch, name):
    """Without the operators' time bounds each of these queries gives other rows."""
    want = sorted(map(repr, QUERIES[name](spark, SF_DIR).collect()))
    monkeypatch.setattr(dashboard, "since", lambda fact, *_: fact)
    monkeypatch.setattr(dashboard, "in_range", lambda fact, *_: fact)
    assert sorted(map(repr, QUERIES[name](spark, SF_DIR).collect())) != want


def test_numeric_rollup_is_hashed(spark):
    """Unread aggregates are dropped, so panels without the argmax do not sort."""
    rows = rollup_tumbling(alerts(spark, SF_DIR))
    plan = dashboard.average_latency(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_date_partitions_are_pruned(spark):
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(spark, "partition_pruned_scan")


def test_library_does_not_gather_rows():
    """Collects are limited to bounded question lots, the commit log, dates of a run or of withdrawals, and counts per partition."""
    import pathlib

    import tidewatch

    uses = {}
    root = pathlib.Path(tidewatch.__file__).parent
    for path in (p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts):
        source = path.read_text()
        found = source.count(".collect()") + source.count(".toPandas()")
        if found:
            uses[path.name] = found
    assert uses == {"knn.py": 2, "commits.py": 2, "gold.py": 1, "increments.py": 2, "positions.py": 1, "tables.py": 1}


@pytest.mark.parametrize("name", ["soft_delete", "set_difference_ids", "ingest_incremental"])
def test_plans_are_made_without_jobs(spark, name):
    spark.sparkContext.setJobGroup(f"plan {name}", name)
    try:
        QUERIES[name](spark, SF_DIR)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"plan {name}")
