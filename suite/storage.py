"""Scans, table writes, upserts, commits and time travel."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite.catalog import query
from suite.star import fact_of
from suite.views import ALERTS_SQL, alerts, rollup_sql, table
from tidewatch import schemas
from tidewatch.lake import commits
from tidewatch.operators import blooms, dedupe, ingest
from tidewatch.plans.gold import GoldTables, build_gold
from tidewatch.session import materialize, shared_dir
from tidewatch.sources import tables

# The month in five slices, the last one open.
SLICES = ("2024-01-01", "2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25", None)


def slices(spark, sf_dir):
    """The alerts in five slices of event time."""
    for since, until in zip(SLICES, SLICES[1:]):
        yield alerts(spark, sf_dir, since, until)


def bronze_rows(df):
    return df.withColumns(
        {
            "ai_timestamp": F.col("event_time").cast("string"),
            "ingest_time": F.lit("2024-02-01 00:00:00").cast("timestamp"),
        }
    ).select(*schemas.columns(schemas.BRONZE))


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query("src_table_scan", "SELECT * FROM lineitem")
def src_table_scan(spark, sf_dir):
    return tables.read_table(spark, f"parquet.`{sf_dir}/lineitem.parquet`")


@query("src_parquet_tree", "SELECT event_id, ts, user_id, event_type, value FROM events")
def src_parquet_tree(spark, sf_dir):
    """Files at two depths, between them text files that must not be read."""
    root = shared_dir(spark, "tree")
    rows = table(spark, sf_dir, "events").drop("props")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    rows.where(early).write.parquet(f"{root}/a/deep/er")
    rows.where(~early).write.parquet(f"{root}/b")
    rows.select("event_type").write.text(f"{root}/notes")
    return tables.read_parquet_tree(spark, root)


@query(
    "ddl_create_if_absent",
    "WITH " + ALERTS_SQL + " SELECT event_date, count(*) AS n FROM alerts GROUP BY event_date",
)
def ddl_create_if_absent(spark, sf_dir):
    """Creating the table again leaves its rows alone."""
    name, path = _name("bronze"), shared_dir(spark, "bronze")
    tables.create_bronze(spark, name, path=path)
    tables.append_by_name(bronze_rows(alerts(spark, sf_dir)), name)
    tables.create_bronze(spark, name, path=path)
    return tables.read_table(spark, name).groupBy("event_date").agg(F.count("*").alias("n"))


_BRONZE_SQL = """SELECT camera_id, ward, street, event_time, event_date, is_violent, score,
  fps, latency_ms, evidence_url FROM alerts"""
_BRONZE_OUT = (
    "camera_id", "ward", "street", "event_time", "event_date", "is_violent", "score", "fps",
    "latency_ms", "evidence_url",
)


@query("sink_bronze_append", "WITH " + ALERTS_SQL + _BRONZE_SQL)
def sink_bronze_append(spark, sf_dir):
    """Five appends; the second brings its columns in another order."""
    name = _name("bronze")
    tables.create_bronze(spark, name, path=shared_dir(spark, "bronze"))
    for number, part in enumerate(slices(spark, sf_dir)):
        rows = bronze_rows(part)
        tables.append_by_name(rows.select(*reversed(rows.columns)) if number == 1 else rows, name)
    return tables.read_table(spark, name).select(*_BRONZE_OUT)


@query(
    "sink_create_or_append",
    rollup_sql("1 day") + "SELECT fact_id, date_key, camera_key, alert_count, evidence_url FROM keyed",
)
def sink_create_or_append(spark, sf_dir):
    """The first write creates the table, the second appends to it."""
    name, path = _name("fact"), shared_dir(spark, "fact")
    for since, until in ((None, "2024-01-15"), ("2024-01-15", None)):
        rows = fact_of(spark, sf_dir, "1 day", since, until)
        tables.create_or_append(rows, name, schemas.FACT, ["date_key"], path=path)
    kept = tables.read_table(spark, name)
    return kept.select("fact_id", "date_key", "camera_key", "alert_count", "evidence_url")


@query(
    "partition_pruned_scan",
    "WITH "
    + ALERTS_SQL
    + _BRONZE_SQL
    + " WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
)
def partition_pruned_scan(spark, sf_dir):
    name = _name("bronze")
    tables.create_bronze(spark, name, path=shared_dir(spark, "bronze"))
    tables.append_by_name(bronze_rows(alerts(spark, sf_dir)), name)
    stored = tables.read_table(spark, name)
    return ingest.prune_dates(stored, "2024-01-10", "2024-01-12").select(*_BRONZE_OUT)


@query(
    "schema_evolution",
    """SELECT event_id, user_id, value,
      CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN event_type END AS event_type FROM events""",
)
def schema_evolution(spark, sf_dir):
    """A column the older files do not have reads NULL there."""
    root = shared_dir(spark, "evolved")
    rows = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    rows.where(early).select("event_id", "user_id", "value").write.parquet(f"{root}/one")
    later = rows.where(~early).select("event_id", "user_id", "value", "event_type")
    later.write.parquet(f"{root}/two")
    return tables.read_merged(spark, f"{root}/one", f"{root}/two")


def _lake(spark, sf_dir):
    """Bronze in five commits, an hour apart."""
    name = _name("lake")
    commits.create(spark, name, schemas.BRONZE, ["event_date"], shared_dir(spark, "lake"))
    start = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for number, part in enumerate(slices(spark, sf_dir)):
        at = start + F.expr(f"INTERVAL {number} HOURS")
        commits.commit(bronze_rows(part), name, number, at)
    return name


@query(
    "time_travel",
    "WITH " + ALERTS_SQL + _BRONZE_SQL + " WHERE event_time < TIMESTAMP '2024-01-19 00:00:00'",
)
def time_travel(spark, sf_dir):
    """Half past two, three of the five commits are in."""
    stood = commits.as_of(spark, _lake(spark, sf_dir), "2024-02-01 02:30:00")
    return stood.select(*_BRONZE_OUT)


_SLICE_SQL = """CASE WHEN event_time < TIMESTAMP '2024-01-07' THEN 0
  WHEN event_time < TIMESTAMP '2024-01-13' THEN 1 WHEN event_time < TIMESTAMP '2024-01-19' THEN 2
  WHEN event_time < TIMESTAMP '2024-01-25' THEN 3 ELSE 4 END"""


@query(
    "maint_expire_snapshots",
    "WITH "
    + ALERTS_SQL
    + f""" SELECT commit_id, rows, rows_upto, commit_id >= 3 AS kept FROM (
      SELECT CAST({_SLICE_SQL} AS BIGINT) AS commit_id, count(*) AS rows,
        CAST(sum(count(*)) OVER (ORDER BY {_SLICE_SQL}) AS BIGINT) AS rows_upto
      FROM alerts GROUP BY {_SLICE_SQL}) s""",
)
def maint_expire_snapshots(spark, sf_dir):
    """Two commits stay travellable, the rows of all five stay readable."""
    name = _lake(spark, sf_dir)
    commits.expire(spark, name, retain_last=2)
    sizes = commits.current(spark, name).groupBy("commit_id").agg(F.count("*").alias("rows"))
    kept = commits.history(spark, name).select("commit_id", F.lit(True).alias("kept"))
    running = F.sum("rows").over(
        dedupe.Window.orderBy("commit_id").rowsBetween(dedupe.Window.unboundedPreceding, 0)
    )
    return (
        sizes.withColumn("rows_upto", running)
        .join(kept, "commit_id", "left")
        .withColumn("kept", F.coalesce("kept", F.lit(False)))
    )


# Upserts and differences. -----------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS p
      FROM events) q WHERE p = 1""",
)
def latest_per_key(spark, sf_dir):
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return dedupe.latest_per_key(rows, "user_id", newest).drop("ts")


@query(
    "union_upsert",
    """SELECT d.doc_id AS id, CASE WHEN l.doc_id IS NULL THEN d.text
        ELSE concat('quality ', CAST(l.quality AS VARCHAR)) END AS text,
      CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS version
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def union_upsert(spark, sf_dir):
    """Labelled documents arrive again with another text."""
    stored = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.lit(0).alias("version")
    )
    incoming = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("text"),
        F.lit(1).alias("version"),
    )
    return dedupe.union_upsert(stored, incoming)


@query(
    "sink_vector_upsert",
    """SELECT vec_id AS id, label, round(CAST(embedding[1] AS DOUBLE) * CASE WHEN label >= 5
        THEN -1 ELSE 1 END, 6) AS first, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS version
      FROM embeddings
    UNION ALL SELECT vec_id + 1000000, label, round(CAST(embedding[1] AS DOUBLE), 6), 1
      FROM embeddings WHERE label >= 5""",
)
def sink_vector_upsert(spark, sf_dir):
    """Half of the vectors are replaced, as many ids are new; stored, then read back."""
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    again = vectors.where("label >= 5")
    negated = again.withColumn("embedding", F.transform("embedding", lambda x: -x))
    added = again.withColumn("id", F.col("id") + 1000000)
    incoming = negated.unionByName(added).withColumn("version", F.lit(1))
    upserted = dedupe.union_upsert(vectors.withColumn("version", F.lit(0)), incoming)
    stored = materialize(upserted, "vectors")
    first = F.col("embedding")[0].cast("double")
    return stored.select("id", "label", F.round(first, 6).alias("first"), "version")


@query(
    "read_existing_ids",
    """SELECT DISTINCT event_id FROM (SELECT CASE WHEN l_returnflag = 'N' THEN ''
      WHEN l_returnflag = 'R' THEN CAST(l_orderkey AS VARCHAR) END AS event_id FROM lineitem) l
    WHERE event_id <> ''""",
)
def read_existing_ids(spark, sf_dir):
    indexed = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", "")
        .when(F.col("l_returnflag") == "R", F.col("l_orderkey").cast("string"))
        .alias("event_id")
    )
    return dedupe.known_ids(indexed)


@query(
    "set_difference_ids",
    """SELECT o_orderkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def set_difference_ids(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").select("o_orderkey")
    known = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedupe.id_difference(wanted, known, "o_orderkey")


@query(
    "incremental_new_events",
    """SELECT l_orderkey AS event_id, l_linenumber FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def incremental_new_events(spark, sf_dir):
    """An id occurs on several rows; all rows of a new id stay."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_id"), "l_linenumber"
    )
    indexed = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return dedupe.id_difference(
        rows, indexed.select(F.col("o_orderkey").cast("string").alias("event_id")), "event_id"
    )


@query(
    "incremental_new_events_filter",
    """SELECT l_orderkey AS event_id, l_linenumber FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def incremental_new_events_filter(spark, sf_dir):
    """The same rows by a stored filter, whose two batches came on different days."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), "l_linenumber")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    indexed = orders.select(F.col("o_orderkey").cast("string").alias("event_id"))
    path, early = shared_dir(spark, "filter"), F.col("o_orderdate") < "1995-01-01"
    for batch, days in enumerate((early, ~early)):
        blooms.append_filter(orders.where(days), "o_orderkey", path, batch)
    return blooms.new_rows(rows, indexed, "event_id", blooms.stored_filter(spark, path))


@query(
    "skip_empty",
    "WITH "
    + ALERTS_SQL
    + """ SELECT CAST(CASE WHEN event_time < TIMESTAMP '2024-01-15' THEN 1 ELSE 3 END AS BIGINT)
      AS commit_id, count(*) AS rows FROM alerts GROUP BY 1""",
)
def skip_empty(spark, sf_dir):
    """Batches 0 and 2 hold nothing and leave no commit."""
    name = _name("sparse")
    commits.create(spark, name, schemas.BRONZE, ["event_date"], shared_dir(spark, "sparse"))
    bounds = ((None, "2023-01-01"), (None, "2024-01-15"), ("2025-01-01", None), ("2024-01-15", None))
    for number, (since, until) in enumerate(bounds):
        commits.commit(bronze_rows(alerts(spark, sf_dir, since, until)), name, number)
    return commits.history(spark, name).select("commit_id", "rows")


def _gold(spark, sf_dir):
    """The star schema after two runs, the second over all dates once more."""
    names = GoldTables(*(_name(t) for t in ("dt", "dl", "dc", "fact", "rag")), shared_dir(spark, "gold"))
    bronze = bronze_rows(alerts(spark, sf_dir))
    build_gold(spark, bronze, names, "1 day", last="2024-01-10")
    build_gold(spark, bronze, names, "1 day")
    return names


@query(
    "gold_job_fact",
    rollup_sql("1 day")
    + """SELECT k.fact_id, k.date_key, k.alert_count, k.is_violent_window, l.ward, l.latitude,
      k.risk_level FROM keyed k JOIN locations l ON l.location_key = k.location_key""",
)
def gold_job_fact(spark, sf_dir):
    """Stored fact with its stored dimensions: no row twice, no row lost."""
    names = _gold(spark, sf_dir)
    fact, places, cameras = (spark.table(t) for t in (names.fact, names.location, names.camera))
    return (
        fact.join(places, "location_key")
        .join(cameras, "camera_key")
        .select(
            "fact_id", "date_key", "alert_count", "is_violent_window", "ward", "latitude", "risk_level"
        )
    )


@query(
    "gold_job_retrieval",
    rollup_sql("1 day")
    + """SELECT fact_id AS event_id, camera_id, ward, max_risk_score AS score,
      strftime(window_start, '%Y-%m-%d') AS date FROM keyed WHERE is_violent_window""",
)
def gold_job_retrieval(spark, sf_dir):
    stored = spark.table(_gold(spark, sf_dir).retrieval)
    return stored.select("event_id", "camera_id", "ward", "score", "date")


@query("batch_count", "SELECT count(*) AS rows FROM events")
def batch_count(spark, sf_dir):
    """Counted while the batch is written, not by a second scan."""
    name = _name("counted")
    commits.create(spark, name, schemas.BRONZE, ["event_date"], shared_dir(spark, "counted"))
    commits.commit(bronze_rows(alerts(spark, sf_dir)), name, 0)
    return commits.history(spark, name).select("rows")


@query("index_count", "SELECT count(*) AS docs_indexed FROM documents")
def index_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("docs_indexed"))
