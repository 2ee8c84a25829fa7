"""Numbered commits: atomic visibility, repeatable batches, time travel, expiry.

Data carry the number of the commit that wrote them as a partition column, and a
commit counts once its row is in the log table, which is written last. Readers
see ``commit_id <= last logged``, a partition filter. Writing a commit again
replaces its partitions, so a batch may be replayed. There is one writer per
table; several writers need a lake table format.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.times import moment
from tidewatch.sources import tables

# Snapshots kept, and how often older ones are expired.
RETAIN_COMMITS = 100
EXPIRE_EVERY = 5

_LOG = "committed_at timestamp, rows long, commit_id long"


def log_name(table: str) -> str:
    return f"{table}_commits"


def create(
    spark: SparkSession,
    table: str,
    layout: str,
    partitioned_by: list[str],
    path: str | None = None,
) -> None:
    """Create the data table and its log if they are absent."""
    parts = [*partitioned_by, "commit_id"]
    tables.create_table(spark, table, f"{layout}, commit_id long", parts, path=path)
    log_path = f"{path}_commits" if path else None
    tables.create_table(spark, log_name(table), _LOG, ["commit_id"], path=log_path)


def commit(
    df: DataFrame,
    table: str,
    commit_id: int,
    committed_at: str | dt.datetime | Column | None = None,
) -> int:
    """Write ``df`` as one commit and return its row count, taken while writing.

    Without rows there is no commit.
    """
    spark = df.sparkSession
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    tables.overwrite_partitions(counted.withColumn("commit_id", F.lit(commit_id)), table)
    rows = int(seen.get["rows"])
    if not rows:
        return 0
    entry = spark.range(1).select(
        moment(committed_at).alias("committed_at"),
        F.lit(rows).cast("long").alias("rows"),
        F.lit(commit_id).cast("long").alias("commit_id"),
    )
    tables.overwrite_partitions(entry, log_name(table))
    return rows


def history(spark: SparkSession, table: str) -> DataFrame:
    """Commits that can still be travelled to."""
    return spark.table(log_name(table))


def _upto(spark: SparkSession, table: str, last: int | None) -> DataFrame:
    return spark.table(table).where(F.col("commit_id") <= F.lit(-1 if last is None else last))


def current(spark: SparkSession, table: str) -> DataFrame:
    """Rows of all complete commits."""
    last = history(spark, table).agg(F.max("commit_id")).first()[0]
    return _upto(spark, table, last)


def as_of(spark: SparkSession, table: str, at: str | dt.datetime) -> DataFrame:
    """The table as it stood at ``at``: no rows before the first commit.

    A time before the oldest kept commit is an error once commits were expired.
    """
    earlier = history(spark, table).where(F.col("committed_at") <= F.lit(at).cast("timestamp"))
    last = earlier.agg(F.max("commit_id")).first()[0]
    if last is None:
        oldest = history(spark, table).agg(F.min("commit_id")).first()[0]
        if oldest is not None and not spark.table(table).where(F.col("commit_id") < oldest).isEmpty():
            raise ValueError(f"{at} lies before the oldest kept commit of {table}")
    return _upto(spark, table, last)


def version(spark: SparkSession, table: str, commit_id: int) -> DataFrame:
    """The table as of one kept commit."""
    if history(spark, table).where(F.col("commit_id") == commit_id).isEmpty():
        raise ValueError(f"commit {commit_id} of {table} is unknown or expired")
    return _upto(spark, table, commit_id)


def expire(spark: SparkSession, table: str, retain_last: int = RETAIN_COMMITS) -> int:
    """Forget all but the newest commits; rows stay, only travel to them ends.

    Returns how many were forgotten. Run every few commits, so the list is short.
    """
    log = history(spark, table)
    newest = [r[0] for r in log.select("commit_id").orderBy(F.desc("commit_id")).limit(retain_last).collect()]
    if len(newest) < retain_last:
        return 0
    old = [r[0] for r in log.where(F.col("commit_id") < newest[-1]).select("commit_id").collect()]
    if old:
        gone = ", ".join(f"PARTITION (commit_id = {c})" for c in old)
        spark.sql(f"ALTER TABLE {log_name(table)} DROP IF EXISTS {gone}")
    return len(old)


def expire_iceberg(
    spark: SparkSession, catalog: str, table: str, retain_last: int = RETAIN_COMMITS
) -> None:
    """The same for an Iceberg table, where the session has that catalog."""
    spark.sql(
        f"CALL {catalog}.system.expire_snapshots(table => '{table}', retain_last => {retain_last})"
    )
