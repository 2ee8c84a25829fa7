"""Upserts into tables bucketed by their key, whose stored side is never shuffled.

A table is a view over its newest generation. An upsert writes the next generation beside
it and switches the view, so readers see all of it or nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import latest_per_key
from tidewatch.session import remove


def merged_by_key(stored: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """Stored rows, one per key, with the newest incoming row of each key laid over them.

    One full outer join. Where ``stored`` is bucketed by the key it is read bucket by bucket
    and only the incoming rows are shuffled, first down to one per key (a hot key sends one
    row per task), then to the buckets. ``incoming`` is evaluated once. Stored rows with a NULL
    key stay, incoming ones are one row. Columns that only one side has are NULL for rows of
    the other; types are those of the stored side.
    """
    fresh = latest_per_key(incoming, key, [F.col(version).desc()])
    old = stored.select(F.col(key), F.struct("*").alias("_old"))
    new = fresh.select(F.col(key).cast(stored.schema[key].dataType).alias("_key"), F.struct("*").alias("_new"))
    joined = old.join(new, F.col(key) == F.col("_key"), "full")

    def chosen(name: str):
        was = F.col("_old")[name] if name in stored.columns else F.lit(None)
        now = F.col("_new")[name] if name in incoming.columns else F.lit(None)
        if name in stored.columns:
            now = now.cast(stored.schema[name].dataType)
        return F.when(F.col("_new").isNotNull(), now).otherwise(was).alias(name)

    names = [*stored.columns, *[name for name in incoming.columns if name not in stored.columns]]
    return joined.select(*[chosen(name) for name in names])


def generation_of(spark: SparkSession, table: str) -> int | None:
    """The generation a table's view shows, None while there is none."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").first()
    return int(re.search(r"_(\d+)$", described.data_type.strip())[1])


def upsert_bucketed(
    incoming: DataFrame,
    table: str,
    generation: int,
    path: str,
    key: str = "id",
    version: str = "version",
    buckets: int = 64,
) -> DataFrame:
    """Write the table's next generation below ``path`` and show it; returns the table.

    Generations are numbered upwards by the caller. One that is shown already is not written
    again, one whose writing broke off is replaced. The generation before stays for readers
    that still use it, older ones go. Choose ``buckets`` for the size the table will have.
    """
    spark = incoming.sparkSession
    shown = generation_of(spark, table)
    if shown is not None and shown >= generation:
        return spark.table(table)
    if shown is None:
        rows = latest_per_key(incoming, key, [F.col(version).desc()])
    else:
        rows = merged_by_key(spark.table(f"{table}_{shown}"), incoming, key, version)
    spark.sql(f"DROP TABLE IF EXISTS {table}_{generation}")
    (
        rows.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{path}/generation={generation}")
        .saveAsTable(f"{table}_{generation}")
    )
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {table}_{generation}")
    for number in range((shown or 0) - 1, -1, -1):
        if not spark.catalog.tableExists(f"{table}_{number}"):
            break
        spark.sql(f"DROP TABLE {table}_{number}")
        remove(spark, f"{path}/generation={number}")
    return spark.table(table)
