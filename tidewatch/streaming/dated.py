"""Micro-batches appended to date partitions under the number of their batch.

The table is an ordinary one, partitioned by ``event_date`` alone, so it has as many
partitions as dates however many batches come. Rows carry the number of their batch, and
until its date is merged a file holds rows of one batch, which is how a batch that comes
again finds what it left before. Snapshots of the table are a table format's business:
readers may see a part of the batch that is being written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import ingest
from tidewatch.session import remove
from tidewatch.sources import tables

#: Every so many batches the settled dates among those written to are merged.
MERGE_EVERY = 60

#: Dates with fewer files than this stay as they are.
MANY_FILES = 8


def create_dated_bronze(spark: SparkSession, table: str, path: str | None = None) -> None:
    """Bronze with the number of each row's batch, partitioned by event date, if absent."""
    tables.create_table(spark, table, f"{schemas.BRONZE}, batch_id long", ["event_date"], path=path)


def within(first, last) -> Column:
    """Dates of a range, and rows without a date: a filter on partitions."""
    dated = F.col("event_date").between(F.lit(first), F.lit(last))
    return F.coalesce(dated, F.lit(False)) | F.col("event_date").isNull()


def files_of(rows: DataFrame) -> DataFrame:
    """Files that rows of a dated table come from, with their date and range of batches."""
    return rows.groupBy("event_date", rows["_metadata.file_path"].alias("path")).agg(
        F.min("batch_id").alias("oldest"), F.max("batch_id").alias("newest")
    )


def withdraw_batch(spark: SparkSession, table: str, batch_id: int, dates: Column) -> int:
    """Delete the files an earlier try of the batch left in these partitions; their number.

    Only files whose statistics admit the batch are read. A merged file cannot hold the
    newest batch, so one that shares the batch with others is an error.
    """
    rows = spark.table(table).where(dates)
    # One row per file of one micro-batch.
    left = files_of(rows.where(F.col("batch_id") == batch_id)).select("path").collect()
    paths = [row.path for row in left]
    if not paths:
        return 0
    mixed = files_of(rows).where(F.col("path").isin(paths) & (F.col("oldest") != F.col("newest")))
    if not mixed.isEmpty():
        raise ValueError(f"batch {batch_id} of {table} was merged and cannot be written again")
    for path in paths:
        remove(spark, path)
    spark.catalog.refreshTable(table)
    return len(paths)


def append_batch(rows: DataFrame, table: str, batch_id: int, again: bool = False) -> tuple[int, object, object]:
    """Append a batch; its row count, first and last date, all taken while writing.

    ``again`` says that an earlier try may have left files. Their dates are those of the
    batch, which then is read once more to learn them. An empty batch writes nothing.
    """
    spark = rows.sparkSession
    if again:
        first, last = rows.agg(F.min("event_date"), F.max("event_date")).first()
        withdraw_batch(spark, table, batch_id, within(first, last))
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.min("event_date").alias("first"),
        F.max("event_date").alias("last"),
    )
    tables.append_by_name(counted.withColumn("batch_id", F.lit(batch_id).cast("long")), table)
    got = seen.get
    return int(got["rows"] or 0), got["first"], got["last"]


def merge_settled(
    spark: SparkSession,
    table: str,
    before: int,
    dates: Column | None = None,
    many_files: int = MANY_FILES,
) -> Sequence[object]:
    """Rewrite dates of many small files as few large ones; returns these dates.

    A date is settled if no row of it is of batch ``before`` or a later one: the newest
    batch may come again and must find its own files. ``dates`` bounds the partitions that
    are looked at. File sizes are left to adaptive execution, which also cuts a hot date.
    Rows without a date are left alone. With one row per date, the list is short. The merged
    rows are staged in the shared folder first and stay there if replacing the dates breaks off.
    """
    rows = spark.table(table)
    rows = rows if dates is None else rows.where(dates)
    crowded = (
        files_of(rows)
        .where("event_date IS NOT NULL")
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("files"), F.max("newest").alias("newest"))
        .where((F.col("files") >= many_files) & (F.col("newest") < before))
    )
    settled = sorted(row.event_date for row in crowded.select("event_date").collect())
    if settled:
        chosen = spark.table(table).where(F.col("event_date").isin(settled))
        tables.overwrite_partitions(chosen.hint("rebalance", "event_date"), table)
    return settled


def dated_writer(
    table: str,
    enforce: bool = False,
    quarantine: str | None = None,
    merge_every: int = MERGE_EVERY,
    many_files: int = MANY_FILES,
    on_batch: Callable[[int, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function run on every micro-batch of parsed alerts, for ``start_bronze(writer=...)``.

    The first batch after a start or an error, and any whose number is not above the last,
    may have been tried before: its earlier files go first. Errors are raised, so a failed batch is tried
    again. With ``enforce`` rows without camera or event time go to the ``quarantine`` path.
    Every ``merge_every`` batches the dates written to since the last merge are merged.
    """
    if enforce and not quarantine:
        raise ValueError("enforce needs a quarantine path for the rows it rejects")
    state: dict = {"batch": None, "dates": None}

    def write(batch: DataFrame, batch_id: int) -> None:
        bronze = ingest.bronze_derive(batch)
        again = state["batch"] is None or batch_id <= state["batch"]
        # Until the batch is through, it counts as tried.
        state["batch"] = None
        # Read more than once, but the messages are fetched once.
        held = enforce or again
        bronze = bronze.persist() if held else bronze
        try:
            kept = ingest.valid_rows(bronze) if enforce else bronze
            rows, first, last = append_batch(kept, table, batch_id, again)
            if enforce:
                ingest.quarantine_rows(bronze).write.mode("overwrite").json(
                    f"{quarantine}/batch={batch_id}"
                )
        finally:
            if held:
                bronze.unpersist()
        state["batch"] = batch_id
        if first is not None:
            low, high = state["dates"] or (first, last)
            state["dates"] = (min(low, first), max(high, last))
        if state["dates"] and (batch_id + 1) % merge_every == 0:
            # Dates of the newest batch aren't settled yet and stay in the range.
            merge_settled(batch.sparkSession, table, batch_id, within(*state["dates"]), many_files)
            state["dates"] = (first, last) if first is not None else None
        if rows and on_batch:
            on_batch(batch_id, rows)

    return write
