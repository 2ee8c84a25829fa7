"""Tables and file trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewatch import schemas
from tidewatch.session import remove, shared_dir


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole table; filters and column choice of later steps reach the scan."""
    return spark.read.table(name)


def read_parquet_tree(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All files below ``path`` whose name contains ``.parquet``; unreadable ones are skipped.

    :func:`unread_files` names those.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet*")
        .option("ignoreCorruptFiles", True)
    )
    return (reader.schema(schema) if schema else reader).parquet(path)


def create_table(
    spark: SparkSession,
    name: str,
    layout: str,
    partitioned_by: Sequence[str] = (),
    format: str = "parquet",
    path: str | None = None,
) -> None:
    """Create the table if it is absent."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout}) USING {format}{parts}{where}")


def create_bronze(
    spark: SparkSession, name: str, format: str = "parquet", path: str | None = None
) -> None:
    """Create the bronze table, partitioned by event date, if it is absent."""
    create_table(spark, name, schemas.BRONZE, ["event_date"], format, path)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append rows to an existing table, matching columns by name."""
    target = df.sparkSession.table(name).columns
    df.select(*target).write.mode("append").insertInto(name)


def create_or_append(
    df: DataFrame,
    name: str,
    layout: str | None = None,
    partitioned_by: Sequence[str] = (),
    format: str = "parquet",
    path: str | None = None,
) -> None:
    """Append to a table, which is created from the layout on the first write."""
    rows = df.select(*schemas.columns(layout)) if layout else df
    if df.sparkSession.catalog.tableExists(name):
        append_by_name(rows, name)
        return
    writer = rows.write.format(format).mode("append")
    if partitioned_by:
        writer = writer.partitionBy(*partitioned_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace exactly the partitions that occur in ``df``.

    The mode is a setting of the session. Rows are staged in the shared folder and written
    by a session of their own, so that other writers keep the mode they have.
    """
    spark = df.sparkSession
    staged = shared_dir(spark, "partitions")
    rows = df.select(*spark.table(name).columns)
    rows.write.parquet(staged)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    where = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
    own.read.schema(rows.schema).parquet(staged).write.mode("overwrite").insertInto(where)
    spark.catalog.refreshTable(name)
    remove(spark, staged)


def partition_values(spark: SparkSession, name: str, part: str) -> set[str]:
    """Values of the only partition column, as text; none while the table is absent."""
    if not spark.catalog.tableExists(name):
        return set()
    return {row.partition.split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def clear_partition(spark: SparkSession, name: str, part: str, value: str) -> None:
    """Remove the rows of one partition."""
    layout = [field for field in spark.table(name).schema if field.name != part]
    nothing = ", ".join(f"CAST(NULL AS {field.dataType.simpleString()})" for field in layout)
    spark.sql(f"INSERT OVERWRITE {name} PARTITION ({part} = '{value}') SELECT {nothing} WHERE false")
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part} = '{value}')")


def add_missing_columns(df: DataFrame, name: str) -> None:
    """Add the columns of ``df`` the table lacks; older rows read NULL there."""
    present = set(df.sparkSession.table(name).columns)
    missing = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name not in present]
    if missing:
        df.sparkSession.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(missing)})")


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet written under several versions of a layout, as their union by name."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def unread_files(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Paths of the files below ``path`` that gave none of ``rows``: unreadable or empty ones.

    ``rows`` come from :func:`read_parquet_tree`, which passes over what it cannot read.
    """
    there = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet*")
        .load(path)
        .select("path")
    )
    read = rows.select(rows["_metadata.file_path"].alias("path")).distinct()
    return there.join(read, "path", "left_anti")
