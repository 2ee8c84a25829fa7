"""Camera registry as header CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators.dedupe import latest_per_key

_QUOTING = {"header": "true", "quote": '"', "escape": '"'}
# A quoted value may hold line breaks, so a file is read by one task; registries are small.
_READING = {**_QUOTING, "multiLine": "true"}


def read_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Registered cameras; of a repeated camera the last row of the file wins.

    Coordinates that are no numbers read as NULL.
    """
    names = schemas.columns(schemas.REGISTRY)
    text = ", ".join(f"{n} string" for n in names)
    rows = spark.read.options(**_READING).schema(text).csv(path)
    # Position in the file: split by split, then row by row inside a split.
    placed = rows.select(
        *names,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )
    last_first = [F.col(c).desc() for c in ("_file", "_split", "_row")]
    return latest_per_key(placed, "camera_id", last_first).select(
        *[
            F.col(n).try_cast("double").alias(n) if n in ("latitude", "longitude") else n
            for n in names
        ]
    )


def write_registry_csv(registry: DataFrame, path: str) -> None:
    """Write the registry with a header, columns in their fixed order."""
    registry.select(*schemas.columns(schemas.REGISTRY)).write.options(**_QUOTING).csv(path)
