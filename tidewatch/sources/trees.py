"""Trees of Parquet files that were written under different layouts.

Footers are read in tasks, files of one layout are scanned together, and the scans are put
together by column name. What a file was good for is a row of the inventory.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import materialize, release

INVENTORY = "path string, bytes long, rows long, layout string, error string"


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs, parquet

    def opened(path: str):
        # Local paths come as file:/x, other schemes name their host.
        if path.startswith("file:") or "://" not in path:
            return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(path)

    def row(path: str):
        size = None
        try:
            system, name = opened(path)
            with system.open_input_file(name) as file:
                size = file.size()
                footer = parquet.ParquetFile(file)
                # The first two lines name the object and the root, not the layout.
                layout = "\n".join(str(footer.schema).splitlines()[2:])
                return path, size, footer.metadata.num_rows, layout, None
        except Exception as problem:  # noqa: BLE001 - any problem of a file is a row of the inventory
            return path, size, None, None, f"{type(problem).__name__}: {problem}"

    for batch in batches:
        made = pd.DataFrame([row(path) for path in batch["path"]], columns=["path", "bytes", "rows", "layout", "error"])
        yield made.astype({"bytes": "Int64", "rows": "Int64"})


def tree_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` whose name contains ``.parquet``: rows, layout, or why they can't be read.

    A file of 0 rows is empty, one with an ``error`` is bad. Only footers are read, in tasks.
    Spark lists the files, those without a byte too, which a scan would pass over. Their
    file system must be one that Arrow opens (local, HDFS, S3, GCS); otherwise all are bad.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet*")
        .load(path)
    )
    paths = pd.DataFrame({"path": [unquote(name) for name in listed.inputFiles()]}, dtype=str)
    # Files are dealt out one by one: their footers cost the same whatever their size.
    files = spark.createDataFrame(paths, "path string").repartition("path")
    return files.mapInPandas(_footers, INVENTORY)


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _textual(kinds: list[T.DataType]) -> bool:
    """Whether columns of these types only meet as text."""
    plain = all(not isinstance(k, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)) for k in kinds)
    timed = all(isinstance(k, (T.DateType, T.TimestampType, T.TimestampNTZType)) for k in kinds)
    return plain and len(set(kinds)) > 1 and not all(map(_numeric, kinds)) and not timed


def union_layouts(parts: list[DataFrame]) -> DataFrame:
    """Frames of different layouts by column name; a column a frame lacks is NULL there.

    Names that differ in case only are one column, spelt as the first frame has it.
    Numbers and times meet in the wider type, other scalars of different types as text.
    """
    kinds: dict[str, list[T.DataType]] = {}
    for part in parts:
        for field in part.schema:
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
    told = {name for name, types in kinds.items() if _textual(types)}
    whole = None
    for part in parts:
        columns = ["`" + name.replace("`", "``") + "`" for name in part.columns]
        part = part.select(
            *[
                F.col(quoted).cast("string").alias(name) if name.lower() in told else F.col(quoted)
                for name, quoted in zip(part.columns, columns)
            ]
        )
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_layouts(spark: SparkSession, path: str, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All rows below ``path``, one scan per layout, and the files that gave none.

    The second frame is the inventory of bad and empty files. ``schema`` is what a tree
    without a readable row gives, and fixes the columns and types otherwise; without it such
    a tree is an error. Filters and column choice reach every scan. The driver sees the
    path of each file, as it does when Spark lists a folder, and one row per layout beside.
    """
    files = materialize(tree_inventory(spark, path), "inventory")
    useful = files.where("error IS NULL AND rows > 0")
    groups = useful.groupBy("layout").agg(F.collect_list("path").alias("paths")).orderBy("layout").collect()
    reader = spark.read.option("ignoreCorruptFiles", True)
    parts = [reader.parquet(*sorted(group.paths)) for group in groups]
    left_out = files.where("error IS NOT NULL OR rows = 0")
    if not parts and schema is None:
        release(files)
        raise ValueError(f"no readable rows below {path}, and no schema to go by")
    wanted = T.StructType.fromDDL(schema) if schema else None
    if not parts:
        return spark.createDataFrame([], wanted), left_out
    rows = union_layouts(parts)
    if wanted:
        there = {name.lower(): name for name in rows.columns}
        rows = rows.select(
            *[
                (F.col(there[f.name.lower()]) if f.name.lower() in there else F.lit(None))
                .try_cast(f.dataType)
                .alias(f.name)
                for f in wanted
            ]
        )
    return rows, left_out
