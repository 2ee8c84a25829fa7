"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and benchmarks.

    On a cluster the session comes from ``spark-submit``; nothing in the library
    creates one.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidewatch-"))
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``).

    Only a local master may run without that setting; it then gets a temporary
    folder. On a cluster a missing setting is an error, because a machine-local
    folder would lose the data with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        if context.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="tidewatch-")
        base = _LOCAL_DIRS[context.applicationId]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`shared_dir` named, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage in a way that outlives executors, and later readers still
    prune columns and push filters into the written files. A fresh folder is used
    unless ``path`` names one, which is overwritten: jobs that run again and again
    should name one, so that nothing piles up. A fresh folder goes with the application,
    or earlier by :func:`release`.
    """
    spark, target = df.sparkSession, path or shared_dir(df.sparkSession, name)
    if not path:
        folder = spark._jvm.org.apache.hadoop.fs.Path(target)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.mode("overwrite").parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    written.written_to = target
    return written


def release(written: DataFrame) -> None:
    """Delete the folder of a table that :func:`materialize` wrote, once nothing reads it any more."""
    remove(written.sparkSession, written.written_to)
