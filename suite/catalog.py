"""Where the queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that no reader shifts them."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else f"`{name}`"
            for name, kind in df.dtypes
        ]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the inventory's key, with its oracle if SQL has one."""

    def add(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain_times(run(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def rounded(*names: str, digits: int = 6) -> list:
    return [F.round(n, digits).alias(n) for n in names]
