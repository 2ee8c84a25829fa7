"""Places of rows in a global order, without a window over one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

#: Rows are numbered inside partitions by Spark's increasing ids: partition << 33 | row.
ROW_BITS = 33


def with_positions(df: DataFrame, order: list[Column], column: str = "position", name: str = "positions") -> DataFrame:
    """``df`` with each row's place in the order, from 0, as a long.

    Rows are dealt by ranges of the order and numbered in each range; a range's rows begin
    after those of the ranges before it. Only a count per partition reaches the driver.
    Ranges are cut anywhere between different keys, so ``order`` should tell rows apart: rows
    that agree in all of it stay in one task and get their places in any order. Nulls go
    where the order puts them; no rows give no rows. The sorted rows are written once to the
    shared folder, so that ranges hold when a task runs again.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(column, F.monotonically_increasing_id())
    written = materialize(ordered, name)
    part = F.shiftrightunsigned(F.col(column), ROW_BITS)
    sizes = written.groupBy(part.alias("part")).count().collect()
    before, starts = 0, []
    for row in sorted(sizes):
        starts.append((row["part"], before))
        before += row["count"]
    made = F.col(column).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    if len(starts) > 1:
        at = F.element_at(F.map_from_arrays(*[F.array(*map(F.lit, x)) for x in zip(*starts, strict=True)]), part)
        made = made + at
    return written.withColumn(column, made)
