"""Joins against tables of unknown size.

Nothing here runs a job to learn a size: the planner's estimate decides before the query,
adaptive execution corrects it while it runs and splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side is broadcast up to this estimated size.
BROADCAST_BYTES = 16 << 20


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the planner expects ``df`` to have at most ``max_bytes`` bytes.

    Files count as large as they are; for derived tables the estimate is far above the
    truth rather than below it.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes())) <= max_bytes


def reference_join(
    rows: DataFrame, reference: DataFrame, key: str, how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join many ``rows`` to a ``reference`` table on ``key``.

    A reference that is known to be small is broadcast, so ``rows`` are not shuffled at
    all. Others are left to adaptive execution, which broadcasts what turns out to be small
    and splits a key that holds a third of the rows; only that key's reference row is
    copied then.
    """
    if how not in ("inner", "left"):
        raise ValueError("reference_join keeps rows of the left side: inner or left")
    if fits_broadcast(reference, max_bytes):
        reference = F.broadcast(reference)
    return rows.join(reference, key, how)


def without(rows: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``known`` keys; rows with a NULL key stay."""
    return rows.join(known.select(*on), list(on), "left_anti")
