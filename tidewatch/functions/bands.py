"""Step functions from a number to a label."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = Sequence[tuple[float, str]]

# The dashboards' threshold steps.
ALIVE_WORKERS: Steps = ((0, "red"), (1, "orange"), (2, "green"))
FREE_MEMORY_MB: Steps = ((0, "green"), (512, "red"))
DELAY_SECONDS: Steps = ((0, "green"), (10, "orange"), (30, "red"))
ALERT_PANEL: Steps = ((0, "green"), (80, "red"))


def threshold_band(value: Column | str, steps: Steps) -> Column:
    """Label of the highest threshold at or below ``value``.

    The lowest step is the base and also covers smaller values; NULL stays NULL.
    """
    column = F.col(value) if isinstance(value, str) else value
    rising = sorted(steps)
    chain = reduce(
        lambda c, step: c.when(column >= step[0], step[1]),
        rising[:0:-1],
        F.when(column.isNull(), F.lit(None).cast("string")),
    )
    return chain.otherwise(rising[0][1])
