"""Trailing-range operators over metric samples.

Samples are rows of (series labels, ts, value). All operators cut each series
into blocks of time, so a series that holds a third of all samples is spread
over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.times import micros_of


def _block(position: Column, length: int) -> Column:
    return F.floor(position / length)


def _placed(samples: DataFrame, series: Sequence[str], width: str, ts: str) -> DataFrame:
    """Each sample in its own block of ``width`` and, moved by ``width``, in the next one.

    ``_of`` holds the labels as one struct: structs with equal NULL labels are equal, so it
    can be the key of windows and joins alike and rows keep one partitioning.
    """
    length = micros_of(width)
    placed = samples.withColumns(
        {"_of": F.struct(*series), "_moved": F.explode(F.array(F.lit(0), F.lit(1)))}
    )
    placed = placed.withColumn("_at", F.unix_micros(ts) + F.col("_moved") * F.lit(length))
    return placed.withColumn("_block", _block(F.col("_at"), length))


def _halves(placed: DataFrame, parts: dict[str, tuple[Callable[[Column], Column], Column]]) -> DataFrame:
    """Aggregates of the two halves of ``(ts - width, ts]``, as ``_own_*`` and ``_prev_*``.

    A sliding frame is recomputed for every row, which is quadratic for dense
    series. Instead time is cut into blocks of the frame's own length: a frame
    is then the start of its own block up to the row plus the end of the
    previous block. Each sample enters its own block and, moved by ``width``,
    the next one; two running aggregates, one in each direction, give both
    halves. Nothing is subtracted, so nothing cancels.
    """
    block = Window.partitionBy("_of", "_block")
    up_to_here = block.orderBy(F.col("_at"), F.col("_moved").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    after_here = block.orderBy(F.col("_at").desc(), F.col("_moved")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    halves = {}
    for name, (aggregate, column) in parts.items():
        own, previous = (F.when(F.col("_moved") == n, column) for n in (0, 1))
        halves[f"_own_{name}"] = aggregate(own).over(up_to_here)
        halves[f"_prev_{name}"] = aggregate(previous).over(after_here)
    return placed.withColumns(halves).where("_moved = 0")


def _both(name: str) -> Column:
    return F.coalesce(f"_own_{name}", F.lit(0)) + F.coalesce(f"_prev_{name}", F.lit(0))


def trailing(
    samples: DataFrame,
    series: Sequence[str],
    value: str,
    width: str,
    ts: str = "ts",
) -> DataFrame:
    """Add ``trail_sum`` and ``trail_count`` of ``value`` over ``(ts - width, ts]``."""
    return _trailing(samples, _placed(samples, series, width, ts), value)


def _trailing(samples: DataFrame, placed: DataFrame, value: str) -> DataFrame:
    parts = {"sum": (F.sum, F.col(value)), "count": (F.count, F.col(value))}
    return _halves(placed, parts).select(
        *samples.columns,
        _both("count").alias("trail_count"),
        F.when(_both("count") > 0, _both("sum")).alias("trail_sum"),
    )


def _rising(
    samples: DataFrame,
    placed: DataFrame,
    series: Sequence[str],
    length: int,
    ts: str,
    value: str,
    moved: bool,
) -> DataFrame:
    """``placed`` with the ``increase`` of each row since the sample before it.

    A group (``_of``, ``_block``) of ``placed`` holds the samples of its block and, if
    ``moved``, of the block before. So all but its first row find their predecessor in the
    group. The first row's comes from a summary with one row per series and block, which is
    combined before its shuffle; it is joined by the key that the rows are partitioned by
    already, so rows move once.
    """
    own = _block(F.unix_micros(ts), length).alias("_own")
    ends = samples.groupBy(F.struct(*series).alias("_of"), own).agg(F.max(F.struct(ts, value)).alias("_end"))
    blocks = Window.partitionBy("_of").orderBy("_own")
    last = F.lag("_end").over(blocks).alias("_last")
    if moved:
        older = F.last("_end").over(blocks.rangeBetween(Window.unboundedPreceding, -2)).alias("_older")
        ends = ends.select("_of", "_own", last, older, F.lead("_own").over(blocks).alias("_next"))
        # A block's samples are in its group and in the next one, which may have none of its own.
        groups = F.array(
            F.struct(F.col("_own").alias("_block"), F.col("_older").alias("_end")),
            F.struct((F.col("_own") + 1).alias("_block"), F.col("_last").alias("_end")),
        )
        carried = ends.select("_of", "_own", "_next", F.inline(groups))
        carried = carried.where((F.col("_block") == F.col("_own")) | ~F.col("_block").eqNullSafe(F.col("_next")))
    else:
        carried = ends.select("_of", F.col("_own").alias("_block"), last.alias("_end"))
    carried = carried.select("_of", "_block", F.col("_end")[value].alias("_carried"))
    inside = Window.partitionBy("_of", "_block").orderBy(F.col("_moved").desc(), ts, value)
    before = F.lag(F.struct(value)).over(inside)
    joined = placed.withColumn("_before", before).join(carried, ["_of", "_block"], "left")
    previous = F.when(F.col("_before").isNull(), F.col("_carried")).otherwise(F.col("_before")[value])
    return joined.withColumn("_previous", previous).withColumn(
        "increase",
        F.when(F.col(value) >= F.col("_previous"), F.col(value) - F.col("_previous")).when(
            F.col(value) < F.col("_previous"), F.col(value)
        ),
    )


def counter_increase(
    samples: DataFrame,
    series: Sequence[str],
    block: str = "1 hour",
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Add ``increase`` since the previous sample of the series.

    A fall means the counter was reset, so the whole value counts. The first
    sample of a series has none; after a NULL value there is none either.
    """
    length = micros_of(block)
    placed = samples.withColumns(
        {"_of": F.struct(*series), "_moved": F.lit(0), "_block": _block(F.unix_micros(ts), length)}
    )
    return _rising(samples, placed, series, length, ts, value, False).select(*samples.columns, "increase")


def counter_rate(
    samples: DataFrame,
    series: Sequence[str] = ("series",),
    width: str = "1 minute",
    ts: str = "ts",
    value: str = "value",
    extrapolate: bool = False,
) -> DataFrame:
    """Add ``rate``, the counter's increase per second over ``(ts - width, ts]``.

    By default all increases that end in the frame count, NULL where there is
    none. With ``extrapolate`` only those between two samples of the frame do,
    and they are stretched towards the frame's start the way metric servers do;
    a frame with one sample then has no rate.

    Samples are shuffled once: increases and running sums share the blocks of ``width``.
    """
    placed = _placed(samples, series, width, ts)
    rising = _rising(samples, placed, series, micros_of(width), ts, value, True)
    seconds = micros_of(width) / 1_000_000
    if not extrapolate:
        return _trailing(rising, rising, "increase").select(
            *samples.columns, (F.col("trail_sum") / seconds).alias("rate")
        )
    rise = F.coalesce("increase", F.lit(0.0))
    micros = F.unix_micros(ts)
    sample = F.struct(micros.alias("at"), F.col(value).alias("value"), rise.alias("rise"))
    parts = {"sum": (F.sum, rise), "count": (F.count, micros), "first": (F.min, sample)}
    framed = _halves(rising, parts).withColumn(
        "_first", F.coalesce("_prev_first", "_own_first")
    )
    framed = framed.withColumns(
        {
            "_rise": _both("sum") - F.col("_first.rise"),
            "_span": (micros - F.col("_first.at")) / 1_000_000,
            "_gaps": _both("count") - 1,
        }
    )
    mean_gap = F.col("_span") / F.col("_gaps")
    to_start = F.lit(seconds) - F.col("_span")
    # Fixed value: a start further off than 1.1 mean gaps is reached by half a gap.
    to_start = F.when(to_start >= mean_gap * 1.1, mean_gap / 2).otherwise(to_start)
    # A counter is not stretched below zero.
    to_zero = F.col("_span") * F.col("_first.value") / F.col("_rise")
    to_start = F.when(
        (F.col("_rise") > 0) & (F.col("_first.value") >= 0), F.least(to_start, to_zero)
    ).otherwise(to_start)
    stretched = F.col("_rise") * (F.col("_span") + to_start) / F.col("_span") / seconds
    return framed.select(
        *samples.columns,
        F.when((F.col("_gaps") > 0) & (F.col("_span") > 0), stretched).alias("rate"),
    )


def avg_over_time(
    samples: DataFrame,
    series: Sequence[str] = ("series",),
    width: str = "5 minutes",
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Add ``mean`` of the series over ``(ts - width, ts]``."""
    return trailing(samples, series, value, width, ts).select(
        *samples.columns, (F.col("trail_sum") / F.col("trail_count")).alias("mean")
    )


def busy_by_instance(
    samples: DataFrame,
    mode: str = "idle",
    width: str = "5 minutes",
    step: str | None = None,
    block: str = "1 hour",
    series: str = "series",
    instance: str = "instance",
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """``100 - 100 * mean idle rate`` of an instance's series at every step.

    Evaluated at multiples of ``step`` (the width itself by default) over
    ``(at - width, at]``; plain grouped sums, combined before the shuffle.
    """
    idle = samples.where(F.col("mode") == mode)
    rising = counter_increase(idle, [instance, series], block, ts, value)
    # A window is closed on the left; one microsecond earlier makes it closed on the right.
    frame = F.window(F.col(ts) - F.expr("INTERVAL 1 MICROSECOND"), width, step or width)
    rates = rising.groupBy(frame.alias("_frame"), instance, series).agg(
        (F.sum("increase") / (micros_of(width) / 1_000_000)).alias("_rate")
    )
    # A series' first sample has no rate; an instance with none has no row.
    rates = rates.where("_rate IS NOT NULL")
    return rates.groupBy("_frame", instance).agg(
        (F.lit(100.0) - F.avg("_rate") * 100).alias("busy_percent")
    ).select(F.col("_frame.end").alias("at_time"), instance, "busy_percent")


def gauge_latest(
    samples: DataFrame, series: Sequence[str] = ("series",), ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Newest value of each series."""
    return samples.groupBy(*series).agg(
        F.max(ts).alias(ts), F.max_by(value, ts).alias(value)
    )


def gauge_avg(
    samples: DataFrame, series: Sequence[str] = ("series",), ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Mean over the series' newest values."""
    return gauge_latest(samples, series, ts, value).agg(F.avg(value).alias("value"))
