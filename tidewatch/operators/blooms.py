"""A mergeable Bloom filter kept beside an index, so that most ids need no join to be known as new.

A filter is rows (cell, bits): 64 bits of a cell each, ``WORDS`` cells to a segment. An id
sets four bits within one segment. Filters of the same number of segments merge by OR, so
batches append theirs. The broadcast form has ``segments`` x 8 KB however many ids it holds;
beyond about ten million ids per 1024 segments more known ids and more new ones go on to the
exact join, which decides in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.joins import without

#: Cells of 64 bits per segment: 16 bits of a hash name a bit.
WORDS = 1024

#: 8 MB when broadcast.
SEGMENTS = 1024

FILTER = "cell long, bits long, batch long"

_HASHES = 4


def _segment(key: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(segments).cast("long"))


def _places(key: Column) -> list[Column]:
    """Places of the id's bits within its segment, 0 to 65535."""
    spread = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(spread, 16 * n).bitwiseAND(F.lit(0xFFFF)) for n in range(_HASHES)]


def id_filter(ids: DataFrame, key: str, segments: int = SEGMENTS) -> DataFrame:
    """The filter of the ids in column ``key``, read as text; NULL is no id."""
    named = ids.select(F.col(key).cast("string").alias("_id")).where("_id IS NOT NULL")
    placed = named.select(
        (_segment(F.col("_id"), segments) * WORDS).alias("_first"), F.explode(F.array(*_places(F.col("_id")))).alias("_place")
    )
    bit = F.expr("shiftleft(1L, CAST(_place & 63 AS INT))")
    cell = F.col("_first") + F.shiftright("_place", 6)
    return placed.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits"))


def append_filter(ids: DataFrame, key: str, path: str, batch: int, segments: int = SEGMENTS) -> None:
    """Add the ids of a batch to the stored filter; a batch that comes again replaces itself."""
    rows = id_filter(ids, key, segments).withColumn("batch", F.lit(batch).cast("long"))
    writer = rows.coalesce(1).write.partitionBy("batch").mode("overwrite")  # at most segments x WORDS rows
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def stored_filter(spark: SparkSession, path: str) -> DataFrame:
    """All batches' filters as rows that :func:`flagged` merges."""
    return spark.read.schema(FILTER).parquet(path).select("cell", "bits")


def _segments_of(filter_rows: DataFrame, segments: int) -> DataFrame:
    """One row per segment with all its cells in order; merges equal cells."""
    spark = filter_rows.sparkSession
    empty = spark.range(segments * WORDS).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("bits"))
    merged = filter_rows.select("cell", "bits").unionByName(empty).groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    segment = F.floor(F.col("cell") / WORDS).alias("_segment")
    cells = F.sort_array(F.collect_list(F.struct("cell", "bits")))
    return merged.groupBy(segment).agg(F.transform(cells, lambda c: c["bits"]).alias("_cells"))


def flagged(rows: DataFrame, key: str, filter_rows: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """``rows`` with ``_maybe``: false if the filter says that the id is not in it; NULL ids aren't."""
    named = rows.withColumn("_id", F.col(key).cast("string"))
    named = named.withColumn("_segment", _segment(F.col("_id"), segments))
    met = named.join(F.broadcast(_segments_of(filter_rows, segments)), "_segment")
    maybe = F.col("_id").isNotNull()
    for place in _places(F.col("_id")):
        cell = F.get("_cells", F.shiftright(place, 6).cast("int"))
        maybe &= F.call_function("shiftrightunsigned", cell, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return met.select(*rows.columns, maybe.alias("_maybe"))


def suspects(candidates: DataFrame, known: DataFrame, key: str, filter_rows: DataFrame, segments: int = SEGMENTS):
    """(candidates that are surely new, the others, known ids that those others may be).

    Only the last two have to meet, so only they are shuffled.
    """
    marked = flagged(candidates, key, filter_rows, segments)
    new, unsure = (marked.where(F.col("_maybe") == flag).drop("_maybe") for flag in (False, True))
    seen = known.select(F.col(key).cast("string").alias("_known"))
    near = flagged(seen, "_known", id_filter(unsure, key, segments), segments).where("_maybe").drop("_maybe")
    return new, unsure, near


def new_rows(
    candidates: DataFrame, known: DataFrame, key: str, filter_rows: DataFrame, segments: int = SEGMENTS
) -> DataFrame:
    """What :func:`tidewatch.operators.dedupe.id_difference` gives, by way of the filter of ``known``.

    The filter must hold every known id; it may hold others. Repeated candidates and NULL
    keys stay. Both sides are read twice, narrowly the second time, and neither is shuffled whole.
    """
    new, unsure, near = suspects(candidates, known, key, filter_rows, segments)
    named = unsure.withColumn("_known", F.col(key).cast("string"))
    return new.unionByName(without(named, near, ["_known"]).select(*candidates.columns))
