"""The training-data pipeline: quality rules, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All
but the last return the columns of ``documents``, further ones too, whatever their names: a
stage carries them in one struct. Null texts have no words and fail the quality rules; a null id is one document; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm import linededup, mixing, neardup, packing, quality
from tidewatch.llm.queries import repeating_weights
from tidewatch.llm.text import word_count
from tidewatch.session import materialize


#: Times that the mix may take a document.
MAX_COPIES = 3


def named(column: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def folded(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, so that none of their names can meet a stage's own."""
    return F.struct(*[named(c).alias(c) for c in docs.columns]).alias("row")


def unfolded(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep. Texts are measured once."""
    rows = materialize(docs.select(folded(docs), quality.measure(F.col("text")).alias("counts")), "pipeline-measured")
    measured = rows.select(
        F.col("row.doc_id").alias("doc_id"), quality.stratum_key(F.col("row.lang")).alias("stratum"), "counts"
    )
    cutoffs = materialize(
        quality.fit_cutoffs(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")), "pipeline-cutoffs"
    )
    judged = quality.judge(rows, cutoffs, counts="counts", stratum=F.col("row.lang"))
    return unfolded(judged.where("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one holds; ``n_chars`` follows the text."""
    kept = linededup.dedup_lines(docs.select("doc_id", "text", folded(docs)))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return unfolded(kept, docs, **new)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, on shingles of five words."""
    found = neardup.near_duplicates(docs)
    kept = found.where("doc = component").select(F.col("doc").alias("id")).distinct()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(neardup.NO_ID)).alias("id"), folded(docs))
    return unfolded(rows.join(kept, "id", "left_semi"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times.

    Rows of one id, source and text are alike for the mix; it says how many of them come at
    least once, twice and three times, and they take these places in the order of their
    further columns. Texts are shuffled once, to meet those numbers.
    """
    alike = F.to_json(F.struct(F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("mark")))
    sized = docs.select(
        "doc_id", F.array("source").alias("sources"), word_count(F.col("text")).alias("size"), alike.alias("alike")
    )
    chosen, _, _ = mixing.mix(sized, weights=repeating_weights, max_copies=MAX_COPIES, also=("alike",))
    times = range(1, MAX_COPIES + 1)
    taken = (
        chosen.where("copies > 0")
        .groupBy("alike")
        .agg(F.array(*[F.count_if(F.col("copies") >= n) for n in times]).alias("many"))
    )
    further = [named(c).alias(c) for c in docs.columns if c not in ("doc_id", "source", "text")]
    rows = docs.select(alike.alias("alike"), F.to_json(F.struct(F.lit(0), *further)).alias("rest"), folded(docs))
    place = F.row_number().over(Window.partitionBy("alike").orderBy("rest"))
    met = rows.join(taken, "alike").withColumn("place", place)
    copies = F.size(F.filter("many", lambda n: n >= F.col("place")))
    return unfolded(met.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("pack", pack),
]

#: SQL can't tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
