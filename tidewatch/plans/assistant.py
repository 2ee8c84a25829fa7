"""Index of violent events, and answers to batches of questions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import text as wording
from tidewatch.operators import retrieval
from tidewatch.operators.dedupe import known_ids, union_upsert
from tidewatch.operators.knn import knn_filtered
from tidewatch.session import materialize

HITS = 6


def indexed_ids(documents: DataFrame) -> DataFrame:
    """Event ids the index already holds."""
    return known_ids(documents.select(F.col("metadata.event_id").alias("event_id")))


def update_index(
    documents: DataFrame | None,
    events: DataFrame,
    load_encoder: Callable[[], retrieval.Encoder] | None = None,
    version: int = 0,
    work_path: str | None = None,
) -> DataFrame:
    """The index with documents of new events laid over it.

    Only events that are not indexed are worded and embedded. Their documents are
    written once, to ``work_path`` or a fresh shared folder, so that the merge
    does not encode them again.
    """
    known = None if documents is None else indexed_ids(documents)
    fresh = retrieval.ingest_incremental(events, known)
    embedded = retrieval.embed_documents(fresh, load_encoder).withColumn("version", F.lit(version))
    incoming = materialize(embedded, "documents", work_path)
    return union_upsert(documents, incoming)


def _respond(
    questions: DataFrame, documents: DataFrame, k: int, filters: Sequence[str]
) -> DataFrame:
    asked = questions.withColumn("question", wording.stripped(F.coalesce("question", F.lit(""))))
    blank = F.col("question") == ""
    told = retrieval.extract_filters(asked.where(~blank))
    searchable = documents.select(
        "id", "text", "metadata", "embedding", *[F.col(f"metadata.{f}").alias(f) for f in filters]
    )
    hits = knn_filtered(told, searchable, k, filters, ("text", "metadata"))
    answered = retrieval.assemble_context(told.drop("embedding"), hits).select(
        "question_id",
        "question",
        "answer",
        F.when(
            F.coalesce(*filters).isNotNull(), F.struct(*filters)
        ).alias("filters_applied"),
        "data_sources",
        F.lit(None).cast("string").alias("error"),
    )
    rejected = asked.where(blank).select(
        "question_id", "question", F.lit(wording.BLANK_QUESTION).alias("error")
    )
    return answered.unionByName(rejected, allowMissingColumns=True)


def chat_response_rows(
    questions: DataFrame,
    documents: DataFrame,
    k: int = HITS,
    load_encoder: Callable[[], retrieval.Encoder] | None = None,
) -> DataFrame:
    """One response per question (question_id, question).

    Blank questions get an error. Others get the filters they name, their
    nearest documents under those filters, and the documents' text as answer.
    Questions that bring an ``embedding`` keep it.
    """
    ready = questions
    if "embedding" not in questions.columns:
        ready = retrieval.embed_documents(questions, load_encoder, text="question")
    return _respond(ready, documents, k, ("camera_id", "date"))
