"""Violent-event windows as searchable text, and answers assembled from hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import text as wording
from tidewatch.operators.dedupe import id_difference

Encoder = Callable[[Sequence[str]], np.ndarray]

VECTOR_SIZE = 384


def _shown(events: DataFrame, name: str) -> Column:
    """A value as the sentence shows it; a missing column or NULL reads as unknown."""
    if name not in events.columns:
        return F.lit(wording.UNKNOWN[name])
    value = F.col(name).cast("string")
    if dict(events.dtypes)[name] == "timestamp":
        value = F.concat(value, F.date_format(name, "xxx"))
    return F.coalesce(value, F.lit(wording.UNKNOWN[name]))


def build_event_text(
    events: DataFrame,
    template: str = wording.EVENT_TEMPLATE,
    notes_template: str = wording.NOTES_TEMPLATE,
) -> DataFrame:
    """Events beside a sentence: id, camera, time, label, score, notes if there are any."""
    score = F.col("score") if "score" in events.columns else F.lit(0.0)
    label = F.col("label") if "label" in events.columns else F.lit("")
    sentence = wording.fill(
        template,
        {
            "event_id": _shown(events, "event_id"),
            "camera_id": _shown(events, "camera_id"),
            "timestamp_utc": _shown(events, "timestamp_utc"),
            "label": F.when(F.upper(label) == "VIOLENCE", wording.VIOLENT_WORD).otherwise(
                wording.NORMAL_WORD
            ),
            "score": F.col("_score"),
        },
    )
    if "extra" in events.columns:
        notes = F.col("extra")["notes"]
        noted = wording.fill(notes_template, {"notes": notes})
        sentence = F.concat(sentence, F.when(notes != "", noted).otherwise(""))
    scored = wording.with_two_digits(events, score, "_score")
    return scored.withColumn("text", sentence).drop("_score")


def event_metadata(events: DataFrame) -> Column:
    """Filterable attributes of a document; missing or NULL text is empty, score 0."""

    def text_of(name: str) -> Column:
        if name not in events.columns:
            return F.lit("")
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    score = F.col("score").cast("double") if "score" in events.columns else F.lit(None)
    return F.struct(
        *[text_of(n).alias(n) for n in ("event_id", "camera_id", "date", "label")],
        F.coalesce(F.nanvl(score.cast("double"), F.lit(0.0)), F.lit(0.0)).alias("score"),
        text_of("frame_s3_path").alias("frame_s3_path"),
    )


def build_event_docs(events: DataFrame, **templates: str) -> DataFrame:
    """Events as (id, text, metadata); the id hashes the event id, so upserts replace."""
    return build_event_text(events, **templates).select(
        F.sha2(F.col("event_id").cast("string"), 256).alias("id"),
        "text",
        event_metadata(events).alias("metadata"),
    )


def ingest_incremental(events: DataFrame, indexed: DataFrame | None) -> DataFrame:
    """Documents of the events whose id is not indexed yet."""
    fresh = events if indexed is None else id_difference(events, indexed, "event_id")
    return build_event_docs(fresh)


def embed_hashed(
    rows: DataFrame, text: str = "text", out: str = "embedding", size: int = VECTOR_SIZE
) -> DataFrame:
    """Unit-length hashed term counts of the whole text; needs no model file."""
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=size)
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    worded = words.transform(rows.withColumn("_text", F.coalesce(text, F.lit(""))))
    vectors = unit.transform(counts.transform(worded))
    return vectors.withColumn(out, vector_to_array("_unit", "float32")).drop(
        "_text", "_words", "_counts", "_unit"
    )


def embed_documents(
    rows: DataFrame,
    load_encoder: Callable[[], Encoder] | None = None,
    text: str = "text",
    out: str = "embedding",
) -> DataFrame:
    """Add a vector per text.

    ``load_encoder`` builds the model; it is called once per task and the model
    then sees Arrow batches of texts. Without it terms are hashed.
    """
    if load_encoder is None:
        return embed_hashed(rows, text, out)

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for batch in batches:
            vectors = np.asarray(encoder(batch.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(vectors), index=batch.index)

    return rows.withColumn(out, encode(text))


def extract_filters(questions: DataFrame, question: str = "question") -> DataFrame:
    """Add the camera and date a question names, NULL when it names none.

    The first mention wins; the date's validity is not checked.
    """
    return questions.withColumns(
        {
            "camera_id": wording.first_match(F.lower(question), wording.CAMERA_PATTERN),
            "date": wording.first_match(F.col(question), wording.DATE_PATTERN),
        }
    )


def assemble_context(
    questions: DataFrame, hits: DataFrame, question_id: str = "question_id"
) -> DataFrame:
    """Per question its hits, nearest first, as one bulleted text.

    A question without hits gets the fixed message. A question has at most ``k``
    hits, so its list is small.
    """
    gathered = hits.groupBy(question_id).agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "text", "metadata", "distance"))).alias(
            "_hits"
        )
    )
    listed = gathered.select(
        question_id,
        F.transform(
            "_hits", lambda h: F.struct(h["id"], h["text"], h["metadata"], h["distance"])
        ).alias("data_sources"),
        F.concat(
            F.lit(wording.RETRIEVAL_HEADING),
            wording.bulleted(F.transform("_hits", lambda h: h["text"])),
        ).alias("answer"),
    )
    none = F.array().cast(listed.schema["data_sources"].dataType)
    return questions.join(listed, question_id, "left").withColumns(
        {
            "answer": F.coalesce("answer", F.lit(wording.NOTHING_FOUND)),
            "data_sources": F.coalesce("data_sources", none),
        }
    )


def answer_prompt(responses: DataFrame) -> DataFrame:
    """Add ``prompt``: question and context in one text for a language model.

    NULL where nothing was found, or nothing asked.
    """
    context = wording.bulleted(F.transform("data_sources", lambda h: h["text"]))
    filled = wording.fill(wording.PROMPT_TEMPLATE, {"question": F.col("question"), "context": context})
    return responses.withColumn("prompt", F.when(F.size("data_sources") > 0, filled))
