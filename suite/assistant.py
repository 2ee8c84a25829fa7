"""Retrieval: sentences, documents, vectors, search, context and answers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from suite.catalog import query
from suite.star import keyed_of
from suite.views import VECTORS_SQL, rollup_sql, table, vector_questions, vectors
from tidewatch.functions import text as wording
from tidewatch.operators import knn, postings, retrieval, star
from tidewatch.plans import assistant

# Violent windows of a day; some carry notes, some another label or no score.
_EVENTS_SQL = rollup_sql("1 day") + """, noted AS (
  SELECT fact_id AS event_id, window_start AS timestamp_utc, camera_id,
    CASE WHEN ward <> 'BUILDING' THEN max_risk_score END AS score,
    CASE ward WHEN 'FURNITURE' THEN 'other' WHEN 'MACHINERY' THEN NULL
      WHEN 'HOUSEHOLD' THEN 'Violence' ELSE 'VIOLENCE' END AS label,
    strftime(window_start, '%Y-%m-%d') AS date,
    CASE WHEN risk_level = 'high' THEN evidence_url WHEN risk_level = 'low' THEN '' END AS notes,
    evidence_url AS frame_s3_path
  FROM keyed WHERE is_violent_window)"""

_TEXT_SQL = """concat('Sự kiện ', event_id, ' được ghi nhận tại camera ', camera_id,
  ' vào lúc ', strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S'), '+00:00. ',
  'Hệ thống phân tích hình ảnh đánh giá đây là hành vi ',
  CASE WHEN upper(label) = 'VIOLENCE' THEN 'BẠO LỰC' ELSE 'bình thường' END,
  ' với mức độ tin cậy ', CASE WHEN score IS NULL THEN 'nan' ELSE printf('%.2f', score) END, '.',
  CASE WHEN notes <> '' THEN concat(' Ghi chú hệ thống: ', notes, '.') ELSE '' END)"""

_DOC_SQL = f"""SELECT sha256(event_id) AS id, {_TEXT_SQL} AS text, event_id, camera_id, date,
  coalesce(label, '') AS label, coalesce(score, 0.0) AS score,
  coalesce(frame_s3_path, '') AS frame_s3_path"""


def noted_events(spark, sf_dir):
    ward = F.col("ward")
    return star.violent_windows(keyed_of(spark, sf_dir, "1 day")).select(
        F.col("fact_id").alias("event_id"),
        F.col("window_start").alias("timestamp_utc"),
        "camera_id",
        F.when(ward != "BUILDING", F.col("max_risk_score")).alias("score"),
        F.when(ward == "FURNITURE", "other")
        .when(ward == "MACHINERY", None)
        .when(ward == "HOUSEHOLD", "Violence")
        .otherwise("VIOLENCE")
        .alias("label"),
        F.date_format("window_start", "yyyy-MM-dd").alias("date"),
        F.struct(
            F.when(F.col("risk_level") == "high", F.col("evidence_url"))
            .when(F.col("risk_level") == "low", "")
            .alias("notes")
        ).alias("extra"),
        F.col("evidence_url").alias("frame_s3_path"),
    )


def _flat(docs):
    return docs.select("id", "text", "metadata.*")


@query("build_event_text", _EVENTS_SQL + f" SELECT event_id, {_TEXT_SQL} AS text FROM noted")
def build_event_text(spark, sf_dir):
    return retrieval.build_event_text(noted_events(spark, sf_dir)).select("event_id", "text")


@query("build_event_docs", _EVENTS_SQL + f" {_DOC_SQL} FROM noted")
def build_event_docs(spark, sf_dir):
    return _flat(retrieval.build_event_docs(noted_events(spark, sf_dir)))


@query(
    "ingest_incremental",
    _EVENTS_SQL + f" {_DOC_SQL} FROM noted WHERE timestamp_utc >= TIMESTAMP '2024-01-15'",
)
def ingest_incremental(spark, sf_dir):
    """The first half of the month is indexed already."""
    events = noted_events(spark, sf_dir)
    indexed = retrieval.build_event_docs(events.where("timestamp_utc < '2024-01-15'"))
    return _flat(retrieval.ingest_incremental(events, assistant.indexed_ids(indexed)))


@query(
    "embed_documents",
    r"""SELECT doc_id, 384 AS dims,
      CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0 END AS norm
    FROM documents""",
)
def embed_documents(spark, sf_dir):
    """Length and norm of the vector of every whole text."""
    vectors_of = retrieval.embed_documents(table(spark, sf_dir, "documents"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return vectors_of.select(
        "doc_id", F.size("embedding").alias("dims"), F.round(norm, 4).alias("norm")
    )


_QUESTIONS_SQL = """questions AS (
  SELECT conv_id * 1000 + turn AS question_id, conv_id,
    CASE WHEN turn % 6 = 2 THEN concat(chr(9), '  ', chr(10))
      ELSE concat('Alerts at CAM', CAST(conv_id % 10 AS VARCHAR),
        CASE WHEN turn % 6 = 0 THEN concat(' on 2024-01-0', CAST(conv_id % 5 + 1 AS VARCHAR))
          ELSE '' END, ': ', text) END AS question
  FROM conversations WHERE role = 'user'
)"""


def questions(spark, sf_dir):
    """User turns that name a camera, a camera and a day, or are blank."""
    turn, conv = F.col("turn"), F.col("conv_id")
    day = F.when(
        turn % 6 == 0, F.concat(F.lit(" on 2024-01-0"), (conv % 5 + 1).cast("string"))
    ).otherwise("")
    asked = F.concat(
        F.lit("Alerts at CAM"), (conv % 10).cast("string"), day, F.lit(": "), F.col("text")
    )
    return (
        table(spark, sf_dir, "conversations")
        .where("role = 'user'")
        .select(
            (conv * 1000 + turn).alias("question_id"),
            "conv_id",
            F.when(turn % 6 == 2, "\t  \n").otherwise(asked).alias("question"),
        )
    )


@query(
    "extract_filters",
    f"""WITH {_QUESTIONS_SQL} SELECT question_id,
      nullif(regexp_extract(lower(question), 'cam\\d+'), '') AS camera_id,
      nullif(regexp_extract(question, '\\d{{4}}-\\d{{2}}-\\d{{2}}'), '') AS date
    FROM questions""",
)
def extract_filters(spark, sf_dir):
    return retrieval.extract_filters(questions(spark, sf_dir)).drop("conv_id", "question")


def _ranked_sql(questions_sql: str, match: str, pairs: str) -> str:
    return f"""SELECT * FROM (SELECT q.question_id, v.id,
        round(1 - list_cosine_similarity(q.embedding, v.embedding), 9) + 0.0 AS distance,
        row_number() OVER (PARTITION BY q.question_id
          ORDER BY round(1 - list_cosine_similarity(q.embedding, v.embedding), 9), v.id) AS rank
      FROM {questions_sql} q JOIN {pairs} v ON {match}) r WHERE rank <= 6"""


_MATCH = """(q.camera_id IS NULL OR q.camera_id = v.camera_id)
  AND (q.date IS NULL OR q.date = v.date)"""


@query(
    "topk_similarity",
    f"""WITH {VECTORS_SQL} SELECT question_id, id, CAST(rank AS INTEGER) AS rank,
      round(distance, 6) AS distance
    FROM ({_ranked_sql('vectors_q', 'true', 'vectors')}) h""".replace(
        "vectors_q", "(SELECT id AS question_id, embedding FROM vectors)"
    ),
)
def topk_similarity(spark, sf_dir):
    found = vectors(spark, sf_dir)
    asked = found.select(F.col("id").alias("question_id"), "embedding")
    return knn.topk_similarity(asked, found).withColumn("distance", F.round("distance", 6))


_FILTERED_SQL = f"""WITH {VECTORS_SQL} SELECT question_id, id, camera_id, date,
      CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance
    FROM ({_ranked_sql('vector_questions', _MATCH, 'vectors')}) h JOIN vectors v USING (id)"""


@query("knn_filtered", _FILTERED_SQL)
def knn_filtered(spark, sf_dir):
    found = knn.knn_filtered(
        vector_questions(spark, sf_dir), vectors(spark, sf_dir), payload=("camera_id", "date")
    )
    return found.withColumn("distance", F.round("distance", 6))


@query("knn_filtered_many_questions", _FILTERED_SQL)
def knn_filtered_many_questions(spark, sf_dir):
    """More questions than one pass holds: several passes, the same hits."""
    asked = vector_questions(spark, sf_dir)
    found = knn.knn_filtered(
        asked, vectors(spark, sf_dir), payload=("camera_id", "date"), questions_per_pass=400
    )
    return found.withColumn("distance", F.round("distance", 6))


@query("knn_filtered_postings", _FILTERED_SQL)
def knn_filtered_postings(spark, sf_dir):
    """The same hits; documents and questions meet on the values of the filters."""
    found = postings.knn_postings(
        vector_questions(spark, sf_dir), vectors(spark, sf_dir), payload=("camera_id", "date")
    )
    return found.withColumn("distance", F.round("distance", 6))


@query("knn_quantised")
def knn_quantised(spark, sf_dir):
    """Per question how many of its six exact neighbours a search by codes finds, comparing 60 vectors."""
    found = vectors(spark, sf_dir)
    asked = found.select(F.col("id").alias("question_id"), "embedding")
    exact = knn.topk_similarity(asked, found)
    quantizer = postings.fit_quantizer(found)
    near = postings.knn_quantised(asked, postings.add_codes(found, quantizer), quantizer)
    both = exact.join(near.select("question_id", "id", F.lit(1).alias("hit")), ["question_id", "id"], "left")
    return both.groupBy("question_id").agg((F.count("hit") / F.count("*")).alias("recall"))


@query("knn_approx")
def knn_approx(spark, sf_dir):
    """Per question how many of its six exact neighbours the probed cells hold."""
    found = vectors(spark, sf_dir)
    asked = found.select(F.col("id").alias("question_id"), "embedding")
    exact = knn.topk_similarity(asked, found)
    centers = knn.train_cells(found)
    near = knn.knn_approx(asked, knn.assign_cells(found, centers), centers)
    both = exact.join(near.select("question_id", "id", F.lit(1).alias("hit")), ["question_id", "id"], "left")
    return both.groupBy("question_id").agg((F.count("hit") / F.count("*")).alias("recall"))


@query(
    "knn_approx_cells",
    f"""WITH {VECTORS_SQL}, centers AS (SELECT id AS cell, embedding FROM vectors WHERE id < 24),
    near AS (
      SELECT v.id, c.cell, row_number() OVER (
        PARTITION BY v.id ORDER BY list_cosine_similarity(v.embedding, c.embedding) DESC, c.cell) AS place
      FROM vectors v, centers c
    ), probed AS (
      SELECT q.id AS question_id, v.*
      FROM near q JOIN near d ON q.cell = d.cell AND q.place <= 6 AND d.place = 1 JOIN vectors v ON v.id = d.id
    ) SELECT question_id, id, CAST(rank AS INTEGER) AS rank FROM (
      SELECT p.question_id, p.id, row_number() OVER (PARTITION BY p.question_id
        ORDER BY round(1 - list_cosine_similarity(q.embedding, p.embedding), 9), p.id) AS rank
      FROM probed p JOIN vectors q ON q.id = p.question_id) r WHERE rank <= 6""",
)
def knn_approx_cells(spark, sf_dir):
    """The nearest inside the six probed cells of 24, around centres that are given."""
    found = vectors(spark, sf_dir)
    rows = found.where("id < 24").orderBy("id").collect()
    centers = np.array([r.embedding for r in rows], dtype=np.float64)
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    asked = found.select(F.col("id").alias("question_id"), "embedding")
    near = knn.knn_approx(asked, knn.assign_cells(found, centers), centers, probes=6)
    return near.select("question_id", "id", "rank")


def letter_encoder():
    """An encoder SQL can repeat: one, and how often each letter occurs, small or capital."""

    def load():
        letters = [chr(ord("a") + n) for n in range(26)]

        def encode(texts):
            return np.array([[1.0, *[t.count(c) + t.count(c.upper()) for c in letters]] for t in texts]).reshape(-1, 27)

        return encode

    return load


def _letters_sql(text: str) -> str:
    return f"""list_prepend(1.0::DOUBLE, [CAST(length({text}) - length(replace(replace({text},
      chr(CAST(97 + n AS INTEGER)), ''), chr(CAST(65 + n AS INTEGER)), '')) AS DOUBLE) FOR n IN range(26)])"""


_CHAT_DOCS_SQL = f"""chat_docs AS (
  SELECT doc_id AS id, text, {_letters_sql("coalesce(text, '')")} AS embedding,
    concat('cam', CAST(doc_id % 10 AS VARCHAR)) AS camera_id,
    concat('2024-01-0', CAST(doc_id // 10 % 5 + 1 AS VARCHAR)) AS date
  FROM documents
)"""
_CHAT_SQL = f"""WITH {_QUESTIONS_SQL}, {_CHAT_DOCS_SQL}, asked AS (
  SELECT question_id, trim(question, concat(' ', chr(9), chr(10), chr(13))) AS question,
    {_letters_sql("question")} AS embedding,
    nullif(regexp_extract(lower(question), 'cam\\d+'), '') AS camera_id,
    nullif(regexp_extract(question, '\\d{{4}}-\\d{{2}}-\\d{{2}}'), '') AS date
  FROM questions
), hits AS ({_ranked_sql("asked", "q.question <> '' AND " + _MATCH, "chat_docs")}
), answers AS (
  SELECT h.question_id, string_agg(concat('- ', d.text), chr(10) || chr(10) ORDER BY h.rank) AS context,
    string_agg(CAST(h.id AS VARCHAR), ',' ORDER BY h.rank) AS sources
  FROM hits h JOIN chat_docs d ON d.id = h.id GROUP BY h.question_id
)"""


def chat_documents(spark, sf_dir):
    """All documents with the vectors of their texts, as an index holds them."""
    id_ = F.col("doc_id")
    day = (F.floor(id_ / 10) % 5 + 1).cast("string")
    metadata = F.struct(
        id_.cast("string").alias("event_id"),
        F.concat(F.lit("cam"), (id_ % 10).cast("string")).alias("camera_id"),
        F.concat(F.lit("2024-01-0"), day).alias("date"),
    )
    texts = table(spark, sf_dir, "documents").select(id_.alias("id"), "text", metadata.alias("metadata"))
    return retrieval.embed_documents(texts, letter_encoder())


def chat_responses(spark, sf_dir):
    """Questions and documents are embedded by the same encoder."""
    asked = questions(spark, sf_dir).drop("conv_id")
    return assistant.chat_response_rows(asked, chat_documents(spark, sf_dir), load_encoder=letter_encoder())


@query(
    "assemble_context",
    _CHAT_SQL
    + f""" SELECT q.question_id, md5(CASE WHEN a.context IS NULL THEN '{wording.NOTHING_FOUND}'
      ELSE concat('Kết quả truy xuất:', chr(10), a.context) END) AS answer
    FROM asked q LEFT JOIN answers a ON a.question_id = q.question_id WHERE q.question <> ''""",
)
def assemble_context(spark, sf_dir):
    responses = chat_responses(spark, sf_dir)
    return responses.where("error IS NULL").select("question_id", F.md5("answer").alias("answer"))


@query(
    "answer_prompt",
    _CHAT_SQL
    + f""" SELECT q.question_id, md5(replace(replace('{wording.PROMPT_TEMPLATE}', '{{question}}', q.question),
      '{{context}}', a.context)) AS prompt
    FROM asked q JOIN answers a ON a.question_id = q.question_id WHERE q.question <> ''""",
)
def answer_prompt(spark, sf_dir):
    responses = chat_responses(spark, sf_dir)
    prompts = retrieval.answer_prompt(responses).where("prompt IS NOT NULL")
    return prompts.select("question_id", F.md5("prompt").alias("prompt"))


@query(
    "chat_response_rows",
    _CHAT_SQL
    + f""" SELECT q.question_id, q.question, q.camera_id, q.date,
      CASE WHEN q.question <> '' THEN coalesce(a.sources, '') END AS sources,
      CASE WHEN q.question = '' THEN '{wording.BLANK_QUESTION}' END AS error
    FROM asked q LEFT JOIN answers a ON a.question_id = q.question_id""",
)
def chat_response_rows(spark, sf_dir):
    responses = chat_responses(spark, sf_dir)
    return responses.select(
        "question_id",
        "question",
        "filters_applied.camera_id",
        "filters_applied.date",
        F.array_join(F.transform("data_sources", lambda h: h["id"].cast("string")), ",").alias(
            "sources"
        ),
        "error",
    )


@query(
    "update_index",
    _EVENTS_SQL
    + """ SELECT sha256(event_id) AS id, event_id,
      CASE WHEN timestamp_utc < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS version, 384 AS dims
    FROM noted""",
)
def update_index(spark, sf_dir):
    """Sentences of the violent windows worded, embedded and indexed in two runs."""
    events = noted_events(spark, sf_dir)
    first = assistant.update_index(None, events.where("timestamp_utc < '2024-01-15'"))
    second = assistant.update_index(first, events, version=1)
    return second.select("id", "metadata.event_id", "version", F.size("embedding").alias("dims"))
