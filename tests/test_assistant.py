import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text, times
from tidewatch.operators import knn, retrieval
from tidewatch.plans import assistant

EVENT = "event_id string, camera_id string, timestamp_utc timestamp, label string, score double, extra struct<notes: string>"
AT = dt.datetime(2025, 1, 1, 10, 5)


def test_two_digits_matches_exact_rounding(spark):
    rng = np.random.default_rng(1)
    values = [0.125, 0.375, 2.675, 1.005, 0.0, 1.0, 0.995, 9.995, 123456.785, -0.125, -2.675, 1e-9]
    values += list(rng.random(3000)) + list(np.round(rng.random(3000), 3)) + list(rng.integers(0, 9999, 500) / 8)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r.shown for r in text.with_two_digits(frame, F.col("v"), "shown").collect()]
    assert got == [f"{v:.2f}" for v in values]
    large = [1e16, -9007199254740992.0, float("inf"), float("-inf"), 9007199254740991.0, 45035996273704.125]
    out = text.with_two_digits(spark.createDataFrame([(v,) for v in large], "v double"), F.col("v"), "shown")
    assert [r.shown for r in out.collect()] == [f"{v:.2f}" for v in large]
    gone = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    out = text.with_two_digits(gone, F.col("v"), "shown")
    assert out.columns == ["v", "shown"] and [r.shown for r in out.collect()] == ["nan", "nan"]


def sentence(spark, **fields):
    row = ("e1", "cam01", AT, fields.get("label", "VIOLENCE"), fields.get("score", 0.875), fields.get("extra"))
    return retrieval.build_event_text(spark.createDataFrame([row], EVENT)).first().text


def test_sentence(spark):
    head = "Sự kiện e1 được ghi nhận tại camera cam01 vào lúc 2025-01-01 10:05:00+00:00. "
    body = "Hệ thống phân tích hình ảnh đánh giá đây là hành vi {} với mức độ tin cậy {}."
    assert sentence(spark) == head + body.format("BẠO LỰC", "0.88")
    assert sentence(spark, label="violence", extra=("seen",)) == (
        head + body.format("BẠO LỰC", "0.88") + " Ghi chú hệ thống: seen."
    )
    assert sentence(spark, label="other", extra=("",)) == head + body.format("bình thường", "0.88")
    assert sentence(spark, label=None, score=None) == head + body.format("bình thường", "nan")


def test_sentence_of_missing_columns(spark):
    frame = spark.createDataFrame([(1,)], "other int")
    got = retrieval.build_event_text(frame).first().text
    assert "không rõ ID" in got and "không rõ vị trí" in got and "không rõ thời gian" in got
    assert got.endswith("0.00.")


def test_template_is_a_parameter(spark):
    row = spark.createDataFrame([("e1", 0.5)], "event_id string, score double")
    got = retrieval.build_event_text(row, template="{event_id}: {score}").first().text
    assert got == "e1: 0.50"


def test_documents(spark):
    row = spark.createDataFrame([("e1", "cam01", AT, None, None, None)], EVENT)
    one, two = (retrieval.build_event_docs(row).first() for _ in range(2))
    assert one.id == two.id
    assert one.metadata.asDict() == {
        "event_id": "e1", "camera_id": "cam01", "date": "", "label": "", "score": 0.0, "frame_s3_path": "",
    }


@pytest.mark.parametrize(
    "question, camera, date",
    [
        ("what about CAM07 on 2025-01-02?", "cam07", "2025-01-02"),
        ("cam1 and cam2", "cam1", None),
        ("on 2025-99-99", None, "2025-99-99"),
        ("camera seven", None, None),
        ("", None, None),
    ],
)
def test_filters(spark, question, camera, date):
    row = retrieval.extract_filters(spark.createDataFrame([(question,)], "question string")).first()
    assert (row.camera_id, row.date) == (camera, date)


def test_hashed_vectors(spark):
    rows = spark.createDataFrame([(1, "a b b"), (2, "B a B"), (3, None), (4, "c")], "n int, text string")
    got = {r.n: np.array(r.embedding) for r in retrieval.embed_documents(rows).collect()}
    assert all(len(v) == retrieval.VECTOR_SIZE for v in got.values())
    assert np.allclose(got[1], got[2]) and np.isclose(np.linalg.norm(got[1]), 1)
    assert not got[3].any() and not np.allclose(got[1], got[4])


def test_the_whole_text_counts(spark):
    long = "x " * 20000
    rows = spark.createDataFrame([(1, long), (2, long + "tail")], "n int, text string")
    one, two = (np.array(r.embedding) for r in retrieval.embed_documents(rows).orderBy("n").collect())
    assert not np.array_equal(one, two)


def test_encoder_is_loaded_once_per_task_and_batched(spark):
    def load():
        loads = np.random.default_rng().random()
        return lambda texts: np.array([[len(t), len(texts), loads] for t in texts])

    rows = spark.range(10, numPartitions=4).selectExpr("id", "repeat('x', int(id)) AS text")
    got = retrieval.embed_documents(rows, load).orderBy("id").collect()
    assert [r.embedding[0] for r in got] == list(range(10))
    assert len({r.embedding[2] for r in got}) == 4


def brute(questions, docs, k):
    hits = set()
    for q in questions:
        a = np.array(q.embedding, dtype=float)
        ranked = []
        for d in docs:
            if any(q[f] is not None and q[f] != d[f] for f in ("camera_id", "date")):
                continue
            b = np.array(d.embedding, dtype=float)
            cos = a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
            ranked.append((round(1 - cos, 9) + 0.0, d.id))
        hits |= {(q.question_id, rank + 1, d) for rank, (_, d) in enumerate(sorted(ranked)[:k])}
    return hits


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of the documents are copies of one vector."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        vector = [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).tolist()
        rows.append((f"d{i:04d}", vector, f"cam{i % 7}", f"2025-01-0{i % 3 + 1}"))
    return spark.createDataFrame(
        rows, "id string, embedding array<float>, camera_id string, date string"
    ).repartition(7)


@pytest.fixture(scope="module")
def asked(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(40):
        vector = [2.0, 4.0, 6.0, 8.0] if i == 0 else rng.standard_normal(4).tolist()
        camera = f"cam{i % 9}" if i % 2 else None
        rows.append((i, vector, camera, "2025-01-02" if i % 4 > 1 else None))
    return spark.createDataFrame(
        rows, "question_id int, embedding array<float>, camera_id string, date string"
    )


def test_exact_search_against_brute_force(corpus, asked):
    want = brute(asked.collect(), corpus.collect(), 6)
    for bound in (4096, 11):
        got = knn.knn_filtered(asked, corpus, 6, payload=("date",), questions_per_pass=bound).collect()
        assert {(r.question_id, r["rank"], r.id) for r in got} == want
    near = sorted((r.question_id, r["rank"], r.distance) for r in got)
    assert all(a[2] <= b[2] for a, b in zip(near, near[1:]) if a[0] == b[0])


def test_no_match_gives_no_hits(spark, corpus, asked):
    nowhere = asked.withColumn("camera_id", F.lit("cam99"))
    assert knn.knn_filtered(nowhere, corpus).count() == 0
    assert knn.knn_filtered(asked.limit(0), corpus, payload=("date",)).count() == 0


def test_filters_reach_the_document_scan(spark, tmp_path, corpus, asked):
    corpus.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = knn.knn_filtered(asked.where("question_id = 1"), docs)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(camera_id,cam1)" in plan or "In(camera_id, [cam1])" in plan


def test_approximate_search_finds_most_and_is_exact_when_all_is_probed(spark):
    rng = np.random.default_rng(9)
    centers = rng.standard_normal((20, 32))
    rows = [(i, (centers[i % 20] + 0.3 * rng.standard_normal(32)).tolist()) for i in range(800)]
    docs = spark.createDataFrame(rows, "id long, embedding array<float>")
    questions = docs.withColumnRenamed("id", "question_id").where("question_id < 100")
    exact = {(r.question_id, r.id) for r in knn.topk_similarity(questions, docs).collect()}
    centers = knn.train_cells(docs, 20)
    celled = knn.assign_cells(docs, centers)
    assert celled.count() == 800 and celled.select("cell").distinct().count() > 10
    near = {(r.question_id, r.id) for r in knn.knn_approx(questions, celled, centers, probes=4).collect()}
    assert len(near & exact) / len(exact) > 0.9
    every = knn.knn_approx(questions, celled, centers, probes=20)
    assert {(r.question_id, r.id) for r in every.collect()} == exact


def test_recall_on_the_test_vectors(spark):
    """Hardly clustered vectors, the worst case for cells."""
    from suite.assistant import knn_approx

    recall = knn_approx(spark, "/root/testdata/sf0.01").agg(F.avg("recall")).first()[0]
    assert recall > 0.9


def test_probed_cells_prune_the_scan(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    docs = spark.createDataFrame(rows, "id long, embedding array<float>")
    centers = knn.train_cells(docs, 8)
    knn.assign_cells(docs, centers).write.partitionBy("cell").parquet(str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    one = docs.limit(1).withColumnRenamed("id", "question_id")
    found = knn.knn_approx(one, stored, centers, probes=2)
    assert found.count() == 6
    assert "PartitionFilters: [cell" in found._jdf.queryExecution().executedPlan().toString()


def test_index_words_and_embeds_only_new_events(spark):
    rows = [("e1", "cam01", AT, "VIOLENCE", 0.5, None), ("e2", "cam02", AT, "VIOLENCE", 0.5, None)]
    first = assistant.update_index(None, spark.createDataFrame(rows[:1], EVENT))
    calls = spark.sparkContext.accumulator(0)

    def load():
        def encode(texts):
            calls.add(len(texts))
            return np.ones((len(texts), retrieval.VECTOR_SIZE))

        return encode

    second = assistant.update_index(first, spark.createDataFrame(rows, EVENT), load, 1).collect()
    assert {(r.metadata.event_id, r.version) for r in second} == {("e1", 0), ("e2", 1)}
    assert calls.value == 1


def test_chat(spark):
    events = spark.createDataFrame(
        [(f"e{i}", f"cam0{i % 2}", AT, "VIOLENCE", i / 10, None) for i in range(9)], EVENT
    ).withColumn("date", F.lit("2025-01-01"))
    index = assistant.update_index(None, events)
    questions = spark.createDataFrame(
        [(1, " violence at CAM01 "), (2, "  "), (3, "cam01 on 2024-01-01"), (4, "e3"), (5, None)],
        "question_id int, question string",
    )
    got = {r.question_id: r for r in assistant.chat_response_rows(questions, index).collect()}
    assert len(got) == 5
    assert got[1].question == "violence at CAM01" and len(got[1].data_sources) == 4
    assert got[1].filters_applied.asDict() == {"camera_id": "cam01", "date": None}
    assert got[1].answer.startswith(text.RETRIEVAL_HEADING + "- Sự kiện e")
    assert got[1].answer.count("\n\n- ") == 3
    assert got[2].error == got[5].error == text.BLANK_QUESTION and got[2].answer is None
    assert got[3].answer == text.NOTHING_FOUND and got[3].data_sources == []
    assert len(got[4].data_sources) == 6 and got[4].filters_applied is None
    assert got[4].data_sources[0].metadata.event_id == "e3"


def test_iso_text(spark):
    frame = spark.createDataFrame([(AT,), (AT.replace(microsecond=10),), (None,)], "t timestamp")
    got = [r[0] for r in frame.select(times.iso_text("t")).collect()]
    assert got == [AT.isoformat(), AT.replace(microsecond=10).isoformat(), None]


def test_vectors_of_another_length_are_an_error(spark):
    questions = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, embedding array<double>")
    docs = spark.createDataFrame([("a", [1.0, 0.0, 2.0]), ("b", [1.0])], "id string, embedding array<double>")
    with pytest.raises(Exception, match=r"vector of id '[ab]' has [13] values, not 2"):
        knn.topk_similarity(questions, docs).collect()


def test_documents_without_an_id_are_left_out(spark):
    questions = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, embedding array<double>")
    docs = spark.createDataFrame([(None, [1.0, 0.0]), ("b", [0.0, 1.0])], "id string, embedding array<double>")
    assert [r.id for r in knn.topk_similarity(questions, docs).collect()] == ["b"]


def test_lots_encode_each_question_once(spark):
    """However many lots the questions take, their source is evaluated for the head and once more."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def encode(n):
        seen.add(1)
        return [1.0, float(n)]

    questions = spark.range(100).select(F.col("id").alias("question_id"), encode("id").alias("embedding"))
    docs = spark.createDataFrame([(n, [1.0, float(n)]) for n in range(100)], "id long, embedding array<double>")
    found = knn.knn_filtered(questions, docs, 1, (), questions_per_pass=20)
    assert all(r.question_id == r.id for r in found.collect()) and found.count() == 100
    assert seen.value <= 200


@pytest.mark.parametrize("blank", ["\n\t", "", "  ", "\u00a0\u2003\r", "\x1c", None])
def test_white_space_of_any_kind_is_blank(spark, blank):
    frame = spark.createDataFrame([(blank, f"{blank or ''} a b\t{blank or ''}")], "x string, y string")
    row = frame.select(text.stripped(F.coalesce("x", F.lit(""))).alias("x"), text.stripped(F.col("y")).alias("y")).first()
    assert (row.x, row.y) == ("", "a b")


def test_hashed_vectors_by_value(spark):
    """Counts of the words' places, scaled to length one; letters of any script, digits, repeats."""
    from pyspark.ml.feature import HashingTF

    texts = ["Fire alarm, fire!", "cam01 at 10:30", "Bạo lực ở cổng", "", None, " ... ", "long " * 5000 + "end"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    places = HashingTF(numFeatures=retrieval.VECTOR_SIZE)
    for row in retrieval.embed_documents(rows).collect():
        want = np.zeros(retrieval.VECTOR_SIZE)
        words = "".join(c if c.isalnum() else " " for c in (texts[row.n] or "").lower()).split()
        for word in words or [""]:
            want[places.indexOf(word)] += 1 if word else 0
        norm = np.linalg.norm(want)
        assert np.allclose(row.embedding, want / norm if norm else want, atol=1e-6), texts[row.n]
