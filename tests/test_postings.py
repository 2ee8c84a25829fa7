"""Search by blocks and lots: exact by filter values, approximate by codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import knn, postings

DOC = "id long, embedding array<float>, camera_id string, date string"
QUESTION = "question_id long, embedding array<float>, camera_id string, date string"


def rows(count, seed, hot=True):
    rng = np.random.default_rng(seed)
    out = []
    for n in range(count):
        camera = "hot" if hot and n % 3 == 0 else rng.choice(["c1", "c2", None])
        out.append((n, [float(x) for x in rng.normal(size=8)], camera if camera is None else str(camera), f"d{rng.integers(3)}"))
    return out


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_DOCS", 64)
    monkeypatch.setattr(postings, "LOT_QUESTIONS", 16)


def sides(spark):
    docs = rows(700, 1) + [(1000, None, "c1", "d1"), (1001, [], "c1", "d1"), (None, [1.0] * 8, "c1", "d1"), (1002, [0.0] * 8, "hot", "d0")]
    docs += [(2000 + n, docs[0][1], "hot", "d0") for n in range(20)]  # equal distances
    asked = [(n, v, c if n % 4 else None, d if n % 3 else None) for n, v, c, d in rows(90, 2)] + [(500, None, "hot", None)]
    return spark.createDataFrame(asked, QUESTION), spark.createDataFrame(docs, DOC).repartition(5)


def listed(found):
    return sorted(map(tuple, found.withColumn("distance", F.round("distance", 6)).collect()))


def test_postings_equal_the_plain_search(spark, small):
    asked, docs = sides(spark)
    want = knn.knn_filtered(asked, docs, k=7, payload=("camera_id",))
    assert listed(postings.knn_postings(asked, docs, k=7, payload=("camera_id",))) == listed(want)


def test_only_allowed_pairs_are_multiplied(spark, small, monkeypatch):
    asked, docs = sides(spark)
    met, meet = [], postings._meet
    monkeypatch.setattr(postings, "_meet", lambda b, q, keys, *rest: met.append((b, q, keys)) or meet(b, q, keys, *rest))
    postings.knn_postings(asked, docs)
    products = sum(
        b.join(q, keys).agg(F.coalesce(F.sum(F.size("block") * F.size("lot")), F.lit(0))).first()[0] for b, q, keys in met
    )
    fits = lambda name: F.col(f"q.{name}").isNull() | (F.col(f"q.{name}") == F.col(f"d.{name}"))
    filled = "id IS NOT NULL AND size(embedding) > 0"
    pairs = asked.where("size(embedding) > 0").alias("q").join(docs.where(filled).alias("d"), fits("camera_id") & fits("date"))
    assert products == pairs.count()
    largest = max(b.agg(F.max(F.size("block"))).first()[0] for b, _, _ in met)
    assert largest < 64 * 2.5  # the hot camera is many blocks


def test_no_rows(spark):
    asked, docs = sides(spark)
    assert postings.knn_postings(asked.limit(0), docs).count() == 0
    assert postings.knn_postings(asked, docs.limit(0)).count() == 0


def test_other_lengths_are_errors(spark):
    asked, docs = sides(spark)
    odd = docs.unionByName(spark.createDataFrame([(9, [1.0] * 7, "hot", "d0")], DOC))
    with pytest.raises(Exception, match="has 7 values"):
        postings.knn_postings(asked, odd).collect()


def test_recall_with_a_tenth_compared(spark):
    """The test vectors are hardly clustered; 50 of 500 are compared for each question, and 60 of 2000."""
    for folder, compared in (("sf0.01", 50), ("sf0.1", 60)):
        table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
        docs = table.select(F.col("vec_id").alias("id"), "embedding")
        asked = docs.select(F.col("id").alias("question_id"), "embedding")
        quantizer = postings.fit_quantizer(docs)
        index = postings.add_codes(docs, quantizer)
        assert compared <= docs.count() / 10
        assert {len(r.code) for r in index.select("code").collect()} == {16}
        got = {(r.question_id, r.id) for r in postings.knn_quantised(asked, index, quantizer, compared=compared).collect()}
        want = {(r.question_id, r.id) for r in knn.topk_similarity(asked, docs).collect()}
        assert len(got) == len(want) and len(got & want) / len(want) >= 0.9


def test_quantised_is_exact_when_everything_is_compared(spark, small):
    asked, docs = sides(spark)
    held = docs.where("id IS NOT NULL AND size(embedding) > 0")
    quantizer = postings.fit_quantizer(held, cells=5, parts=3, levels=10)
    got = postings.knn_quantised(asked, postings.add_codes(docs, quantizer), quantizer, k=4, probes=5, compared=800)
    assert listed(got) == listed(knn.topk_similarity(asked, held, k=4))


def test_many_questions_read_the_documents_once(spark):
    """However many lots the questions would be, a document is embedded once, and none is multiplied twice."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def encode(n):
        seen.add(1)
        return [1.0, float(n)]

    docs = spark.range(100).select("id", encode("id").alias("embedding"))
    asked = spark.createDataFrame([(n, [1.0, float(n)]) for n in range(100)], "question_id long, embedding array<double>")
    found = knn.knn_filtered(asked, docs, 1, (), questions_per_pass=20)
    assert all(r.question_id == r.id for r in found.collect())
    assert seen.value <= 200  # filtered and written


def test_questions_that_repeat_keep_hits_of_their_own(spark):
    asked, docs = sides(spark)
    twice = asked.unionByName(asked)
    want = knn.knn_filtered(twice, docs, k=3, payload=("camera_id",))
    assert listed(knn.knn_filtered(twice, docs, k=3, payload=("camera_id",), questions_per_pass=20)) == listed(want)


def test_the_best_of_a_lot_are_kept_over_its_blocks(spark, small, monkeypatch):
    """What leaves a task is bounded by the questions, however many cells and blocks they meet."""
    met, meet = [], postings._meet
    monkeypatch.setattr(postings, "_meet", lambda *given: met.append(meet(*given)) or met[-1])
    asked, docs = sides(spark)
    held = docs.where("id IS NOT NULL AND size(embedding) > 0")
    quantizer = postings.fit_quantizer(held, cells=5, parts=3, levels=10)
    postings.knn_quantised(asked, postings.add_codes(held, quantizer), quantizer, k=4, probes=5, compared=7)
    assert met[0].count() == 7 * asked.where("size(embedding) > 0").count()


def test_a_step_multiplies_a_bounded_number_of_questions():
    import pyarrow as pa

    vectors = pa.array([[1.0, float(n)] for n in range(postings.QUESTIONS_PER_STEP * 5 // 2)])
    block = pa.array([[{"id": 1, "content": [1.0, 0.0]}]])
    batch = pa.RecordBatch.from_arrays([block], names=["block"])
    steps = list(postings._cosine(batch, 0, vectors, block[0].values.field("content")))
    assert max(len(asking) for asking, _ in steps) <= postings.QUESTIONS_PER_STEP
    assert sum(len(asking) for asking, _ in steps) == len(vectors)


def nearest_by_sorting(questions, docs, ids, k):
    """Places of questions and ids, by rounded cosines; what isn't a number is no hit."""
    cosines = questions @ docs.T
    out = []
    for place, row in enumerate(cosines):
        known = np.flatnonzero(~np.isnan(row))
        order = known[np.lexsort((ids[known], postings._distance(row[known])))][:k]
        out += [(place, int(ids[n])) for n in order]
    return out


def test_few_pairs_are_multiplied_in_double_precision(monkeypatch):
    """All pairs in single precision, a few again; ties, vectors of zeros and of no numbers, and a block's last documents too."""
    import pyarrow as pa

    done, exact = [], postings._Products.exact
    monkeypatch.setattr(postings._Products, "exact", lambda self, question, doc: done.append(len(question)) or exact(self, question, doc))
    rng = np.random.default_rng(7)
    plain = knn._unit(rng.normal(size=(9000, 12)))
    odd = plain.copy()
    odd[rng.permutation(9000)[:900]] = odd[5]  # equal
    odd[17:9000:500] = 0.0
    odd[::1000] = np.nan
    odd[rng.permutation(9000)[:300]] += 1e-8  # equal in single precision
    for vectors, k in ((plain, 6), (plain, 60), (odd, 1), (odd, 6), (odd, 60)):
        questions, ids = vectors[:300], rng.permutation(9000)
        best = postings._Best(pa.array(np.arange(300)), k, postings._distance)
        done.clear()
        begin = 0
        for size in (2, 37, 100, 3001, 1, 2900, 2959):
            block = slice(begin, begin + size)
            for asking, near in postings._products(questions, vectors[block]):
                best.add(asking, near, pa.array(ids[block]))
            begin += size
        got = [(n, i) for batch in best.rows() for n, i in zip(*(batch.column(c).to_pylist() for c in ("question", "id")))]
        assert got == nearest_by_sorting(questions, vectors, ids, k)
        if vectors is plain:
            assert sum(done) < 300 * 9000 / 10


def test_products_of_decoded_vectors_are_table_sums():
    rng = np.random.default_rng(3)
    quantizer = postings.Quantizer(knn._unit(rng.normal(size=(4, 10))), [rng.normal(size=(7, n)) for n in (4, 3, 3)])
    codes, questions = rng.integers(7, size=(50, 3)).astype(np.uint8), knn._unit(rng.normal(size=(20, 10)))
    sums = (questions @ quantizer.centers[2])[:, None] + sum(
        (part @ book.T)[:, codes[:, n]] for n, (part, book) in enumerate(zip(np.split(questions, [4, 7], axis=1), quantizer.books))
    )
    assert np.allclose(questions @ quantizer.decode(2, codes).T, sums, atol=1e-12)


def test_parts_of_a_search_without_filters_are_even(spark, monkeypatch):
    """Blocks of a slot and lots of a group are bounded, however many there are, and many tasks share the pairs."""
    monkeypatch.setattr(postings, "BLOCK_DOCS", 32)
    monkeypatch.setattr(postings, "LOT_QUESTIONS", 32)
    met, meet = [], postings._meet
    monkeypatch.setattr(postings, "_meet", lambda blocks, lots, *rest: met.append((blocks, lots)) or meet(blocks, lots, *rest))
    docs = spark.range(4000).select("id", F.array(F.lit(1.0), F.rand(1), F.rand(2)).alias("embedding"))
    asked = docs.select(F.col("id").alias("question"), "embedding")
    found = postings.search(asked, docs, 2, ())
    for side, name in zip(met[0], ("block", "lot")):
        assert side.agg(F.max(F.size(name))).first()[0] < 32 * 2.5
    assert found.count() == 2 * 4000
    keys = [c for c in met[0][0].columns if c in met[0][1].columns]
    pairs = met[0][0].join(met[0][1], keys).groupBy(*keys).agg(F.sum(F.size("block") * F.size("lot")).alias("pairs"))
    assert pairs.count() == 64 and pairs.agg(F.sum("pairs")).first()[0] == 4000**2


def test_of_equal_codes_the_lower_ids_are_compared(spark, small):
    docs = spark.createDataFrame([(n, [1.0, float(n % 3)]) for n in range(300)], "id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "question_id long, embedding array<double>")
    quantizer = postings.fit_quantizer(docs, cells=2, parts=2, levels=4)
    found = postings.knn_quantised(asked, postings.add_codes(docs, quantizer), quantizer, k=5, probes=2, compared=9)
    got = [(r.question_id, r.id) for r in found.orderBy("question_id", "rank").collect()]
    assert got == [(n, n + 3 * m) for n in range(2) for m in range(5)]
