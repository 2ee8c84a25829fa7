"""Filtered nearest neighbours by cosine distance.

Every task keeps, for each question, the ``k`` nearest documents of its own
partition, so only ``k`` rows per question and task are shuffled; pairs of
questions and documents never become rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import materialize

# Questions held by every task at once: 4096 vectors of 384 doubles are 12 MB.
QUESTIONS_PER_PASS = 4096
_DOCS_PER_STEP = 512
# Distances are compared at this many decimals, ties go to the lower id.
_DECIMALS = 9


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _matrix(column: pa.Array, size: int | None = None, ids: pa.Array | None = None) -> np.ndarray:
    """Unit vectors, one per row; all must have ``size`` values."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    wrong = np.flatnonzero(lengths != (lengths[0] if size is None and len(lengths) else size))
    if len(wrong):
        named = "" if ids is None else f" of id {ids[int(wrong[0])].as_py()!r}"
        raise ValueError(f"vector{named} has {lengths[wrong[0]]} values, not {size or lengths[0]}")
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit(flat.reshape(len(lists), -1))


def _nearest(
    question: np.ndarray, distance: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` least (distance, id) of every question."""
    order = np.lexsort((ids, distance, question))
    question, distance, ids = question[order], distance[order], ids[order]
    first = np.searchsorted(question, question)
    kept = np.arange(len(question)) - first < k
    return question[kept], distance[kept], ids[kept]


def _search(questions: dict, k: int, filters: Sequence[str], by_cell: bool) -> Callable:
    """Task function: local top ``k`` of each question over the task's documents."""
    targets = questions["vectors"]

    def allowed(batch: pa.RecordBatch) -> np.ndarray | None:
        mask = None
        for name in filters:
            wanted = questions["filters"][name]
            known = {v: i for i, v in enumerate(sorted({w for w in wanted if w is not None}))}
            if not known:
                continue
            wanted_code = np.array([-1 if w is None else known[w] for w in wanted])
            codes = batch.column(name).dictionary_encode()
            table = np.array([known.get(v, -2) for v in codes.dictionary.to_pylist()] + [-2])
            own = table[codes.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)]
            fits = (wanted_code[None, :] == -1) | (own[:, None] == wanted_code[None, :])
            mask = fits if mask is None else mask & fits
        return mask

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents and the questions they are multiplied with: all, or those that probe their cell."""
        if not by_cell:
            yield np.arange(batch.num_rows), np.arange(len(targets))
            return
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        for cell in np.unique(cells):
            asking = np.flatnonzero(questions["probes"][cell])
            if len(asking):
                yield np.flatnonzero(cells == cell), asking

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = len(targets)
        best = None
        bound = np.full(asked, np.inf)
        id_type = None
        for whole in batches:
            id_type = whole.column("id").type
            for begin in range(0, whole.num_rows, _DOCS_PER_STEP):
                batch = whole.slice(begin, _DOCS_PER_STEP)
                documents = _matrix(batch.column("vector"), targets.shape[1], batch.column("id"))
                mask = allowed(batch)
                for own, asking in blocks(batch):
                    # Adding zero turns a rounded -0.0 into 0.0.
                    distance = np.round(1.0 - documents[own] @ targets[asking].T, _DECIMALS) + 0.0
                    if mask is not None:
                        distance[~mask[np.ix_(own, asking)]] = np.inf
                    if len(distance) > k:
                        near = np.partition(distance, k - 1, axis=0)[k - 1]
                    else:
                        near = np.full(len(asking), np.inf)
                    row, column = np.nonzero(
                        (distance <= np.minimum(near, bound[asking])) & np.isfinite(distance)
                    )
                    ids = batch.column("id").take(pa.array(own[row]))
                    if pa.types.is_integer(id_type):
                        ids = ids.to_numpy()
                    else:
                        ids = np.array(ids.to_pylist(), dtype=str)
                    found = (asking[column], distance[row, column], ids)
                    if best is not None:
                        found = tuple(np.concatenate(pair) for pair in zip(best, found))
                    best = _nearest(*found, k)
                    counts = np.bincount(best[0], minlength=asked)
                    full = counts >= k
                    ends = np.cumsum(counts)
                    bound[full] = best[1][ends[full] - 1]
        if best is not None and len(best[0]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(best[0].astype(np.int32)),
                    pa.array(best[2].tolist(), type=id_type),
                    pa.array(best[1]),
                ],
                names=["_question", "id", "distance"],
            )

    return run


def _filled(rows: DataFrame) -> DataFrame:
    return rows.where("embedding IS NOT NULL AND size(embedding) > 0")


@dataclass(frozen=True)
class _Cells:
    """Unit centres of cells, and how many of them a question probes."""

    centers: np.ndarray
    probes: int

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        return np.argsort(-(vectors @ self.centers.T), axis=1, kind="stable")[:, : self.probes]

    def probe(self, vectors: np.ndarray) -> np.ndarray:
        """Which cell (row) each question (column) probes."""
        probed = np.zeros((len(self.centers), len(vectors)), dtype=bool)
        probed[self.nearest(vectors).T, np.arange(len(vectors))] = True
        return probed

    def probed(self, vectors: str) -> Column:
        """The probed cells of each vector of a column."""

        @F.pandas_udf("array<int>")
        def cells(vectors: pd.Series) -> pd.Series:
            return pd.Series(list(self.nearest(_matrix(pa.array(vectors.tolist()), self.centers.shape[1])).astype("int32")))

        return cells(vectors)


def _search_lot(
    lot: list,
    docs: DataFrame,
    k: int,
    filters: Sequence[str],
    payload: Sequence[str],
    cells: _Cells | None,
    question: T.StructField,
) -> DataFrame:
    """Hits of a lot of questions: one pass over the documents, then one over the hits'."""
    sizes = {len(row["embedding"]) for row in lot}
    if len(sizes) > 1:
        raise ValueError(f"questions have vectors of different lengths: {sorted(sizes)}")
    vectors = _unit(np.array([row["embedding"] for row in lot], dtype=np.float64))
    packed = {
        "vectors": vectors,
        "filters": {name: [row[name] for row in lot] for name in filters},
    }
    columns = ["id", F.col("embedding").alias("vector"), *filters]
    candidates = _filled(docs).where(F.col("id").isNotNull())
    for name, wanted in packed["filters"].items():
        if all(value is not None for value in wanted):
            candidates = candidates.where(F.col(name).isin(*set(wanted)))
    if cells is not None:
        packed["probes"] = cells.probe(vectors)
        visited = np.flatnonzero(packed["probes"].any(axis=1))
        candidates = candidates.where(F.col("cell").isin(*visited.tolist()))
        columns.append("cell")
    found = (
        T.StructType()
        .add("_question", T.IntegerType())
        .add("id", docs.schema["id"].dataType)
        .add("distance", T.DoubleType())
    )
    local = candidates.select(*columns).mapInArrow(
        _search(packed, k, filters, cells is not None), found
    )
    nearest = Window.partitionBy("_question").orderBy("distance", "id")
    top = local.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(
        [(i, row[question.name]) for i, row in enumerate(lot)],
        T.StructType().add("_question", T.IntegerType()).add(question),
    )
    # Both broadcasts are bounded: a lot's questions, and k hits of each.
    top = top.join(F.broadcast(names), "_question").drop("_question")
    if payload:
        top = docs.select("id", *payload).join(F.broadcast(top), "id")
    return top.select(question.name, "rank", "id", *payload, "distance")


def _knn(
    questions: DataFrame,
    docs: DataFrame,
    k: int,
    filters: Sequence[str],
    payload: Sequence[str],
    cells: _Cells | None,
    bound: int,
    question_id: str,
) -> DataFrame:
    """One lazy pass for up to ``bound`` questions, all of which go to every task. More are
    packed into lots that meet blocks of the documents they may find, in one pass as well."""
    asked = _filled(questions)
    columns = [question_id, "embedding", *filters]
    head = asked.select(*columns).limit(bound + 1).collect()
    if 0 < len(head) <= bound:
        return _search_lot(head, docs, k, filters, payload, cells, questions.schema[question_id])
    if not head:
        layout = T.StructType([questions.schema[question_id]]).add("rank", T.IntegerType())
        for name in ("id", *payload):
            layout.add(docs.schema[name])
        return questions.sparkSession.createDataFrame([], layout.add("distance", T.DoubleType()))
    from tidewatch.operators import postings  # which needs this module

    # Encoded once, however often they are read. Ids may repeat, the numbers don't.
    numbered = asked.select(*columns).withColumn("question", F.monotonically_increasing_id())
    asked = materialize(numbered, "questions")
    own = ["id", "embedding", *filters, *(["cell"] if cells else [])]
    held = materialize(_filled(docs).where(F.col("id").isNotNull()).select(*own), "vectors")
    visiting = asked.select("question", "embedding", *filters)
    if cells:
        visiting = visiting.withColumn("cell", F.explode(cells.probed("embedding")))
    top = postings.search(visiting, held, k, filters, ["cell"] if cells else [])
    top = top.join(asked.select("question", question_id), "question")
    if payload:
        top = top.join(docs.select("id", *payload), "id")
    return top.select(question_id, "rank", "id", *payload, "distance")


def knn_filtered(
    questions: DataFrame,
    docs: DataFrame,
    k: int = 6,
    filters: Sequence[str] = ("camera_id", "date"),
    payload: Sequence[str] = (),
    question_id: str = "question_id",
    questions_per_pass: int = QUESTIONS_PER_PASS,
) -> DataFrame:
    """Exact ``k`` nearest documents per question, by cosine distance.

    ``questions`` have (question_id, embedding, filters), ``docs`` (id, embedding,
    filters, payload). A document has to equal every filter its question sets;
    NULL sets none. Vectors of another length than the question's are an error that names
    the document; documents without an id are left out. Up to ``questions_per_pass`` questions are handed to all tasks;
    where all of them set a filter, its values are pushed into the document scan. More are
    packed into lots, whatever their number, and meet blocks of the documents with the values
    of their filters (see :mod:`tidewatch.operators.postings`); questions and narrow documents
    are written once for that.
    """
    return _knn(questions, docs, k, filters, payload, None, questions_per_pass, question_id)


def topk_similarity(
    questions: DataFrame, docs: DataFrame, k: int = 6, question_id: str = "question_id"
) -> DataFrame:
    """:func:`knn_filtered` without filters."""
    return knn_filtered(questions, docs, k, (), (), question_id)


def train_cells(docs: DataFrame, cells: int = 64, seed: int = 11) -> np.ndarray:
    """Unit-length centres of ``cells`` groups of vectors, one per row, fitted to all documents."""
    vectors = _filled(docs).select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine").fit(vectors)
    return _unit(np.array(model.clusterCenters()))


def assign_cells(docs: DataFrame, centers: np.ndarray) -> DataFrame:
    """Add ``cell``, the number of the nearest centre.

    Store documents partitioned by ``cell`` so that a search reads only the
    cells it probes. Documents without a vector are left out.
    """

    @F.arrow_udf("int")
    def cell(vectors: pa.Array) -> pa.Array:
        return pa.array((_matrix(vectors) @ centers.T).argmax(axis=1).astype(np.int32))

    return _filled(docs).withColumn("cell", cell("embedding"))


def knn_approx(
    questions: DataFrame,
    docs: DataFrame,
    centers: np.ndarray,
    k: int = 6,
    probes: int = 40,
    filters: Sequence[str] = (),
    payload: Sequence[str] = (),
    question_id: str = "question_id",
    questions_per_pass: int = QUESTIONS_PER_PASS,
) -> DataFrame:
    """Approximate neighbours: only documents in the ``probes`` cells nearest the question.

    ``docs`` carry the ``cell`` of :func:`assign_cells` for the same ``centers``.
    Probed cells are searched completely, however large, and only their questions are
    multiplied with a cell's documents; with as many probes as cells the search is exact. Recall is measured against :func:`knn_filtered`.
    """

    return _knn(questions, docs, k, filters, payload, _Cells(centers, probes), questions_per_pass, question_id)
