"""Search by blocks of documents and lots of questions that meet on a key.

Documents are packed into blocks of a key, questions into lots of the same key, and only
blocks and lots of one key are multiplied. Neither side reaches the driver or is broadcast,
and a hot key is many blocks, so any number of questions takes one pass. Two searches use it:
:func:`knn_postings`, exact, with filter values as keys, and :func:`knn_quantised`,
approximate, with cells as keys and short codes in place of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.knn import _DECIMALS, _filled, _matrix, _unit

#: Documents of a block and questions of a lot, about. Each block is read once for each lot of its key.
BLOCK_DOCS, LOT_QUESTIONS = 4096, 4096

#: Groups of questions without filters and slots of documents: each group meets each slot in a part of its own.
GROUPS, SLOTS = 8, 8

#: Questions of a lot that are multiplied with a block at once: 256 x 4096 floats are 4 MB.
QUESTIONS_PER_STEP = 256

#: Documents of a block of which the best is looked at before the others.
GROUP_DOCS = 16

#: Groups of questions that each read all codes.
CODE_READERS = 64

#: Codes that are packed in place of a vector: a lot is sent along with each block.
CODES_PER_VECTOR = 4

#: Decimals at which table sums of codes are compared.
_CODE_DECIMALS = 12

#: Cosines this close may have the same rounded distance.
_SLACK = 2 * 10.0**-_DECIMALS


def _packed(rows: DataFrame, keys: list[str], ident: str, content: str, size: int, name: str) -> DataFrame:
    """Rows (keys, ``name``, number): lists of (ident, content), about ``size`` of each key at a time."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).alias("_parts"))
    dealt = rows.join(counts, keys).withColumn("_part", F.pmod(F.xxhash64(ident), F.col("_parts")))
    pair = F.struct(F.col(ident).alias("id"), F.col(content).alias("content"))
    return dealt.groupBy(*keys, "_part").agg(F.collect_list(pair).alias(name)).withColumnRenamed("_part", f"_{name}")


def _lists(column: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The ids and contents of each packed list."""
    for row in range(len(column)):
        items = column[row].values
        yield items.field("id"), items.field("content")


class _Products:
    """Products of unit questions (rows) and documents (columns): rough ones of all pairs, in single
    precision and less than ``slack`` off, and exact ones of chosen pairs. Rough ones that aren't numbers are least."""

    def __init__(self, questions: np.ndarray, docs: np.ndarray, rough: np.ndarray, slack: float):
        self._questions, self._docs, self._rough, self.slack = questions, docs, rough, slack

    def tops(self, each: int) -> np.ndarray:
        """The largest rough one of each group of ``each`` documents; less than a group is left over."""
        groups = self._rough.shape[1] // each
        tops = self._rough[:, : groups * each].reshape(len(self._rough), each, groups).max(axis=1)
        if np.isnan(tops).any():
            self._rough = np.where(np.isnan(self._rough), np.float32(-np.inf), self._rough)
            return self.tops(each)
        return tops

    def reaching(self, least: np.ndarray, each: int, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Questions and documents whose rough product reaches the ``least`` of the question; only groups whose top does are read."""
        groups = tops.shape[1]
        question, group = np.divmod(np.flatnonzero(tops >= least[:, None]), groups)
        doc = group[:, None] + groups * np.arange(each)
        row, place = np.nonzero(self._rough[question[:, None], doc] >= least[question, None])
        over, rest = np.nonzero(self._rough[:, groups * each :] >= least[:, None])
        return np.concatenate([question[row], over]), np.concatenate([doc[row, place], rest + groups * each])

    def exact(self, question: np.ndarray, doc: np.ndarray) -> np.ndarray:
        out, step = np.empty(len(question)), max(1, (1 << 20) // max(1, self._docs.shape[1]))
        for begin in range(0, len(out), step):
            part = slice(begin, begin + step)
            out[part] = np.einsum("ij,ij->i", self._questions[question[part]], self._docs[doc[part]])
        return out


def _products(questions: np.ndarray, docs: np.ndarray) -> Iterator[tuple[np.ndarray, _Products]]:
    """Places of questions and their products with all documents, a bounded number of questions at a time."""
    single, held = questions.astype(np.float32), np.ascontiguousarray(docs.T, dtype=np.float32)
    norms = np.sqrt(np.einsum("ij,ij->i", docs, docs))
    # Each number is rounded once and each sum of a dot product once more; a floor is rounded too.
    slack = (docs.shape[1] + 8) * 2.0**-24 * float(np.fmax.reduce(norms, initial=1.0))
    for some in np.array_split(np.arange(len(questions)), -(-len(questions) // QUESTIONS_PER_STEP)):
        yield some, _Products(questions[some], docs, single[some] @ held, slack)


class _Best:
    """The ``k`` nearest documents of each question of a lot, over blocks that come one after the other."""

    def __init__(self, asked: pa.Array, k: int, distance: Callable[[np.ndarray], np.ndarray]):
        self._asked, self._k, self._distance = asked.take(pa.array(np.arange(len(asked)))), k, distance
        self._floor = np.full(len(asked), -np.inf)  # what a document has to reach, once there are k
        self._found: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []  # the first is sorted and cut to k
        self._waiting = 0

    def add(self, asking: np.ndarray, near: _Products, ids: pa.Array) -> None:
        """Products that grow with nearness; what isn't a number is no hit."""
        floor, k = self._floor[asking], self._k
        each = max(1, min(GROUP_DOCS, len(ids) // (2 * k)))
        tops = near.tops(each)
        crowded = np.flatnonzero(np.count_nonzero(tops >= self._least(floor, near.slack)[:, None], axis=1) > k)
        if len(crowded):  # the k-th of the tops is reached by k documents
            floor[crowded] = np.maximum(floor[crowded], np.partition(tops[crowded], -k, axis=1)[:, -k] - near.slack - _SLACK)
            self._floor[asking] = floor
        question, doc = near.reaching(self._least(floor, near.slack), each, tops)
        exact = near.exact(question, doc)
        kept = exact >= floor[question]
        question, doc, exact = question[kept], doc[kept], exact[kept]
        self._found.append((asking[question], exact, ids.take(pa.array(doc))))
        self._waiting += len(question)
        if self._waiting > 3 * k * len(self._floor):
            self._cut()

    @staticmethod
    def _least(floor: np.ndarray, slack: float) -> np.ndarray:
        single = np.nextafter((floor - slack).astype(np.float32), np.float32(-np.inf))
        return np.maximum(single, np.finfo(np.float32).min)

    def _cut(self) -> None:
        question, near = (np.concatenate([found[n] for found in self._found]) for n in (0, 1))
        ids = pa.concat_arrays([found[2] for found in self._found])
        distance = self._distance(near)
        order = np.argsort(distance)
        order = order[np.argsort(question[order].astype(np.min_scalar_type(len(self._floor))), kind="stable")]
        same = (np.diff(question[order]) == 0) & (np.diff(distance[order]) == 0)
        places = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if len(places):  # of equal distances the lower id goes first
            tied = order[places]
            values = ids.take(pa.array(tied))
            values = (values if pa.types.is_integer(ids.type) else pc.rank(values, tiebreaker="dense")).to_numpy(zero_copy_only=False)
            order[places] = tied[np.lexsort((values, distance[tied], question[tied]))]
        counts = np.bincount(question, minlength=len(self._floor))
        begins = np.cumsum(counts) - counts
        order = order[np.arange(len(order)) - begins[question[order]] < self._k]
        question, near = question[order], near[order]
        self._found, self._waiting = [(question, near, ids.take(pa.array(order)))], 0
        counts = np.bincount(question, minlength=len(self._floor))
        full = counts >= self._k
        self._floor[full] = np.maximum(self._floor[full], near[np.cumsum(counts)[full] - 1] - _SLACK)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self._found:
            self._cut()
            question, near, ids = self._found[0]
            columns = [self._asked.take(pa.array(question)), ids, pa.array(self._distance(near))]
            yield pa.RecordBatch.from_arrays(columns, names=["question", "id", "distance"])


def _meet(
    blocks: DataFrame, lots: DataFrame, keys: list[str], k: int, opened: Callable[[pa.Array], Any],
    nearness: Callable[[pa.RecordBatch, int, Any, pa.Array], Iterator[tuple[np.ndarray, _Products]]],
    distance: Callable[[np.ndarray], np.ndarray], question_type: str, id_type: str, parts: int = 1,
) -> DataFrame:
    """Rows (question, id, distance): the ``k`` nearest of each question of a lot in the blocks of its keys.

    ``opened`` makes of the contents of a lot, once, what ``nearness`` takes; that gives questions
    of the lot, by their places, and their products with the documents of a block, a bounded number of
    questions at a time; ``distance`` turns the exact ones into distances. ``parts`` is how many tasks there are at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, current, lot_contents = None, None, None
        for batch in batches:
            pairs = zip(_lists(batch.column("block")), _lists(batch.column("lot")), strict=True)
            for row, ((ids, contents), (asked, packed)) in enumerate(pairs):
                lot = tuple(batch.column(name)[row].as_py() for name in (*keys, "_lot"))
                if best is None or lot != current:
                    if best is not None:
                        yield from best.rows()
                    best, current, lot_contents = _Best(asked, k, distance), lot, opened(packed)
                for asking, near in nearness(batch, row, lot_contents, contents):
                    best.add(asking, near, ids)
        if best is not None:
            yield from best.rows()

    # Small partitions of a few keys are not put together: they hold the work. A merge join
    # lays the blocks of a lot side by side.
    tasks = max(parts, int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = [side.repartition(tasks, *keys) for side in (lots, blocks)]
    met = dealt[0].hint("merge").join(dealt[1], keys)
    return met.mapInArrow(run, f"question {question_type}, id {id_type}, distance double")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("question").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _cosine(
    batch: pa.RecordBatch, row: int, vectors: pa.Array | np.ndarray, contents: pa.Array
) -> Iterator[tuple[np.ndarray, _Products]]:
    wanted = vectors if isinstance(vectors, np.ndarray) else _matrix(vectors)
    yield from _products(wanted, _matrix(contents, wanted.shape[1], batch.column("block")[row].values.field("id")))


def _distance(cosines: np.ndarray) -> np.ndarray:
    # Adding zero turns a rounded -0.0 into 0.0.
    return np.round(1.0 - cosines, _DECIMALS) + 0.0


def _one_of(ident: str, count: int, what: str) -> Column:
    """A number below ``count`` for each ident, independent of those of another ``what`` and of the parts of a key."""
    return F.pmod(F.xxhash64(F.lit(what), ident), F.lit(count)).cast("long")


def _all_of(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def search(asked: DataFrame, held: DataFrame, k: int, filters: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """Rows (question, id, distance, rank): the exact ``k`` nearest of ``held`` (id, embedding) per question of
    ``asked`` (question, embedding), among documents that equal it in ``always`` and in every filter it sets.

    Questions are distinct, but for ``always``, where one may have several values.
    """
    kinds = asked.schema["question"].dataType.simpleString(), held.schema["id"].dataType.simpleString()
    found = None
    for used in product((True, False), repeat=len(filters)):
        keys = [*always, *[n for n, chosen in zip(filters, used, strict=True) if chosen]]
        mine, own = asked, held
        for name, chosen in zip(filters, used, strict=True):
            mine = mine.where(F.col(name).isNotNull() if chosen else F.col(name).isNull())
        whole = not keys  # every question meets every document, its group in one of the slots
        if whole:
            own = own.withColumn("_slot", _one_of("id", SLOTS, "slot"))
            mine = mine.withColumn("_group", _one_of("question", GROUPS, "group"))
        asking = mine.select(_all_of(SLOTS).alias("_slot")) if whole else mine.select(*keys)
        by = (["_slot"], ["_group"]) if whole else (keys, keys)
        own = own.select("id", "embedding", *by[0]).join(asking.distinct(), by[0], "left_semi")
        blocks = _packed(own, by[0], "id", "embedding", BLOCK_DOCS, "block")
        lots = _packed(mine, by[1], "question", "embedding", LOT_QUESTIONS, "lot")
        if whole:
            blocks, lots = blocks.withColumn("_group", _all_of(GROUPS)), lots.withColumn("_slot", _all_of(SLOTS))
            keys = ["_group", "_slot"]
        part = _meet(blocks, lots, keys, k, _matrix, _cosine, _distance, *kinds, GROUPS * SLOTS if whole else 1)
        found = part if found is None else found.unionByName(part)
    return _nearest(found, k)


def knn_postings(
    questions: DataFrame,
    docs: DataFrame,
    k: int = 6,
    filters: Sequence[str] = ("camera_id", "date"),
    payload: Sequence[str] = (),
    question_id: str = "question_id",
) -> DataFrame:
    """Exact neighbours as :func:`tidewatch.operators.knn.knn_filtered` gives them, multiplying allowed pairs only.

    For each set of filters that some question sets, documents are packed by the values of
    those filters and meet the questions of the same values. Null values of documents match
    no filter; null ids and empty vectors are left out; question ids should be distinct.
    """
    asked = _filled(questions).select(F.col(question_id).alias("question"), "embedding", *filters)
    top = search(asked, _filled(docs).where(F.col("id").isNotNull()), k, filters)
    if payload:
        top = top.join(docs.select("id", *payload), "id")
    return top.select(F.col("question").alias(question_id), "rank", "id", *payload, "distance")


@dataclass(frozen=True)
class Quantizer:
    """Unit centres of cells, and for each part of a vector the values that stand for what is left of it."""

    centers: np.ndarray  # cells x size
    books: list[np.ndarray]  # levels x size of the part

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each unit vector, and one byte per part for the rest."""
        cell = (vectors @ self.centers.T).argmax(axis=1)
        rest = vectors - self.centers[cell]
        codes = [_closest(part, book) for part, book in zip(self._parts(rest), self.books, strict=True)]
        return cell, np.stack(codes, axis=1).astype(np.uint8)

    def _parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.split(vectors, np.cumsum([b.shape[1] for b in self.books])[:-1], axis=1)

    def decode(self, cell: int, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes of a cell stand for."""
        rest = [book[codes[:, number]] for number, book in enumerate(self.books)]
        return self.centers[cell] + np.concatenate(rest, axis=1)


def _closest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (rows @ centers.T - (centers**2).sum(axis=1) / 2).argmax(axis=1)


def _means(rows: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres of ``count`` groups by Lloyd's rounds; a group that loses all rows keeps its centre."""
    centers = rows[rng.permutation(len(rows))[:count]].copy()
    for _ in range(rounds):
        own = _closest(rows, centers)
        sizes = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, rows)
        centers[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centers


def fit_quantizer(docs: DataFrame, cells: int = 64, parts: int = 16, levels: int = 256, sample: int = 20_000, seed: int = 11) -> Quantizer:
    """Cells and code books fitted on about ``sample`` of the documents, chosen by a hash of their id.

    The sample is what the driver gets. Vectors have to be of one length.
    """
    rows = _filled(docs).where(F.col("id").isNotNull())
    share = min(1.0, sample / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else rows
    got = chosen.select("id", "embedding").toArrow().sort_by("id")
    vectors, rng = _matrix(got["embedding"], ids=got["id"]), np.random.default_rng(seed)
    centers = _unit(_means(vectors, cells, rng))
    rest = vectors - centers[(vectors @ centers.T).argmax(axis=1)]
    return Quantizer(centers, [_means(part, levels, rng) for part in np.array_split(rest, min(parts, rest.shape[1]), axis=1)])


def add_codes(docs: DataFrame, quantizer: Quantizer) -> DataFrame:
    """Every document with a vector, with its ``cell`` and ``code``; store it by cell."""

    @F.pandas_udf("struct<cell:int,code:binary>")
    def coded(vectors: pd.Series) -> pd.DataFrame:
        cell, codes = quantizer.encode(_matrix(pa.array(vectors.tolist()), quantizer.centers.shape[1]))
        return pd.DataFrame({"cell": cell.astype("int32"), "code": [c.tobytes() for c in codes]})

    return _filled(docs).withColumn("_coded", coded("embedding")).select("*", "_coded.*").drop("_coded")


def knn_quantised(
    questions: DataFrame,
    index: DataFrame,
    quantizer: Quantizer,
    k: int = 6,
    probes: int = 32,
    compared: int = 60,
    question_id: str = "question_id",
) -> DataFrame:
    """Approximate neighbours: codes of the ``probes`` nearest cells, then vectors of the ``compared`` best.

    ``index`` is what :func:`add_codes` gives. All codes of a probed cell are read, none of
    their vectors; the ``compared`` documents of the best table sums are compared exactly, and
    distances are exact. Ids are distinct; documents without one are left out.
    """
    size = quantizer.centers.shape[1]
    kinds = questions.schema[question_id].dataType.simpleString(), index.schema["id"].dataType.simpleString()

    @F.pandas_udf("array<int>")
    def probed(vectors: pd.Series) -> pd.Series:
        near = -(_matrix(pa.array(vectors.tolist()), size) @ quantizer.centers.T)
        return pd.Series(list(np.argsort(near, axis=1, kind="stable")[:, :probes].astype("int32")))

    @F.arrow_udf("double")
    def distance(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(_distance((_matrix(left, size) * _matrix(right, size)).sum(axis=1)), from_pandas=True)

    def opened(lot: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The unit vectors of a lot, and which cell (row) each of its questions (column) probes."""
        visits = lot.field("probed")
        places = np.repeat(np.arange(len(visits)), visits.value_lengths().to_numpy(zero_copy_only=False))
        probes = np.zeros((len(quantizer.centers), len(visits)), dtype=bool)
        probes[visits.flatten().to_numpy(zero_copy_only=False), places] = True
        return _matrix(lot.field("embedding"), size), probes

    def by_codes(
        batch: pa.RecordBatch, row: int, lot: tuple[np.ndarray, np.ndarray], contents: pa.Array
    ) -> Iterator[tuple[np.ndarray, _Products]]:
        cell = batch.column("cell")[row].as_py()
        asking = np.flatnonzero(lot[1][cell])
        if len(asking):
            codes = np.frombuffer(b"".join(contents.to_pylist()), np.uint8).reshape(len(contents), -1)
            for some, near in _products(lot[0][asking], quantizer.decode(cell, codes)):
                yield asking[some], near

    def behind(products: np.ndarray) -> np.ndarray:
        # Documents of one code differ by rounding only; the lower id goes first.
        return -np.round(products, _CODE_DECIMALS)

    asked = _filled(questions).select(F.col(question_id).alias("question"), "embedding")
    held = index.where(F.col("id").isNotNull())
    # Codes are small: each group of questions gets those of all cells, so that a question's
    # best are found in one place and only they are shuffled.
    blocks = _packed(held.select("cell", "id", "code"), ["cell"], "id", "code", CODES_PER_VECTOR * BLOCK_DOCS, "block")
    visiting = asked.select(
        "question",
        F.struct("embedding", probed("embedding").alias("probed")).alias("visit"),
        _one_of("question", CODE_READERS, "reader").alias("_reader"),
    )
    lots = _packed(visiting, ["_reader"], "question", "visit", LOT_QUESTIONS, "lot")
    blocks = blocks.withColumn("_reader", _all_of(CODE_READERS))
    near = _meet(blocks, lots, ["_reader"], compared, opened, by_codes, behind, *kinds, CODE_READERS)
    best = _nearest(near, compared).select("question", "id")
    exact = best.join(asked, "question").join(held.select("id", F.col("embedding").alias("vector")), "id")
    top = _nearest(exact.select("question", "id", distance("embedding", "vector").alias("distance")), k)
    return top.select(F.col("question").alias(question_id), "rank", "id", "distance")
