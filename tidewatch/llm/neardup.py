"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``SKETCH`` bins. In round i each shingle is hashed to one bin with the value
i plus a fraction; a bin keeps its least value. Rounds stop when every bin is filled; from
round ``SKETCH`` on each round serves one bin with all shingles, so all get filled. Bins of
two sketches agree with the probability of the sets' similarity, and because a round
throws all shingles at all bins, the share of equal bins is concentrated about it.

``BANDS`` bands of equal bins propose links; sets confirm them. With 32 bands of 4 bins a
pair of similarity 0.8 is missed by all with a probability of (1 - 0.8^4)^32 = 5e-8.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

SKETCH = 128
BANDS = 32
EMPTY = np.uint64(2**64 - 1)

#: Members of a band's bucket that are compared with as many others at a time.
BLOCK = 256

#: Shingles of a block's sets, on average, where sets are large: 8 MB of hashes.
BLOCK_SHINGLES = 1 << 20

#: Stands for a null id: one document, smaller than all others.
NO_ID = -(2**63)

#: Word hashes a worker remembers before it starts afresh.
KNOWN_WORDS = 100_000


class WordHashes(dict):
    """64-bit hashes of words, found once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        made = xxhash.xxh3_64_intdigest(word)
        self[word] = made
        return made


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``size`` words, A-Z in lower case.

    Fewer words are one shingle; no words are none.
    """
    found = text.encode().lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    code = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(size, len(found))
    out = np.full(len(code) - size + 1, size, np.uint64)
    for step in range(size):
        out = _mix(out + code[step : len(code) - size + 1 + step])
    return np.unique(out)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The bins of a set that is not empty: round in the upper 16 bits, then the fraction."""
    bins = np.full(SKETCH, EMPTY)
    per_pass = 6 * SKETCH // len(shingles) + 1
    for first in range(0, SKETCH, per_pass):
        rounds = np.arange(first, min(SKETCH, first + per_pass), dtype=np.uint64)[:, None]
        thrown = _mix(shingles[None, :] + (rounds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        values = (rounds << np.uint64(48)) | (thrown >> np.uint64(16))
        np.minimum.at(bins, (thrown % np.uint64(SKETCH)).ravel(), values.ravel())
        if not (bins == EMPTY).any():
            return bins
    left = np.flatnonzero(bins == EMPTY)
    rounds = (left.astype(np.uint64) + np.uint64(SKETCH))[:, None]
    thrown = _mix(shingles[None, :] + (rounds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    bins[left] = ((rounds << np.uint64(48)) | (thrown >> np.uint64(16))).min(axis=1)
    return bins


def band_keys(bins: np.ndarray) -> list[int]:
    """A signed 64-bit key for each band, other for each band's number."""
    rows = bins.reshape(BANDS, -1)
    return [xxhash.xxh3_64_intdigest(rows[b].tobytes(), seed=b) - 2**63 for b in range(BANDS)]


def features(docs: DataFrame, *, id_col: str, text_col: str, size: int) -> DataFrame:
    """Per row: doc, n (shingles), digest of the set and band keys; null for an empty set."""

    @F.pandas_udf("struct<n:long,digest:binary,bands:array<long>>")
    def describe(texts: pd.Series) -> pd.DataFrame:
        hashes, rows = WordHashes(), []
        for text in texts:
            found = shingle_set(text, size, hashes)
            if len(found):
                rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), band_keys(sketch(found))))
            else:
                rows.append((0, None, None))
        return pd.DataFrame(rows, columns=["n", "digest", "bands"])

    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), describe(F.col(text_col)).alias("f")
    ).select("doc", "f.*")


def full_sets(docs: DataFrame, wanted: DataFrame, *, id_col: str, text_col: str, size: int) -> DataFrame:
    """Rows (doc, set) for the documents in ``wanted`` (doc): the sorted hashes as bytes."""

    @F.pandas_udf("binary")
    def collect(texts: pd.Series) -> pd.Series:
        hashes = WordHashes()
        return texts.map(lambda t: shingle_set(t, size, hashes).tobytes())

    here = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text_col).alias("text"))
    return here.join(wanted, "doc", "left_semi").select("doc", collect("text").alias("set")).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """Rows (node, label): the smallest node that each node of ``links`` (a, b) can reach.

    Each round takes the least label about each node and then the label of that label, so
    that ways halve; a round that changes nothing ends it. Each round's table is written
    to the shared folder.
    """
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-links",
    )
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")
    )
    labels = materialize(labels, f"{name}-labels")
    while True:
        about = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        )
        nearer = labels.join(about, labels["node"] == about["a"]).select(
            "node", F.least("label", "near").alias("to"), F.col("label").alias("old")
        )
        aim = labels.select(F.col("node").alias("to"), F.col("label").alias("next"))
        labels = materialize(
            nearer.join(aim, "to").select("node", F.least("to", "next").alias("label"), "old"), f"{name}-labels"
        )
        changed = labels.where("label <> old").limit(1).count()
        labels = labels.select("node", "label")
        if not changed:
            return labels


def similar(inner: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inner >= percent * (n + m - inner)


def overlaps(sets: list[np.ndarray], rows: int) -> np.ndarray:
    """Sizes of the intersections of the first ``rows`` sets with all."""
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(code, minlength=len(values)) > 1
    rank = np.cumsum(shared) - 1
    keep = shared[code]
    code, owner = rank[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((rows, len(sets)), np.float32)
    step = 4096
    edges = np.searchsorted(code, np.arange(0, shared.sum() + step, step))
    for number in range(len(edges) - 1):
        part = slice(edges[number], edges[number + 1])
        held = np.zeros((len(sets), step), np.float32)
        held[owner[part], code[part] - number * step] = 1
        out += held[:rows] @ held.T
    return out.astype(np.int64)


def spanning_links(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between documents (node, label, set) of both sides and of different components.

    Only as many as join all components that are linked.
    """
    sets = [np.frombuffer(s, np.uint64) for frame in (left, right) for s in frame["set"]]
    nodes = [*left["node"], *right["node"]]
    labels = [*left["label"], *right["label"]]
    parent = {x: x for x in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = len(left)
    n = np.array([len(s) for s in sets])
    linked = similar(overlaps(sets, first)[:, first:], n[:first, None], n[None, first:], percent)
    found = []
    for i, j in np.argwhere(linked):
        a, b = root(labels[i]), root(labels[j + first])
        if a != b:
            parent[max(a, b)] = min(a, b)
            found.append((nodes[i], nodes[j + first]))
    return found


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Rows (doc, n, component): each row's shingle count and the least id linked with it.

    Documents are linked if the sets of their shingles have a similarity of ``percent``
    in a hundred or more; components follow links of any length. Null texts and texts
    without words have no shingles, are linked with nothing and are their own component.
    Ids are integers, null is ``NO_ID``; rows that share an id count as linked. An empty
    table gives no rows. Other columns are not read.

    1. Rows with equal sets become one node, the smallest id.
    2. In each bucket of a band the smallest node is compared with the others.
    3. In buckets that still hold several components, the nodes outside the smallest node's
       component are compared with all others, in blocks of ``BLOCK`` by ``BLOCK`` inside
       tasks, which return only links that join components. Blocks of large sets hold fewer,
       ``BLOCK_SHINGLES`` shingles; a larger set than that is alone with few.

    So no bucket's pairs become rows, however large it is, and no pair of a bucket is left
    out unless it is in one component already.
    """
    where = {"id_col": id_col, "text_col": text_col, "size": shingle_words}
    rows = materialize(features(docs, **where), "sets")
    classes = materialize(
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "set-classes",
    )
    banded = classes.select(F.explode("bands").alias("key"), "node", "n")
    leaders = (
        banded.groupBy("key")
        .agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("many"))
        .where("many > 1")
        .select("key", "many", F.col("first.node").alias("leader"), F.col("first.n").alias("leader_n"))
    )
    buckets = materialize(banded.join(leaders, "key"), "set-buckets")
    sets = materialize(full_sets(docs, buckets.select(F.col("node").alias("doc")).distinct(), **where), "full-sets")

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right, strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            inner = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * inner >= percent * (len(x) + len(y) - inner))
        return pd.Series(out, dtype=bool)

    stars = (
        buckets.where(
            (F.col("node") != F.col("leader"))
            & (100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n"))
        )
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
        .join(sets.select(F.col("doc").alias("b"), F.col("set").alias("b_set")), "b")
        .join(sets.select(F.col("doc").alias("a"), F.col("set").alias("a_set")), "a")
        .where(linked("a_set", "b_set"))
        .select("a", "b")
    )
    labels = components(stars, "star")
    placed = buckets.select("key", "many", "node", "n").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    # Buckets of the same documents are one; of two documents all pairs are compared by now.
    open_ = (
        placed.where("many > 2")
        .groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min_by("label", "node").alias("home"),
            F.count("*").alias("many"),
            F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
        )
        .where("low <> high")
        .groupBy("many", "members")
        .agg(F.min(F.struct("key", "home")).alias("one"))
        .select("one.*")
    )
    within = materialize(placed.join(open_, "key").select("key", "node", "n", "label", "home"), "open-buckets")
    stray = F.col("label") != F.col("home")

    def blocks(which: Column) -> Column:
        few = F.greatest(F.count_if(which) / BLOCK, F.sum(F.when(which, F.col("n"))) / BLOCK_SHINGLES)
        return F.ceil(few).cast("int")

    counts = within.groupBy("key").agg(blocks(F.lit(True)).alias("rows"), blocks(stray).alias("columns"))
    sized = within.join(counts, "key").select("key", "node", "label", stray.alias("stray"), "rows", "columns")
    own = lambda count: F.pmod(F.xxhash64("node", "key"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    met = (
        sized.withColumns({"i": own("rows"), "left": F.lit(False)})
        .withColumn("j", every("columns"))
        .unionByName(
            sized.where("stray").withColumns({"j": own("columns"), "left": F.lit(True)}).withColumn("i", every("rows"))
        )
        .select("key", "i", "j", "left", "node", "label")
        .join(sets.withColumnRenamed("doc", "node"), "node")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = spanning_links(group[group["left"]], group[~group["left"]], percent)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    more = met.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()
    known = labels.select("node", "label")
    joined = (
        more.join(known.select(F.col("node").alias("a"), F.col("label").alias("a_label")), "a", "left")
        .join(known.select(F.col("node").alias("b"), F.col("label").alias("b_label")), "b", "left")
        .select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    )
    upper = components(joined, "all").select(F.col("node").alias("label"), F.col("label").alias("top"))
    of_class = (
        classes.select("digest", "node")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .join(upper, "label", "left")
        .select("digest", F.coalesce("top", "label").alias("component"))
    )
    return rows.join(of_class, "digest", "left").select("doc", "n", F.coalesce("component", "doc").alias("component"))
