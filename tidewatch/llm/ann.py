"""Approximate nearest neighbours by cosine: a navigable small-world graph per shard.

Distinct vectors are dealt over shards by hash. A shard's graph has layers; each vector is
in layers 0 to a height drawn from a hash, linked with near vectors that lie in different
directions. Graphs are rows of flat arrays. Each block of queries walks each shard's graph,
all queries of the block at a time, and the shards' finds are merged. All similarities are
doubles, since among near copies those in floats are noise.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialize

#: Vectors of a shard, about.
SHARD_ROWS = 8192

#: Queries that walk a graph together, about.
BLOCK_ROWS = 1024

#: Links of a vector in a layer, candidates they are chosen from, and places of a search beam.
WIDTH, CANDIDATES, BEAM = 24, 64, 128

GRAPH = (
    "dim int, shard int, vectors binary, ids binary, ids_from binary, "
    "layer_sizes array<int>, layer_nodes binary, layer_links binary"
)


def heights(count: int) -> np.ndarray:
    """Top layer of each vector of a shard, geometric with the ratio 1 / WIDTH."""
    x = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    share = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return np.floor(-np.log(share) / math.log(WIDTH)).astype(np.int64)


def diverse(order: np.ndarray, near: np.ndarray, most: int) -> list[int]:
    """Of candidates from near to far those that are nearer to the vector than to one chosen before.

    ``near`` holds the similarities among the candidates, in ``order`` those to the vector.
    Places that stay open are filled with the nearest of the rest.
    """
    chosen, rest = [], []
    for i in range(len(order)):
        (chosen if all(near[i, j] < order[i] for j in chosen) else rest).append(i)
        if len(chosen) == most:
            return chosen
    return chosen + rest[: most - len(chosen)]


def link_layer(unit: np.ndarray) -> np.ndarray:
    """Links (rows, WIDTH), padded with -1, among the vectors of a layer.

    As if inserted one by one: each vector is linked with diverse ones of the nearest
    before it; then both directions are cut to WIDTH, again diverse. The link to the
    nearest one before always stays, so that all can be reached.
    """
    count = len(unit)
    forward = np.full((count, WIDTH // 2), -1, np.int32)
    nearest = np.full(count, -1, np.int32)
    for first in range(0, count, 512):
        rows = unit[first : first + 512]
        similar = rows @ unit[: first + len(rows)].T
        similar[np.arange(len(rows))[:, None] + first <= np.arange(similar.shape[1])[None, :]] = -np.inf
        keep = min(CANDIDATES, similar.shape[1])
        best = np.argpartition(-similar, keep - 1, axis=1)[:, :keep]
        for i in range(len(rows)):
            found = best[i][np.isfinite(similar[i, best[i]])]
            if len(found):
                found = found[np.lexsort((found, -similar[i, found]))]
                picked = diverse(similar[i, found], unit[found] @ unit[found].T, WIDTH // 2)
                forward[first + i, : len(picked)] = found[picked]
                nearest[first + i] = found[0]
    to = forward.ravel()
    at = np.repeat(np.arange(count, dtype=np.int32), WIDTH // 2)[to >= 0]
    to = to[to >= 0]
    ends, others = np.concatenate([at, to]), np.concatenate([to, at])
    order = np.argsort(ends, kind="stable")
    ends, others = ends[order], others[order]
    edges = np.searchsorted(ends, np.arange(count + 1))
    links = np.full((count, WIDTH), -1, np.int32)
    for i in range(count):
        found = np.unique(others[edges[i] : edges[i + 1]])
        if len(found) > WIDTH:
            similar = unit[found] @ unit[i]
            found = found[np.lexsort((found, -similar))]
            picked = found[diverse(unit[found] @ unit[i], unit[found] @ unit[found].T, WIDTH)]
            if nearest[i] >= 0 and nearest[i] not in picked:
                picked[-1] = nearest[i]
            found = picked
        links[i, : len(found)] = found
    return links


def build_graph(vectors: np.ndarray) -> dict:
    """Layers of a graph over the rows of ``vectors``: nodes and, per node, links to nodes."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    top = heights(len(vectors))
    sizes, nodes, links = [], [], []
    for layer in range(int(top.max(initial=0)) + 1):
        members = np.flatnonzero(top >= layer).astype(np.int32)
        if layer and len(members) < 2:
            break
        sizes.append(len(members))
        nodes.append(members)
        inner = link_layer(unit[members])
        links.append(np.where(inner >= 0, members[inner], -1).astype(np.int32))
    return {
        "layer_sizes": sizes,
        "layer_nodes": np.concatenate(nodes).tobytes(),
        "layer_links": np.concatenate(links).tobytes(),
    }


def walk(unit: np.ndarray, nodes: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int):
    """Beams (node, similarity) of all queries after a best-first walk over one layer.

    Each step opens the best node of each beam that is not open yet and merges its
    neighbours; a query is done when all nodes of its beam are open.
    """
    many = len(queries)
    place = np.full(len(unit), -1, np.int32)
    place[nodes] = np.arange(len(nodes), dtype=np.int32)
    seen = np.zeros((many, len(nodes)), bool)
    held = np.full((many, beam), -1, np.int32)
    value = np.full((many, beam), -np.inf)
    opened = np.ones((many, beam), bool)
    width = min(beam, starts.shape[1])
    held[:, :width] = starts[:, :width]
    real = held >= 0
    value[real] = np.einsum("ij,ij->i", unit[held[real]], queries[np.nonzero(real)[0]])
    opened[real] = False
    seen[np.nonzero(real)[0], place[held[real]]] = True
    active = np.arange(many)
    while len(active):
        open_value = np.where(opened[active], -np.inf, value[active])
        best = open_value.argmax(axis=1)
        going = ~opened[active, best]
        active, best = active[going], best[going]
        if not len(active):
            break
        opened[active, best] = True
        near = links[place[held[active, best]]]
        row = np.repeat(active, near.shape[1])
        node = near.ravel()
        fresh = node >= 0
        row, node = row[fresh], node[fresh]
        new = ~seen[row, place[node]]
        row, node = row[new], node[new]
        seen[row, place[node]] = True
        gained = np.full((len(active), near.shape[1]), -np.inf)
        which = np.full((len(active), near.shape[1]), -1, np.int32)
        if len(row):
            local = np.searchsorted(active, row)
            column = np.arange(len(row)) - np.searchsorted(row, row)
            gained[local, column] = np.einsum("ij,ij->i", unit[node], queries[row])
            which[local, column] = node
        all_values = np.concatenate([value[active], gained], axis=1)
        order = np.argpartition(-all_values, beam - 1, axis=1)[:, :beam]
        value[active] = np.take_along_axis(all_values, order, axis=1)
        held[active] = np.take_along_axis(np.concatenate([held[active], which], axis=1), order, axis=1)
        state = np.concatenate([opened[active], which < 0], axis=1)
        opened[active] = np.take_along_axis(state, order, axis=1)
    return held, value


def search_graph(graph: dict, queries: np.ndarray) -> np.ndarray:
    """For each query the nodes of its whole beam, -1 where there are fewer."""
    vectors = graph["vectors"]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    asked = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    ends = np.cumsum(graph["layer_sizes"])
    layers = [slice(end - size, end) for end, size in zip(ends, graph["layer_sizes"], strict=True)]
    starts = np.repeat(graph["layer_nodes"][layers[-1]][:1][None, :], len(asked), axis=0)
    for number in range(len(layers) - 1, -1, -1):
        part = layers[number]
        held, value = walk(
            unit, graph["layer_nodes"][part], graph["layer_links"][part], asked, starts, BEAM if number == 0 else 4
        )
        order = np.argsort(-value, axis=1, kind="stable")
        starts = np.take_along_axis(held, order, axis=1)
    return starts


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, vector as doubles) whose vector is finite, not null and not zero."""
    value = F.col("vector")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where(value.isNotNull() & F.col("id").isNotNull())
        .where(finite & F.exists(value, lambda x: x != 0))
    )


def build_index(rows: DataFrame, *, most: int) -> DataFrame:
    """Graphs, as ``GRAPH``, over all rows (id, vector).

    Equal vectors are one node with its ``most`` smallest ids: no more of them can be among
    the nearest of any query. Vectors of different length are in different shards.
    """
    first = Window.partitionBy("vector").orderBy("id")
    distinct = (
        rows.withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= most)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
        .withColumn("dim", F.size("vector"))
    )
    distinct = materialize(distinct, "ann-vectors")
    counts = distinct.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))
    dealt = distinct.join(F.broadcast(counts), "dim").withColumn(  # one row per length of vectors
        "shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int")
    )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(low=[ids[0] for ids in group["ids"]]).sort_values("low")
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        lengths = np.array([0, *(len(ids) for ids in group["ids"])], np.int64)
        made = build_graph(vectors) | {
            "dim": int(group["dim"].iloc[0]),
            "shard": int(group["shard"].iloc[0]),
            "vectors": vectors.tobytes(),
            "ids": np.concatenate(group["ids"].to_numpy()).astype(np.int64).tobytes(),
            "ids_from": np.cumsum(lengths).tobytes(),
        }
        return pd.DataFrame([made])

    return materialize(dealt.groupBy("dim", "shard").applyInPandas(build, GRAPH), "ann-graphs")


def unpack(row: dict) -> dict:
    return {
        "vectors": np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"]),
        "ids": np.frombuffer(row["ids"], np.int64),
        "ids_from": np.frombuffer(row["ids_from"], np.int64),
        "layer_sizes": [int(n) for n in row["layer_sizes"]],
        "layer_nodes": np.frombuffer(row["layer_nodes"], np.int32),
        "layer_links": np.frombuffer(row["layer_links"], np.int32).reshape(-1, WIDTH),
    }


def nearest_ids(graph: dict, nodes: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
    """The ``k`` best (id, score) of scored nodes by (score, smallest id), each id once, without ``own``."""
    first, counts = graph["ids_from"][nodes], graph["ids_from"][nodes + 1] - graph["ids_from"][nodes]
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    ids, scores = graph["ids"][np.repeat(first, counts) + within], np.repeat(scores, counts)
    best: dict[int, float] = {}
    for at in np.lexsort((ids, -scores)):
        if ids[at] != own:
            best.setdefault(int(ids[at]), float(scores[at]))
        if len(best) == k:
            break
    return list(best.items())


def search(index: DataFrame, queries: DataFrame, *, k: int = 5) -> DataFrame:
    """Rows (query_id, rank, id, score): the ``k`` nearest found of each query (id, vector).

    Nearest by cosine in doubles on the vectors as given, ties to the smaller id; a row
    with the query's own id is no candidate. ``index`` must hold ``k + 1`` ids per vector.
    Queries without candidates of their length have no rows. Repeated query ids: each row
    is searched, the best of all are returned once.
    """
    places = index.select("dim", "shard")
    blocks = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(queries.count() / BLOCK_ROWS)))).cast("int")
    asked = queries.select("id", "vector", F.size("vector").alias("dim"), blocks.alias("block"))
    used = asked.select("dim", "block").distinct()
    routed = asked.join(F.broadcast(places), "dim")  # one small row per shard of thousands of vectors
    graphs = index.join(F.broadcast(used), "dim")  # one small row per block of about a thousand queries
    graphs = graphs.select(*[F.col(c).alias(f"of_{c}") for c in graphs.columns])

    def find(asked: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(graph):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64"})
        made = unpack({name.removeprefix("of_"): value for name, value in graph.iloc[0].items()})
        vectors = np.stack(asked["vector"].to_numpy()).astype(np.float64)
        found = search_graph(made, vectors)
        lengths = np.linalg.norm(made["vectors"], axis=1)
        rows = []
        for query, vector, nodes in zip(asked["id"], vectors, found, strict=True):
            nodes = nodes[nodes >= 0]
            scores = made["vectors"][nodes] @ vector / (lengths[nodes] * np.linalg.norm(vector))
            rows += [(query, other, score) for other, score in nearest_ids(made, nodes, scores, query, k)]
        return pd.DataFrame(rows, columns=["query_id", "id", "score"])

    keys = ["dim", "shard", "block"]
    found = routed.groupBy(*keys).cogroup(graphs.groupBy(*[f"of_{key}" for key in keys])).applyInPandas(
        find, "query_id long, id long, score double"
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.dropDuplicates(["query_id", "id"])
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
