"""Dropping lines that other documents hold, by a sharded minimal perfect hash.

The keys of repeated lines are dealt over shards by their hash. A shard is a minimal
perfect hash (a cascade of bit arrays, where a key takes the rank of the first bit it has
alone) and three arrays in its order: fingerprint, number of documents, and the smallest
document. Documents send the hashes of their lines to the shards, and what a shard cannot
have seen is told by its fingerprint. Lines are never joined; each text is shuffled once,
to meet the hashes that it loses.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

#: A shard has about so many keys at most, whatever their number.
SHARD_KEYS = 100_000

#: A shard's probes are dealt over copies of it, about so many to a copy.
PROBES_PER_COPY = 200_000

#: Bits of a level for each key that reaches it.
BITS_PER_KEY = 2

SHARD = "shard int, levels array<int>, bits binary, ranks binary, prints binary, counts binary, keepers binary"

#: Stands for a null id: one document, smaller than all others.
NO_ID = -(2**63)


def line_key(line: str) -> str:
    """The line without white space at both ends, A-Z in lower case."""
    return line.encode().strip().lower().decode()


def key_hash(line: str, least: int) -> bytes | None:
    """128 bits for the key of a line, or None if it has fewer than ``least`` code points."""
    key = line.encode().strip().lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode()) < least:
        return None
    return xxhash.xxh3_128_digest(key)


def _spread(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """A place below ``size`` for each key (two 64-bit halves), another for each level."""
    step = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % 2**64)
    x = keys[:, 0] + keys[:, 1] * step
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def build_shard(keys: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> dict:
    """The arrays of a shard over distinct keys, as bytes."""
    levels, words, rest = [], [], keys
    while len(rest):
        size = -(-BITS_PER_KEY * len(rest) // 64) * 64
        place = _spread(rest, len(levels), size)
        alone = np.bincount(place, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little"))
        levels.append(size)
        rest = rest[~alone[place]]
    bits = np.concatenate(words) if words else np.zeros(0, np.uint8)
    held = np.bitwise_count(bits.view(np.uint64)).astype(np.uint32)
    made = {"levels": levels, "bits": bits.tobytes(), "ranks": (np.cumsum(held, dtype=np.uint32) - held).tobytes()}
    at = positions(made, keys)
    arrays = {"prints": keys[:, 1], "counts": counts.astype(np.uint32), "keepers": keepers.astype(np.int64)}
    for name, values in arrays.items():
        ordered = np.empty_like(values)
        ordered[at] = values
        made[name] = ordered.tobytes()
    return made


def positions(shard: dict, keys: np.ndarray) -> np.ndarray:
    """The place of each key in the shard's arrays; -1 for some that it does not hold."""
    bits = np.frombuffer(shard["bits"], np.uint64)
    ranks = np.frombuffer(shard["ranks"], np.uint32)
    out = np.full(len(keys), -1, np.int64)
    open_, first = np.arange(len(keys)), 0
    for level, size in enumerate(shard["levels"]):
        place = _spread(keys[open_], level, int(size)) + np.uint64(first)
        word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        hit = (bits[word] >> bit) & np.uint64(1) == 1
        below = bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        out[open_[hit]] = ranks[word[hit]] + np.bitwise_count(below).astype(np.int64)
        open_, first = open_[~hit], first + int(size)
        if not len(open_):
            break
    return out


def probe(shard: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: whether the shard holds it, in how many documents, and the smallest."""
    at = positions(shard, keys)
    prints = np.frombuffer(shard["prints"], np.uint64)
    held = at >= 0
    held[held] = prints[at[held]] == keys[held, 1]
    counts, keepers = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    counts[held] = np.frombuffer(shard["counts"], np.uint32)[at[held]]
    keepers[held] = np.frombuffer(shard["keepers"], np.int64)[at[held]]
    return held, counts, keepers


def _halves(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)


def document_keys(docs: DataFrame, *, id_col: str, text_col: str, least: int) -> DataFrame:
    """Each document's distinct line keys as rows (doc, key)."""

    @F.pandas_udf("array<binary>")
    def keys(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list({h for line in (t or "").split("\n") if (h := key_hash(line, least))}))

    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.explode(keys(F.col(text_col))).alias("key")
    )


def build_index(keys: DataFrame) -> DataFrame:
    """Shards, as ``SHARD`` and the number of probes to come, over keys of two documents or more.

    ``keys`` has distinct rows (doc, key); they are counted before they are dealt.
    """
    spark = keys.sparkSession
    seen = materialize(
        keys.groupBy("key")
        .agg(F.count("*").alias("count"), F.min("doc").alias("keeper"), F.max("doc").alias("last"))
        .select("key", "count", "keeper", (F.col("keeper") < F.col("last")).alias("repeated")),
        "line-keys",
    )
    size = seen.agg(F.sum(F.col("repeated").cast("long"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_KEYS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = build_shard(_halves(rows["key"]), rows["count"].to_numpy(), rows["keeper"].to_numpy())
        return pd.DataFrame([made | {"shard": int(rows["shard"].iloc[0])}])

    dealt = seen.withColumn("shard", shard_of(shards))
    index = dealt.where("repeated").drop("repeated").groupBy("shard").applyInPandas(build, SHARD)
    probes = dealt.groupBy("shard").agg(F.sum("count").alias("probes"))
    return materialize(index.join(probes, "shard").withColumn("shards", F.lit(shards)), "line-shards")


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


def dropped_keys(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Rows (doc, keys): the keys that a document loses, found by probing the shards.

    Each shard is copied as often as its probes ask for, and a document's hash says which
    copy it asks; so a line that a third of all documents hold is probed in many tasks.
    """
    sizes = index.select(
        "shard", "shards", F.ceil(F.col("probes") / PROBES_PER_COPY).cast("int").alias("copies")
    ).collect()  # one row per shard of some 100,000 keys
    shards = sizes[0].shards if sizes else 1
    copies = keys.sparkSession.createDataFrame([(r.shard, r.copies) for r in sizes], "shard int, copies int")
    asked = (
        keys.withColumn("shard", shard_of(shards))
        .join(F.broadcast(copies), "shard")
        .select("shard", F.pmod(F.xxhash64("doc"), F.col("copies")).cast("int").alias("copy"), "doc", "key")
    )
    answering = index.withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.ceil(F.col("probes") / PROBES_PER_COPY).cast("int") - 1))
    ).drop("probes", "shards")

    def answer(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(probes) or not len(shard):
            return pd.DataFrame({"doc": pd.Series(dtype="int64"), "key": pd.Series(dtype="object")})
        held, _, keepers = probe(shard.iloc[0].to_dict(), _halves(probes["key"]))
        return probes.loc[held & (keepers != probes["doc"].to_numpy()), ["doc", "key"]]

    lost = (
        asked.groupBy("shard", "copy")
        .cogroup(answering.groupBy("shard", "copy"))
        .applyInPandas(answer, "doc long, key binary")
    )
    return lost.groupBy("doc").agg(F.collect_set("key").alias("keys"))


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 10
) -> DataFrame:
    """Drop lines that a document with a smaller id holds too.

    Texts are split at line feeds; null and empty texts are one empty line. Lines whose key
    (``line_key``) has at least ``least`` code points and is found in two documents or more
    go, but for all those of the smallest id. Returns all columns of ``docs``, the text
    replaced, with ``n_lines`` (before) and ``n_dropped``; columns of these names are
    replaced. Ids are integers; rows that share an id are one document, a null id is one
    document smaller than all. An empty table stays empty.
    """
    keys = materialize(document_keys(docs, id_col=id_col, text_col=text_col, least=least).distinct(), "line-probes")
    lost = dropped_keys(keys, build_index(keys))

    @F.pandas_udf("struct<n_lines:long,n_dropped:long,text:string>")
    def keep(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = []
        for text, keys in zip(texts, gone, strict=True):
            lines = (text or "").split("\n")
            if keys is None:
                rows.append((len(lines), 0, text or ""))
                continue
            drop = set(keys)
            kept = [line for line in lines if key_hash(line, least) not in drop]
            rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
        return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "text"])

    here = docs.drop("n_lines", "n_dropped").withColumn(
        "__line_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    )
    there = lost.select(F.col("doc").alias("__line_doc"), F.col("keys").alias("__line_keys"))
    return (
        here.join(there, "__line_doc", "left")
        .withColumn("__kept", keep(F.col(text_col), F.col("__line_keys")))
        .withColumns(
            {text_col: F.col("__kept.text"), "n_lines": F.col("__kept.n_lines"), "n_dropped": F.col("__kept.n_dropped")}
        )
        .drop("__line_doc", "__line_keys", "__kept")
    )
