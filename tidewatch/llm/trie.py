"""Prefix trie of conversations, with subtree sums by the Euler-tour technique.

A conversation's first d turns are known by two 64-bit sums (exclusive or) of hashes that
bind each turn to its place, so a prefix costs no more than a turn, however long it is, and
prefixes of a conversation are running sums over a global order, cut anywhere. Equal prefixes
are a node. Every node has an enter and an exit arc; each arc's successor in the tour follows
from first children and next siblings. The list of arcs is ranked in two steps: parts of
neighbouring arcs follow their own links inside tasks, and the chains that are left jump over
each other, twice as far each round. A subtree's sums are differences of prefix sums at its
top's two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.positions import ROW_BITS, with_positions
from tidewatch.session import materialize, release

#: Arcs whose links one task call follows, and arcs that one window sums.
PART = 1 << 15

KEY = ["depth", "p1", "p2"]


def running_in_groups(df: DataFrame, key: str, order: list, columns: list[str], name: str) -> DataFrame:
    """``df`` with each row's number within its key, from 1, as ``nth``, and running xors of ``columns`` in their place.

    Rows are dealt by ranges of key and order, so a key that holds a third of all rows runs
    over many tasks; each task's first key takes over what the tasks before it have summed.
    The driver gets four values per partition. Keys are not null.
    """
    kept = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sums, count = None, {c: np.int64(0) for c in columns}, 0
        for frame in frames:
            if not len(frame):
                continue
            keys = frame[key].to_numpy()
            new = np.r_[keys[0] != last, keys[1:] != keys[:-1]]
            place = np.arange(len(keys))
            start = np.maximum.accumulate(np.where(new, place, -1))  # -1: the key goes on from the frame before
            nth = np.where(start < 0, place + 1 + count, place - start + 1)
            frame = frame.assign(nth=nth)
            for c in columns:
                total = np.bitwise_xor.accumulate(frame[c].to_numpy())
                before = np.where(start > 0, total[np.maximum(start - 1, 0)], 0)
                frame[c] = total ^ np.where(start < 0, sums[c], before)
                sums[c] = frame[c].iloc[-1]
            last, count = keys[-1], int(nth[-1])
            yield frame

    sorted_ = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    made = materialize(
        sorted_.mapInPandas(run, f"{layout}, nth long").withColumn("row", F.monotonically_increasing_id()), name
    )
    part = F.shiftrightunsigned("row", ROW_BITS)
    ends = made.groupBy(part.alias("part")).agg(
        F.min(key).alias("first"), F.max_by(F.struct(key, "nth", *columns), "row").alias("last")
    )
    carried, trail = [], None
    for end in sorted(ends.collect(), key=lambda r: r.part):
        last = [end.last[key], end.last["nth"], *(end.last[c] for c in columns)]
        if trail and trail[0] == end.first:
            carried.append((end.part, *trail))
            if last[0] == end.first:
                last = [last[0], last[1] + trail[1], *(a ^ b for a, b in zip(last[2:], trail[2:], strict=True))]
        trail = last
    names = ["part", "first", "more", *(f"x_{c}" for c in columns)]
    carry = df.sparkSession.createDataFrame(carried, ", ".join(f"{n} long" for n in names))
    met = made.join(F.broadcast(carry), (part == carry["part"]) & (F.col(key) == carry["first"]), "left")  # a row per partition
    new = {c: F.col(c).bitwiseXOR(F.coalesce(f"x_{c}", F.lit(0))).alias(c) for c in columns}
    nth = F.col("nth") + F.coalesce("more", F.lit(0))
    return met.select(*[new.get(c, F.col(c)) for c in kept], nth.alias("nth"))


def rebuild(
    conversations: DataFrame,
    *,
    family: int = 5,
    heads: int = 9,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows (conv, depth, role, digest, bytes, last): conversations that share their families' first turns.

    Conversation c begins with the first h turns of the conversation c - c % ``family``, where
    h is the CRC-32 of c's decimal form modulo ``heads``; its own turns after its first h
    follow. A row of depth 0 stands for its beginning; ``last`` marks its end. Turns are
    sorted by turn, nulls first, then role and the text's MD5; null roles and texts are
    empty. Rows without a conversation are left out, repeated ones are turns of their own,
    other columns are not read, and an empty table gives no rows.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    given = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        empty(role_col).alias("role"),
        F.md5(empty(text_col)).alias("digest"),
        F.octet_length(empty(text_col)).cast("long").alias("bytes"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    turns = materialize(running_in_groups(given, "conv", order, [], "turns").drop("turn"), "numbered-turns")
    sizes = turns.groupBy("conv").agg(F.max("nth").alias("n")).withColumns(
        {"h": F.crc32(F.col("conv").cast("string")) % heads, "base": F.col("conv") - F.col("conv") % family}
    )
    sizes = materialize(sizes, "conversations")
    bases = sizes.select(F.col("conv").alias("base"), F.least("n", F.lit(heads - 1)).alias("base_n"))
    placed = sizes.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    placed = placed.select("conv", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    own = turns.join(placed, "conv").where("nth > h").withColumn("depth", F.col("nth") - F.col("h") + F.col("k"))
    shared = (
        turns.where(F.col("nth") < heads)
        .withColumnRenamed("conv", "base")
        .join(placed, "base")
        .where("nth <= h")
        .withColumn("depth", F.col("nth"))
    )
    columns = ["conv", "depth", "role", "digest", "bytes", (F.col("depth") == F.col("length")).alias("last")]
    roots = placed.withColumns({"depth": F.lit(0), "role": F.lit(""), "digest": F.lit(""), "bytes": F.lit(0)})
    return roots.select(*columns).unionByName(own.select(*columns)).unionByName(shared.select(*columns))


def follow(frame: pd.DataFrame) -> pd.DataFrame:
    """For arcs with contiguous ids: the arc outside to which each one's chain leads, the steps to it, and whether a chain begins here."""
    frame = frame.sort_values("arc")
    arc, following = frame["arc"].to_numpy(), frame["next"].to_numpy()
    low, count = arc[0], len(arc)
    inside = (following >= low) & (following < low + count)
    to = np.where(inside, following - low, np.arange(count))
    head = np.ones(count, bool)
    head[to[inside]] = False
    steps = inside.astype(np.int64)
    while True:
        further = to[to]
        if (further == to).all():
            break
        steps, to = steps + steps[to], further
    return frame.drop(columns="next").assign(target=following[to], steps=steps + 1, head=head)


def rank_list(arcs: DataFrame, count: int) -> DataFrame:
    """Rows of ``arcs`` (arc, next, further columns) with their place in the list, from 0, as ``place``, without ``next``.

    Arcs have ids from 0 to ``count`` - 1; the last one's ``next`` is -1. Parts of ``PART``
    neighbouring ids follow their links in tasks; what is left are chains that begin where
    another part's lead in. They jump in Spark: each round every chain takes over the target
    and the steps of its target, so ``log2`` of their number of rounds rank any list. Each
    round is written to the shared folder.
    """
    rest = [f"{f.name} {f.dataType.simpleString()}" for f in arcs.schema if f.name != "next"]
    followed = materialize(
        arcs.groupBy(F.floor(F.col("arc") / PART).alias("part")).applyInPandas(
            follow, ", ".join([*rest, "target long", "steps long", "head boolean"])
        ),
        "arc-chains",
    )
    chains = materialize(followed.where("head").select("arc", "target", "steps"), "chains")
    for _ in range(max(chains.count() - 1, 0).bit_length()):
        onto = chains.select(F.col("arc").alias("target"), F.col("target").alias("further"), F.col("steps").alias("more"))
        former, chains = chains, materialize(
            chains.join(onto, "target", "left").select(
                "arc",
                F.when(F.col("target") < 0, -1).otherwise(F.col("further")).cast("long").alias("target"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            ),
            "chains",
        )
        release(former)
    ends = chains.select(F.col("arc").alias("target"), F.col("steps").alias("more"))
    left = F.col("steps") + F.coalesce("more", F.lit(0))
    return followed.join(ends, "target", "left").withColumn("place", F.lit(count) - left).drop("target", "steps", "more", "head")


def running_sums(df: DataFrame, place: str, columns: list[str], count: int) -> DataFrame:
    """``df`` with ``columns`` summed over all rows up to each; ``place`` numbers the rows from 0 to ``count`` - 1.

    Windows sum blocks of ``PART`` places; sums of blocks are summed alike, level by level.
    """
    block = F.floor(F.col(place) / PART)
    within = Window.partitionBy("block").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("block", block).withColumns({c: F.sum(c).over(within) for c in columns})
    if count <= PART:
        return local.drop("block")
    sums = df.groupBy(block.alias("block")).agg(*[F.sum(c).alias(c) for c in columns])
    upto = running_sums(sums.withColumnRenamed("block", "level"), "level", columns, -(-count // PART))
    before = upto.select((F.col("level") + 1).alias("block"), *[F.col(c).alias(f"b_{c}") for c in columns])
    whole = {c: F.col(c) + F.coalesce(f"b_{c}", F.lit(0)) for c in columns}
    return local.join(before, "block", "left").withColumns(whole).drop("block", *[f"b_{c}" for c in columns])


def hash_ends(ends: DataFrame) -> DataFrame:
    """Rows (depth, p1, p2, ends_sha256): SHA-256 of each node's conversations, ascending and joined by commas.

    Ids are written out by ranges, so that a node where a third of all conversations end is
    a few long pieces when it meets in a task, which hashes them one after the other.
    """

    def runs(frame: pd.DataFrame):
        keys = frame[KEY].to_numpy()
        edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
        return keys, edges

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                keys, edges = runs(frame)
                convs = frame["conv"].tolist()
                rows = [(*keys[a], convs[a], ",".join(map(str, convs[a:b]))) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pd.DataFrame(rows, columns=[*KEY, "first", "ids"])

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for frame in frames:
            done = []
            for *found, ids in frame[[*KEY, "ids"]].itertuples(index=False):
                if found != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = found, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    layout = "depth long, p1 long, p2 long"
    written = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInPandas(write, f"{layout}, first long, ids string")
    return written.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInPandas(digest, f"{layout}, ends_sha256 string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv, depth, role, digest, bytes, last).

    Each conversation has a row for every depth from 0 to its length; 0 is its textless
    beginning and ``last`` marks its length. Rows: conv_id (the smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256; subtree values count the node itself. Equal conversations are members of
    the same nodes; no rows give no nodes. Prefixes are told apart by 128 bits.
    """
    bound = lambda seed: F.when(F.col("depth") > 0, F.xxhash64(F.lit(seed), "depth", "role", "digest")).otherwise(0)
    hashed = sequences.select(
        F.col("conv").cast("long").alias("conv"), F.col("depth").cast("long").alias("depth"),
        F.col("bytes").cast("long").alias("bytes"), "last", bound(1).alias("x1"), bound(2).alias("x2"),
    ).withColumns({"p1": F.col("x1"), "p2": F.col("x2")})
    prefixes = materialize(running_in_groups(hashed, "conv", [F.asc("depth")], ["p1", "p2"], "prefixes"), "conversation-prefixes")
    before = lambda n: F.min(F.col(f"p{n}").bitwiseXOR(F.col(f"x{n}"))).alias(f"q{n}")
    distinct = materialize(
        prefixes.groupBy(*KEY).agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), before(1), before(2)
        ),
        "trie-prefixes",
    )
    tops = distinct.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent")
    )
    linked = distinct.join(tops, ["depth", "q1", "q2"], "left").drop("q1", "q2")
    nodes = materialize(
        with_positions(linked, [F.asc_nulls_first("parent"), F.asc("depth"), F.asc("conv")], "id", "trie-order"), "trie-nodes"
    )
    kids = nodes.where("depth > 0").groupBy("parent", (F.col("depth") - 1).alias("depth")).agg(
        F.min("id").alias("first"), F.max("id").alias("final"), F.count("*").alias("n_children")
    )
    nodes = materialize(nodes.join(kids.withColumnRenamed("parent", "conv"), ["conv", "depth"], "left"), "trie-families")
    up = nodes.select(
        F.col("conv").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("id").alias("above"), F.col("final").alias("youngest")
    )
    leaving = F.when(F.col("above").isNull(), -1).when(F.col("id") == F.col("youngest"), 2 * F.col("above") + 1)
    arcs = nodes.join(up, ["parent", "depth"], "left").select(
        F.inline(
            F.array(
                F.struct(
                    (2 * F.col("id")).alias("arc"),
                    F.coalesce(2 * F.col("first"), 2 * F.col("id") + 1).alias("next"),
                    F.col("first").isNull().cast("long").alias("leaves"),
                    ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                ),
                F.struct(
                    (2 * F.col("id") + 1).alias("arc"),
                    leaving.otherwise(2 * F.col("id") + 2).cast("long").alias("next"),
                    F.lit(0).cast("long").alias("leaves"),
                    F.lit(0).cast("long").alias("saved"),
                ),
            )
        )
    )
    count = 2 * nodes.count()
    ranked = rank_list(arcs, count).withColumns({"own_leaves": F.col("leaves"), "own_saved": F.col("saved")})
    summed = running_sums(ranked, "place", ["leaves", "saved"], count)
    signed = lambda c: F.sum(F.when(F.col("arc") % 2 == 1, F.col(c)).otherwise(F.col(f"own_{c}") - F.col(c)))
    subtrees = summed.groupBy(F.shiftright("arc", 1).alias("id")).agg(
        signed("leaves").alias("n_leaves"), signed("saved").alias("saved_tokens")
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(subtrees, "id")
        .join(hash_ends(prefixes.where("last").select(*KEY, "conv")), KEY, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
