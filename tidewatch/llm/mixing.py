"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed up by membership pattern, the set of sources they belong to. Each
pattern can give its words up to ``max_copies`` times, each repetition at a higher cost
than the one before; each source asks for a quota. The flow over that small graph says
how many words of a pattern go to which source; seeded documents then fill it.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialize

Source = str | None

#: Hex digits of the seeded hash that name a part of a pattern.
PART_DIGITS = 3


def source_key(source: Source) -> tuple[bool, str]:
    """Code point order, null last."""
    return (source is None, source or "")


def share_targets(sizes: dict[Source, int], weights: dict[Source, int], max_copies: int) -> dict[Source, float]:
    """Share all sizes by weight; what is above ``max_copies`` sizes is shared anew by the rest."""
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(max_copies * sizes[s] for s in capped)
        weight = sum(weights[s] for s in sizes if s not in capped)
        above = {s for s in sizes if s not in capped and weights[s] * rest > max_copies * sizes[s] * weight}
        if not above:
            break
        capped |= above
    return {s: float(max_copies * sizes[s]) if s in capped else weights[s] * (rest / weight) for s in sizes}


def route(
    capacity: dict[str, int], members: dict[str, list[Source]], quotas: dict[Source, int], max_copies: int
) -> dict[str, dict[Source, int]]:
    """Words that each pattern gives to each of its sources, at the least cost.

    The n-th repetition costs the same in all patterns and more than the one before, so a
    cheapest way never uses a repetition while a way over earlier ones is left. Each pass
    opens one more repetition and augments along shortest ways, which may take words of
    another pattern from a source that has other suppliers.
    """
    given: dict[str, dict[Source, int]] = {p: dict.fromkeys(members[p], 0) for p in capacity}
    takers: dict[Source, set[str]] = {s: set() for s in quotas}
    need = dict(quotas)
    spare = dict.fromkeys(capacity, 0)
    for _ in range(max_copies):
        for pattern in spare:
            spare[pattern] += capacity[pattern]
        for pattern in sorted(capacity):
            while spare[pattern] > 0:
                came: dict[tuple[str, Source], tuple[str, Source] | None] = {("p", pattern): None}
                queue, end = deque([("p", pattern)]), None
                while queue and end is None:
                    node = queue.popleft()
                    if node[0] == "p":
                        steps = [("s", s) for s in members[node[1]] if s in need]
                    elif need[node[1]] > 0:
                        end = node
                        break
                    else:
                        steps = [("p", p) for p in sorted(takers[node[1]])]
                    for step in steps:
                        if step not in came:
                            came[step] = node
                            queue.append(step)
                if end is None:
                    break
                way = [end]
                while came[way[-1]] is not None:
                    way.append(came[way[-1]])
                way.reverse()
                back = [(way[i][1], way[i + 1][1]) for i in range(1, len(way) - 1, 2)]  # (source, pattern) given up
                words = min([spare[pattern], need[end[1]], *(given[p][s] for s, p in back)])
                for s, p in back:
                    given[p][s] -= words
                    if not given[p][s]:
                        takers[s].discard(p)
                for i in range(0, len(way), 2):
                    p, s = way[i][1], way[i + 1][1]
                    given[p][s] += words
                    takers[s].add(p)
                spare[pattern] -= words
                need[end[1]] -= words
    return given


def mix(
    sized: DataFrame,
    *,
    weights,
    seed: str = "mix",
    max_copies: int = 3,
    also: tuple[str, ...] = (),
) -> tuple[DataFrame, dict[Source, int], dict[Source, float]]:
    """Choose how often each document is taken.

    ``sized`` has doc_id, sources (array of names, null is a name too) and size;
    ``weights`` maps the sources in order to integers. Returns the rows with ``copies``
    (0 to ``max_copies``), ``taken`` (words, repeats counted) and ``given_to`` (the source
    each copy counts for), the size of each source and its target; columns named in ``also``
    are kept, others not read. The same rows and seed
    give the same choice. Documents of a pattern without words are taken once; a null or
    empty ``sources`` belongs to no source and is not taken; an empty table gives no rows.
    Only one row per pattern reaches the driver, and of patterns of a single source there
    are no more than sources. Rows of one id and size are told apart by ``also``.

    The order of documents in a pattern is that of a seeded hash. Its first digits name a
    part; a document's place is the size of the parts before its own and of what precedes
    it inside, so that no pattern is sorted in one task.
    """
    spark = sized.sparkSession
    members = F.array_sort(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>"))))
    hashed = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    rows = materialize(
        sized.select(
            "doc_id", *also, F.col("size").cast("long").alias("size"), members.alias("members"), hashed.alias("hash")
        ).withColumns({"pattern": F.to_json("members"), "part": F.substring("hash", 1, PART_DIGITS)}),
        "mix-sizes",
    )
    sums = rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("size")).collect()
    sizes: dict[Source, int] = {}
    for row in sums:
        for source in row.members:
            sizes[source] = sizes.get(source, 0) + row.size
    sizes = {s: sizes[s] for s in sorted(sizes, key=source_key)}
    targets = share_targets(sizes, weights(list(sizes)), max_copies)
    given = route(
        {r.pattern: r.size for r in sums},
        {r.pattern: list(r.members) for r in sums},
        {s: int(t) for s, t in targets.items()},
        max_copies,
    )
    plan = []
    for row in sums:
        upto, segments = 0, []
        for source in sorted(given[row.pattern], key=source_key):
            upto += given[row.pattern][source]
            segments.append((source, upto))
        plan.append((row.pattern, row.size, upto, segments))
    routed = spark.createDataFrame(
        plan, "pattern string, whole long, flow long, segments array<struct<source:string,upto:long>>"
    )
    parts = rows.groupBy("pattern", "part").agg(F.sum("size").alias("many"))
    before = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("pattern", "part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("pattern", "part").orderBy("hash", "doc_id", "size", *also)
    placed = rows.withColumn(
        "inner", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ).join(starts, ["pattern", "part"])
    at = F.col("base") + F.col("inner")
    spared = 2 * F.col("flow") - 2 * at - F.col("size")
    copies = (
        F.when(F.size("members") == 0, 0)
        .when(F.col("whole") == 0, 1)
        .when(spared < 0, 0)
        .otherwise(F.least(F.lit(max_copies), F.floor(spared / (2 * F.col("whole"))) + 1))
        .cast("int")
    )
    middle = lambda n: n * F.col("whole") + F.col("at") + F.floor(F.col("size") / 2)
    chosen = (
        placed.join(routed, "pattern")
        .withColumns({"copies": copies, "at": at})
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn(
            "given_to",
            F.when(
                F.col("copies") > 0,
                F.transform(
                    F.sequence(F.lit(0), F.col("copies") - 1),
                    lambda n: F.coalesce(
                        F.get(F.filter("segments", lambda s: s["upto"] > middle(n)), 0),
                        F.try_element_at("segments", F.lit(-1)),
                    )["source"],
                ),
            ).otherwise(F.array().cast("array<string>")),
        )
        .select("doc_id", *also, "members", "size", "copies", "taken", "given_to")
    )
    return chosen, sizes, targets
