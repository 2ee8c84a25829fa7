"""Secret scans with multipart credential linking, in DataFrame functions only.

Patterns find parts of credentials: some are secrets by themselves, others (names of
clients, endpoints, opaque values) are common and mean something only together. Each part
reaches some way before and behind it; an interval join by position finds which parts lie
within each other's scope, and a weak part is reported only if what it lacks is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """A pattern; ``value`` is the group whose length counts, ``least`` that length."""

    name: str
    pattern: str
    least: int = 1
    value: int = 0
    part: str = "secret"  # what it is of a credential: id, secret or endpoint
    weak: bool = False


#: In the order in which equal starts are reported. Hex and access runs are greedy, so
#: asking for their length in the pattern finds the same as dropping short ones.
KINDS = (
    Kind(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        least=6,
        value=2,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", part="id"),
    Kind("hex", r"[0-9a-f]{24,}"),
    Kind(
        "client",
        r"(?i:client_?id|user_?name|account|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,}",
        part="id",
        weak=True,
    ),
    Kind(
        "endpoint",
        r"(?:https?|ftps?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[A-Za-z0-9._:@-]{4,}",
        part="endpoint",
        weak=True,
    ),
    Kind("opaque", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", weak=True),
)

#: Kinds that are reported wherever they occur.
BASE = tuple(kind.name for kind in KINDS if not kind.weak)

#: Code points that a part's scope reaches before and behind it.
SCOPE = 200


def _lengths(text: Column, kind: Kind) -> Column:
    """Per match: the text before it since the last one, its length, and whether it counts."""
    found = F.regexp_extract_all(text, F.lit(f"({kind.pattern})"), F.lit(1))
    gaps = F.split(text, kind.pattern, -1)
    if kind.value:
        long = lambda m: F.length(F.regexp_extract(m, kind.pattern, kind.value)) >= kind.least
    elif kind.name == "opaque":  # words are no opaque values
        long = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    else:
        long = lambda m: F.lit(True)
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(found)),
        found,
        lambda gap, m: F.struct(
            F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("size"), long(m).alias("counts")
        ),
    )
    none = F.array().cast("array<struct<gap:bigint,size:bigint,counts:boolean>>")
    return F.when(text.rlike(kind.pattern), pairs).otherwise(none)


def parts(docs: DataFrame, *, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows as (doc, digest, copy), and their parts as (…, kind, start, end).

    A row is known by its id, a hash of its text, and a number among its equals. Starts are
    sums of lengths over a window, so the texts themselves are never shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    scanned = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(text).alias("digest"),
        F.array(*[_lengths(text, kind) for kind in KINDS]).alias("kinds"),
    )
    same = Window.partitionBy("doc", "digest").orderBy("digest")
    rows = scanned.withColumn("copy", F.row_number().over(same))
    each = rows.select("doc", "digest", "copy", F.posexplode("kinds").alias("kind", "matches")).select(
        "doc", "digest", "copy", "kind", F.posexplode("matches").alias("nth", "m")
    )
    until = (
        Window.partitionBy("doc", "digest", "copy", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    )
    ends = each.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(until))
    found = ends.where("m.counts").select(
        "doc", "digest", "copy", "kind", (F.col("end") - F.col("m.size")).alias("start"), "end"
    )
    return rows.drop("kinds"), found


def _numbers(**wanted) -> list[int]:
    return [n for n, kind in enumerate(KINDS) if all(getattr(kind, k) == v for k, v in wanted.items())]


def linked(found: DataFrame, *, scope: int = SCOPE) -> DataFrame:
    """The weak parts in whose scope the other parts of a credential lie.

    A client name or an endpoint needs a secret that is one by itself; an opaque value
    needs an id (an access key or a client name) and an endpoint, or an access key alone.
    An opaque value that overlaps a secret is that secret. Parts meet in bins as long as a
    scope, in all that they reach; within a bin matches of a kind do not overlap, so a bin
    holds few, and pairs that meet in several are taken together.
    """
    key = ["doc", "digest", "copy"]
    weak = found.where(F.col("kind").isin(_numbers(weak=True)))
    reached = weak.withColumn(
        "bin",
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.lit(0), F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope)
            )
        ),
    )
    other = found.select(
        *[F.col(c).alias(f"o_{c}") for c in (*key, "kind", "start", "end")],
    ).withColumn("o_bin", F.explode(F.sequence(F.floor(F.col("o_start") / scope), F.floor((F.col("o_end") - 1) / scope))))
    near = (
        F.col("doc").eqNullSafe(F.col("o_doc"))
        & (F.col("digest") == F.col("o_digest"))
        & (F.col("copy") == F.col("o_copy"))
        & (F.col("bin") == F.col("o_bin"))
        & (F.col("o_start") < F.col("end") + scope)
        & (F.col("o_end") > F.col("start") - scope)
        & ((F.col("kind") != F.col("o_kind")) | (F.col("start") != F.col("o_start")))
    )
    kind, met = F.col("kind"), F.col("o_kind")
    secret = met.isin([n for n in _numbers(part="secret", weak=False)])
    overlap = (F.col("o_start") < F.col("end")) & (F.col("o_end") > F.col("start"))
    has = lambda c: F.max(F.coalesce(c, F.lit(False)))
    opaque = _numbers(name="opaque")
    seen = (
        reached.join(other, near, "left")
        .groupBy(*key, "kind", "start", "end")
        .agg(
            has(secret & ~overlap).alias("secret"),
            has(met.isin(_numbers(part="id", weak=False)) & ~overlap).alias("access"),
            has(met.isin(_numbers(part="id")) & ~overlap).alias("id"),
            has(met.isin(_numbers(part="endpoint")) & ~overlap).alias("endpoint"),
            has(~met.isin(_numbers(weak=True)) & overlap).alias("known"),
        )
    )
    complete = F.when(kind.isin(opaque), ~F.col("known") & (F.col("access") | (F.col("id") & F.col("endpoint")))).otherwise(
        F.col("secret")
    )
    return seen.where(complete).select(*key, "kind", "start", "end")


def scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE
) -> DataFrame:
    """One row per row of ``docs``: doc and spans, an array of (start, kind, end) in order.

    Kinds are numbers in ``KINDS``; places are code points of the whole text, ends are
    exclusive. Null and empty texts have no spans; repeated rows have a result each; a null
    id stays null; other columns are not read.
    """
    rows, found = parts(docs, id_col=id_col, text_col=text_col)
    strong = found.where(~F.col("kind").isin(_numbers(weak=True)))
    spans = (
        strong.unionByName(linked(found, scope=scope))
        .groupBy("doc", "digest", "copy")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
        .select(F.col("doc").alias("s_doc"), F.col("digest").alias("s_digest"), F.col("copy").alias("s_copy"), "spans")
    )
    same = (
        F.col("doc").eqNullSafe(F.col("s_doc"))
        & (F.col("digest") == F.col("s_digest"))
        & (F.col("copy") == F.col("s_copy"))
    )
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(spans, same, "left").select("doc", F.coalesce("spans", empty).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
