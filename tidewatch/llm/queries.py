"""The numbered queries, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    ann, licenses, linededup, mixing, neardup, packing, quality, resampling, secrets, tokens, toxicity, trie, urls,
)
from tidewatch.llm.text import word_count
from tidewatch.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def repeating_weights(sources: list) -> dict:
    """5, 2, 1 in turn."""
    return {s: (5, 2, 1)[n % 3] for n, s in enumerate(sources)}


@query(
    "op1_mix_sources",
    """
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
             md5(concat_ws(':', 'mix', doc_id::VARCHAR)) AS hash
      FROM documents
    ),
    sources AS (SELECT source, sum(size)::BIGINT AS whole FROM sized GROUP BY source),
    weighed AS (
      SELECT source, whole, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sources
    ),
    sorted AS (
      SELECT *, row_number() OVER (ORDER BY 3 * whole / weight, source) AS place,
             sum(whole) OVER () AS total
      FROM weighed
    ),
    levels AS (
      SELECT *, (total - coalesce(sum(3 * whole) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / (sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM sorted
    ),
    fixed AS (SELECT place, level FROM levels WHERE weight * level <= 3 * whole ORDER BY place LIMIT 1),
    targets AS (
      SELECT l.source, l.whole, CASE WHEN l.place < f.place THEN (3 * l.whole)::DOUBLE ELSE l.weight * f.level END AS target
      FROM levels l, fixed f
    ),
    placed AS (
      SELECT s.doc_id, s.size, t.whole, t.target,
             2 * floor(t.target)::BIGINT - s.size - 2 * (sum(s.size) OVER (
               PARTITION BY s.source ORDER BY s.hash, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size) AS spared
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size::BIGINT AS size, whole AS source_size, target,
           (size * CASE WHEN whole = 0 THEN 1 WHEN spared < 0 THEN 0
                        ELSE least(3, spared // (2 * whole) + 1) END)::BIGINT AS taken
    FROM placed
    """,
)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", F.array("source").alias("sources"), word_count(F.col("text")).alias("size"))
    chosen, sizes, targets = mixing.mix(sized, weights=repeating_weights)
    each = spark.createDataFrame(
        [(s, sizes[s], targets[s]) for s in sizes], "source string, source_size long, target double"
    )
    return chosen.join(
        F.broadcast(each), F.get("members", F.lit(0)).eqNullSafe(F.col("source"))  # no more rows than patterns
    ).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_pack")
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


@query(
    "op4_line_dedup",
    """
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
      FROM documents
    ),
    keyed AS (
      SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM lines
    ),
    repeated AS (
      SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ),
    marked AS (
      SELECT k.*, r.key IS NOT NULL AND r.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = materialize(
        docs.select(
            "doc_id",
            "lang",
            quality.stratum_key(F.col("lang")).alias("stratum"),
            quality.measure(F.col("text")).alias("counts"),
        ),
        "quality-counts",
    )
    cutoffs = quality.fit_cutoffs(measured, table(spark, sf_dir, "labels"))
    judged = quality.judge(measured, cutoffs, counts="counts", stratum=F.col("lang"))
    return judged.select(
        "doc_id",
        *[f"counts.{name}" for name in quality.NAMES[:5]],
        quality.base_failed(F.col("counts")).alias("base_failed"),
        "failed_rules",
        "kept",
    )


@query(
    "op8_minhash",
    """
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents
    ),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                          ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s
      FROM words
    ),
    classes AS (SELECT min(doc_id) AS node, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL),
    items AS (SELECT node, n, unnest(s) AS item FROM classes),
    rare AS (SELECT item, row_number() OVER (ORDER BY count(*), item) AS place FROM items GROUP BY item),
    placed AS (
      SELECT node, n, i.item, row_number() OVER (PARTITION BY node ORDER BY place) AS nth FROM items i JOIN rare USING (item)
    ),
    prefixes AS (SELECT * FROM placed WHERE nth <= n - ceil(0.8 * n) + 1),
    candidates AS (
      SELECT DISTINCT a.node AS a, b.node AS b
      FROM prefixes a JOIN prefixes b ON a.item = b.item AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    ),
    links AS (
      SELECT a, b FROM candidates c JOIN classes x ON x.node = c.a JOIN classes y ON y.node = c.b
      WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))
    ),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT node, node AS top FROM classes UNION SELECT w.b, r.top FROM reached r JOIN ways w ON r.node = w.a),
    tops AS (SELECT node, min(top) AS top FROM reached GROUP BY node)
    SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(t.top, d.doc_id) AS component_id,
           d.doc_id = coalesce(t.top, d.doc_id) AS kept
    FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN tops t ON t.node = c.node
    """,
)
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)
    given = lambda c: F.when(F.col(c) != neardup.NO_ID, F.col(c))
    return found.select(
        given("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        given("component").alias("component_id"),
        (F.col("doc") == F.col("component")).alias("kept"),
    )


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon, curve = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.score(F.col("text"), lexicon, curve).alias("s"))
    return scored.select(
        "doc_id",
        (toxicity.bucket(F.col("doc_id")) == 0).alias("held_out"),
        F.col("s.score").alias("score"),
        F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.col("s.clauses").alias("clauses"),
    )


#: The rules of op7: (verdict, host and path).
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_pages(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("page").alias("page_id"), "host", "path", "rule", "verdict", "words")


@query("op3_licenses")
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", licenses.scan(F.col("text"), everywhere=True).alias("found"))
    names = F.array_sort(F.array_distinct("found.license"))
    best = F.round(F.array_max("found.dice"), 9)
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licenses"),
        F.size("found").cast("long").alias("n_notices"),
        best.alias("best_dice"),
    )


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{name}") for number, name in enumerate(secrets.BASE)]
    return found.select(
        F.col("doc").alias("doc_id"),
        *counts,
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


@query("op6_ann")
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ann.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    index = ann.build_index(rows, most=6)
    found = ann.search(index, rows.where(F.col("id") % 50 == 0), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


#: DuckDB has no CRC-32; :data:`CRC_SQL` makes one of a list of bytes.
CRC_SQL = """
    crc_table AS (
      SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
                  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS held
      FROM (SELECT unnest(range(256)) AS i)
    )"""


def crc_sql(bytes_: str) -> str:
    step = "lambda a, b: xor(a >> 8, held[1 + (xor(a, b) & 255)])"
    return f"xor(list_reduce([4294967295] || {bytes_}, {step}), 4294967295)"


@query(
    "op11_prefix_trie",
    f"""
    WITH {CRC_SQL},
    turns AS (
      SELECT conv_id AS conv, row_number() OVER (
               PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS nth,
             coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL
    ),
    sizes AS (
      SELECT conv, conv - conv % 5 AS base, n,
             {crc_sql("list_transform(string_split(conv::VARCHAR, ''), lambda c: ord(c)::BIGINT)")} % 9 AS h
      FROM (SELECT conv, max(nth) AS n FROM turns GROUP BY conv), crc_table
    ),
    placed AS (
      SELECT s.conv, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS k, s.n FROM sizes s LEFT JOIN sizes b ON s.base = b.conv
    ),
    rebuilt AS (
      SELECT p.conv, t.nth AS depth, t.role, t.text FROM placed p JOIN turns t ON t.conv = p.base AND t.nth <= p.h
      UNION ALL
      SELECT p.conv, t.nth - p.h + p.k, t.role, t.text FROM placed p JOIN turns t ON t.conv = p.conv AND t.nth > p.h
    ),
    prefixes AS (
      SELECT conv, depth, octet_length(encode(text)) AS bytes, list({{'role': role, 'text': text}}) OVER (
               PARTITION BY conv ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path
      FROM rebuilt
      UNION ALL SELECT conv, 0, 0, [] FROM placed
    ),
    ways AS (SELECT *, min(conv) OVER (PARTITION BY path) AS node, depth = max(depth) OVER (PARTITION BY conv) AS ends FROM prefixes),
    nodes AS (
      SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS own,
             coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ends), '') AS ended
      FROM ways GROUP BY node, depth
    ),
    parents AS (
      SELECT DISTINCT w.node, w.depth, u.node AS parent FROM ways w JOIN ways u ON u.conv = w.conv AND u.depth = w.depth - 1
    ),
    kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM parents GROUP BY parent, depth),
    below AS (
      SELECT DISTINCT w.node, w.depth, u.node AS inner_node, u.depth AS inner_depth
      FROM ways w JOIN ways u ON u.conv = w.conv AND u.depth >= w.depth
    ),
    sums AS (
      SELECT b.node, b.depth, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(n.own) AS saved
      FROM below b JOIN nodes n ON n.node = b.inner_node AND n.depth = b.inner_depth
      LEFT JOIN kids k ON k.node = b.inner_node AND k.depth = b.inner_depth
      GROUP BY b.node, b.depth
    )
    SELECT n.node AS conv_id, n.depth::BIGINT AS depth, p.parent AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
           s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ended) AS ends_sha256
    FROM nodes n JOIN sums s USING (node, depth) LEFT JOIN parents p USING (node, depth) LEFT JOIN kids k USING (node, depth)
    """,
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuild(table(spark, sf_dir, "conversations")))


@query(
    "op12_importance_resampling",
    f"""
    WITH {CRC_SQL},
    texts AS (SELECT true AS wanted, item_id AS id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents),
    words AS (
      SELECT wanted, id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
      FROM texts
    ),
    spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
    bucketed AS (
      SELECT word, {crc_sql("list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)")} % 10000 AS bucket
      FROM spelled, crc_table
    ),
    counts AS (
      SELECT bucket, count(*) FILTER (wanted) AS t, count(*) FILTER (NOT wanted) AS s
      FROM words JOIN bucketed USING (word) GROUP BY bucket
    ),
    gains AS (
      SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                     / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
      FROM counts
    ),
    weighed AS (
      SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN bucketed USING (word) JOIN gains USING (bucket)
      WHERE NOT wanted GROUP BY id
    ),
    scored AS (
      SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM documents LEFT JOIN weighed ON id = doc_id
    ),
    ranked AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
      FROM scored WHERE n_features >= 20
    )
    SELECT s.doc_id, s.n_features::BIGINT AS n_features, s.weight, s.score, CASE WHEN place <= drawn THEN place END AS rank
    FROM scored s LEFT JOIN ranked USING (doc_id)
    """,
)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank")


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(F.col("doc").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))
