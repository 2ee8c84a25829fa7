"""URL filters: rules by host and path, host words by Viterbi, naive Bayes for the rest.

Host labels are split at separators; what is still concatenated is split by a unigram
Viterbi search over words that URLs show apart. Substrings find their counts by a join on
distinct labels, so that no dictionary has to fit a task. Naive Bayes reads the words of
hosts and the tokens of paths, hashed to a fixed number of buckets, so that the model has a
fixed size.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Buckets of the classifier.
BUCKETS = 1 << 16

#: Counts that smoothing adds to a class, spread over the buckets by their share of all tokens.
SMOOTHING = 1.0

#: The longest word that Viterbi considers, in characters.
LONGEST = 20

#: Words of hosts that mark unwanted sites, the classifier's starting point. Fixed values.
UNWANTED = (
    "ads adult bet bets betting casino casinos cheap coupon dating escort gamble gambling loan loans "
    "malware phishing pill pills poker porn pharma replica sex slots spam track tracker viagra xxx"
)

#: Words that show where concatenated names come apart, besides those that URLs show. Fixed values.
COMMON = (
    "best blog buy click cloud club daily data deal deals farm fast forum free game games good health home "
    "hot info jobs life live mail market media money music net new news now online open play shop site "
    "sports store tech the time top travel video web win world"
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; without ``://`` empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The struct (rule, verdict) of the longest rule that fits, else null.

    Rules are (verdict, ``host/path``). They fit their host and its subdomains, if the
    path starts with the rule's. Of two of the same length that with the longer host wins.
    They are part of the plan: meant for some hundred, not for millions.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/")))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in reversed(ordered):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith(f".{rule[:at]}")) & path.startswith(rule[at:])
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def split_label(label: str) -> list[str]:
    """Runs of letters or digits; digits become ``#``."""
    return ["#" if part.isdigit() else part for part in re.findall(r"[^\W\d_]+|\d+", label)]


def path_tokens(path: str) -> list[str]:
    return split_label(path.lower())


def viterbi(word: str, known: dict[str, float], total: float) -> list[str]:
    """The likeliest split of a run of letters.

    A word of count c has the probability c / total, one that is not known, of length n,
    10 / (total * 10^n), so that it stays whole unless known words make it up. An unknown
    run only grows by its last letter, so work is the word's length times ``LONGEST``.
    """
    letter, unknown = math.log(10), math.log(10 / total)
    best, back = [0.0], [0]
    run, begin = -math.inf, 0  # the best split that ends in an unknown run, and where that begins
    for end in range(1, len(word) + 1):
        opened = best[end - 1] + unknown
        if opened > run + 1e-12:
            run, begin = opened, end - 1
        run -= letter
        top, at = run, begin
        for start in range(max(0, end - LONGEST), end):
            if count := known.get(word[start:end]):
                value = best[start] + math.log(count / total)
                if value > top + 1e-12 or (start < at and value > top - 1e-12):
                    top, at = value, start
        best.append(top)
        back.append(at)
    out, end = [], len(word)
    while end:
        out.append(word[back[end] : end])
        end = back[end]
    return out[::-1]


def word_counts(pages: DataFrame) -> DataFrame:
    """Rows (word, count) over host and path of all pages: words that separators set apart.

    A label without a separator tells nothing about where words end and does not count.
    Fixed words get a count of their own.
    """

    @F.pandas_udf("array<string>")
    def apart(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        def of(host, path):
            parts = [split_label(label) for label in host.split(".")[:-1]]
            return [w for p in parts if len(p) > 1 for w in p] + path_tokens(path)

        return pd.Series([of(h, p) for h, p in zip(hosts, paths, strict=True)])

    seen = pages.select(F.explode(apart("host", "path")).alias("word")).where("word <> '#'")
    fixed = pages.sparkSession.createDataFrame([(w,) for w in {*UNWANTED.split(), *COMMON.split()}], "word string")
    return seen.union(fixed).groupBy("word").agg(F.count("*").alias("count"))


def segment_hosts(pages: DataFrame) -> DataFrame:
    """Rows (host, words) for the distinct hosts of ``pages`` (host, path).

    The last label, the public suffix, is left out. Hosts without other labels have no words.
    """
    counts = materialize(word_counts(pages), "url-words")
    total = float(counts.agg(F.sum("count")).first()[0])
    hosts = materialize(pages.select("host").distinct(), "url-hosts")

    @F.pandas_udf("array<string>")
    def runs(names: pd.Series) -> pd.Series:
        return names.map(lambda h: [w for label in h.split(".")[:-1] for w in split_label(label)])

    @F.pandas_udf("array<string>")
    def substrings(words: pd.Series) -> pd.Series:
        return words.map(
            lambda w: list({w[i:j] for i in range(len(w)) for j in range(i + 1, min(len(w), i + LONGEST) + 1)})
        )

    split = hosts.select("host", F.posexplode_outer(runs("host")).alias("place", "run"))
    distinct = split.where("run IS NOT NULL AND run <> '#'").select("run").distinct()
    known = (
        distinct.select("run", F.explode(substrings("run")).alias("word"))
        .join(counts, "word")
        .groupBy("run")
        .agg(F.collect_list(F.struct("word", "count")).alias("known"))
    )

    @F.pandas_udf("array<string>")
    def search(runs: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series(
            [
                viterbi(run, {k["word"]: k["count"] for k in (found if found is not None else [])}, total)
                for run, found in zip(runs, known, strict=True)
            ]
        )

    cut = distinct.join(known, "run", "left").select("run", search("run", "known").alias("words"))
    words = F.coalesce("words", F.when(F.col("run").isNotNull(), F.array("run")), F.array().cast("array<string>"))
    return (
        split.join(cut, "run", "left")
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("place", words.alias("words")))).alias("parts"))
        .select("host", F.flatten("parts.words").alias("words"))
    )


def bucket_of(kind: str, token: str) -> int:
    return zlib.crc32(f"{kind}:{token}".encode()) % BUCKETS


def buckets(words: Column, path: Column) -> Column:
    """Buckets of a page's tokens, repeats counted."""

    @F.pandas_udf("array<int>")
    def of(host_words: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [bucket_of("h", w) for w in (words if words is not None else [])]
                + [bucket_of("p", t) for t in path_tokens(path)]
                for words, path in zip(host_words, paths, strict=True)
            ]
        )

    return of(words, path)


def train(tokens: DataFrame) -> tuple[float, np.ndarray]:
    """Prior and weights of multinomial naive Bayes over all rows (blocked, buckets).

    Weights are the log odds of a bucket for blocked pages; buckets that no page has weigh
    nothing. Counts are smoothed by ``SMOOTHING`` times the bucket's share of all tokens, so
    that a class of few pages is drawn towards all pages and not flattened. The driver gets
    two counts per bucket, ``BUCKETS`` of them.
    """
    pages = {r.blocked: r.n for r in tokens.groupBy("blocked").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros((2, BUCKETS))
    seen = tokens.select("blocked", F.explode("buckets").alias("bucket"))
    for row in seen.groupBy("blocked", "bucket").agg(F.count("*").alias("n")).collect():
        counts[int(row.blocked), row.bucket] += row.n
    prior = math.log((pages.get(True, 0) + 1) / (pages.get(False, 0) + 1))
    held = counts.sum(axis=0) > 0
    smooth = counts[:, held] + SMOOTHING * counts[:, held].sum(axis=0) / max(1.0, counts.sum())
    shares = np.log(smooth) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING)
    weights = np.zeros(BUCKETS)
    weights[held] = shares[1] - shares[0]
    return prior, weights


def judge_pages(
    pages: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Rows (page, host, path, rule, verdict, score, words).

    Pages that no rule fits get the classifier's verdict: ``block`` if the log odds of its
    words and tokens are above 0. The classifier starts from hosts that hold an unwanted
    word (``UNWANTED``) and learns what else such sites show; all pages take part. Null URLs
    and such without ``://`` have neither host nor path and are allowed. Repeated rows are
    judged alike, no pages give no rows.
    """
    parsed = pages.select(F.col(id_col).alias("page"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    parsed = materialize(parsed, "url-parts")
    hosts = segment_hosts(parsed)
    unwanted = F.array(*[F.lit(w) for w in UNWANTED.split()])
    rows = materialize(
        parsed.join(hosts, "host").select(
            "page", "host", "path", "words", F.arrays_overlap("words", unwanted).alias("blocked"),
            buckets(F.col("words"), F.col("path")).alias("buckets"),
        ),
        "url-tokens",
    )
    prior, weights = train(rows)

    @F.pandas_udf("double")
    def log_odds(found: pd.Series) -> pd.Series:
        return found.map(lambda b: prior + float(weights[b].sum()) if len(b) else -1.0).astype(float)

    rule = rule_for(F.col("host"), F.col("path"), rules)
    scored = rows.withColumns({"fit": rule, "score": log_odds("buckets")})
    by_score = F.when((F.col("score") > 0) & (F.col("host") != ""), "block").otherwise("allow")
    return scored.select(
        "page", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_score).alias("verdict"),
        "score", "words",
    )
