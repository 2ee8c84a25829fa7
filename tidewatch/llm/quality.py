"""Quality rules with risk-controlled cutoffs.

Each rule is a ratio of counts on a fixed grid. A cutoff may be used in a stratum only if
labelled good documents show, by an exact binomial test, that it rejects no more than
``alpha`` of them; the error of all tests together stays below ``delta``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.text import SPACES, words

SYMBOLS = "#*$%&|<>"

#: Words of a window that counts as repeated when the text holds it twice.
WINDOW = 5

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper_words long, n_exclaims long"
)
NAMES = [part.split()[0] for part in MEASURES.split(", ")]

#: rule: (count, per count, steps of the grid per unit, last step). A document's value is
#: floor(steps * count / per count), at most the last step; large values are bad.
RULES = {
    "symbols": ("n_symbols", "n_words", 100, 100),
    "repeated_lines": ("n_dup_lines", "n_lines", 100, 100),
    "repeated_words": ("n_repeat_words", "n_words", 100, 100),
    "upper_words": ("n_upper_words", "n_words", 100, 100),
    "exclaims": ("n_exclaims", "n_words", 100, 100),
    "long_words": ("word_chars", "n_words", 10, 300),
    "short_words": ("n_words", "word_chars", 100, 100),
}

#: More strata than this are joined by a shuffle instead of a broadcast.
BROADCAST_STRATA = 10_000

CUTOFFS = "stratum string, rule string, cutoff int, good long, good_rejected long, bad_rejected long"


def repeated_words(text_words: list[bytes]) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more."""
    if len(text_words) <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    code = np.fromiter((known.setdefault(w, len(known)) for w in text_words), np.int64, len(text_words))
    window = code
    for step in range(1, WINDOW):  # each step codes windows of one word more as small numbers again
        _, window = np.unique(window[:-1] * len(known) + code[step:], return_inverse=True)
    twice = np.bincount(window)[window] > 1
    covered = np.zeros(len(text_words), bool)
    for step in range(WINDOW):
        covered[step : step + len(twice)] |= twice
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The counts named in ``MEASURES``; null has none of anything."""
    found = words(text)
    if not found:
        return (0, 0, sum(text.count(s) for s in SYMBOLS) if text else 0, 0, 0, 0, 0, 0)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(found),
        len(text) - sum(text.count(s) for s in SPACES),
        sum(text.count(s) for s in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(found),
        len(lines),
        sum(w.isupper() for w in found),
        text.count("!"),
    )


def measure(text: Column) -> Column:
    """The counts of a text as a struct."""

    @F.pandas_udf(f"struct<{MEASURES.replace(' ', ':').replace(',:', ',')}>")
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=NAMES)

    return counts(text)


def base_failed(counts: Column) -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def rule_value(counts: Column, rule: str) -> Column:
    count, per, steps, last = RULES[rule]
    ratio = F.floor(counts[count] * steps / counts[per])
    return F.when(counts[per] > 0, F.least(F.lit(last), ratio)).otherwise(0).cast("int")


def stratum_key(stratum: Column) -> Column:
    """Null is a stratum of its own."""
    return F.when(stratum.isNull(), "-").otherwise(F.concat(F.lit("="), stratum.cast("string")))


def most_rejected(good: int, alpha: float, error: float) -> int:
    """The most rejections among ``good`` that prove a rate of at most ``alpha``, or -1.

    That is the largest k with P(Binomial(good, alpha) <= k) <= error.
    """
    top = int(good * alpha)
    if good < 1 or top < 0:
        return -1
    k = np.arange(1, top + 1)
    steps = np.log((good - k + 1) / k) + math.log(alpha) - math.log1p(-alpha)
    logs = good * math.log1p(-alpha) + np.concatenate([[0.0], np.cumsum(steps)])
    return int((np.logaddexp.accumulate(logs) <= math.log(error)).sum()) - 1


def choose_cutoff(good: np.ndarray, bad: np.ndarray, allowed: int, price: float) -> tuple[int, int, int] | None:
    """The best proven cutoff: (cutoff, good rejected, bad rejected), or None.

    ``good`` and ``bad`` count documents by grid value. Cutoffs are tested from the most
    lenient on and testing stops at the first that fails, so tests within a rule need no
    correction. Among the proven ones that with the largest number of bad documents
    rejected, less ``price`` for each good one, is taken; of equal ones the most lenient.
    """
    lost = good.sum() - np.cumsum(good)
    gained = bad.sum() - np.cumsum(bad)
    gain = np.where(lost <= allowed, gained - price * lost, 0)
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return (best, int(lost[best]), int(gained[best])) if gain[best] > 0 else None


def fit_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    *,
    alpha: float = 0.05,
    delta: float = 0.05,
    price: float = 20.0,
) -> DataFrame:
    """Cutoffs per stratum and rule, as ``CUTOFFS``.

    ``measured`` has doc_id, stratum (see ``stratum_key``) and counts; ``labels`` has
    doc_id and quality (1 good, 0 bad; of several labels of a document the least counts,
    null ones do not). All labelled documents that pass the base rules take part. Of the
    good ones of a stratum at most ``alpha`` are wrongly rejected, with probability
    ``1 - delta`` for all strata and rules at once: each rule gets an equal share of
    ``alpha``, each pair of rule and stratum an equal share of ``delta``. Strata with too
    few good documents to prove anything have no cutoffs; no labels give none at all.
    """
    truth = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("good"))
    held = (
        measured.where(~base_failed(F.col("counts")))
        .join(truth, "doc_id")
        .select(
            "stratum",
            "good",
            F.posexplode(F.array(*[rule_value(F.col("counts"), rule) for rule in RULES])).alias("rule", "value"),
        )
        .groupBy("stratum", "rule", "value")
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum(1 - F.col("good").cast("long")).alias("bad"))
    )
    strata = held.select("stratum").distinct().count()
    rules = list(RULES.items())

    def fit(cells: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for number, of in cells.groupby("rule"):
            name, (_, _, _, last) = rules[number]
            good, bad = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
            good[of["value"]], bad[of["value"]] = of["good"], of["bad"]
            allowed = most_rejected(int(good.sum()), alpha / len(rules), delta / (len(rules) * strata))
            if found := choose_cutoff(good, bad, allowed, price):
                rows.append((of["stratum"].iloc[0], name, found[0], int(good.sum()), *found[1:]))
        return pd.DataFrame(rows, columns=[part.split()[0] for part in CUTOFFS.split(", ")])

    return held.groupBy("stratum").applyInPandas(fit, CUTOFFS)


def judge(rows: DataFrame, cutoffs: DataFrame, *, counts: str, stratum: Column) -> DataFrame:
    """Adds ``failed_rules`` and ``kept`` to rows with a struct of counts.

    Rows of a stratum without cutoffs are judged by the base rules alone. There are as
    many rows of cutoffs as strata times rules; they are joined by broadcast up to
    ``BROADCAST_STRATA`` strata. Columns of the rows that bear those two names are
    replaced.
    """
    rows = rows.drop("failed_rules", "kept")
    by_stratum = cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__cutoffs")
    )
    found = by_stratum.limit(BROADCAST_STRATA + 1).collect()
    if len(found) <= BROADCAST_STRATA:
        by_stratum = F.broadcast(rows.sparkSession.createDataFrame(found, by_stratum.schema))
    by_stratum = by_stratum.withColumnRenamed("stratum", "__stratum")
    over = F.array_compact(
        F.array(
            *[
                F.when(rule_value(F.col(counts), rule) > F.col("__cutoffs")[rule], F.lit(rule))
                for rule in RULES
            ]
        )
    )
    judged = rows.join(by_stratum, stratum_key(stratum) == F.col("__stratum"), "left").withColumn(
        "failed_rules", F.coalesce(over, F.array().cast("array<string>"))
    )
    kept = ~base_failed(F.col(counts)) & (F.size("failed_rules") == 0)
    return judged.withColumn("kept", kept).drop("__cutoffs", "__stratum")
