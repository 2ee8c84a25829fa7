"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the same word classes: insults, threats, targets, negation and
reported speech. Their product is one table; it runs over the clauses that hold an insult
or a threat, and each clause gets the weight of the path it takes. A word's weight as an
insult is learned from labels; words and stems of the same kind share it. A logistic curve
over the clause weights makes the score of a text.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

OTHER, END, MODAL, VERB, TARGET, NOT, REPORT, INSULT = range(8)

#: English function words and verbs of the grammar. Fixed values.
CLASSES = {
    MODAL: "will shall gonna should must i'll we'll they'll he'll",
    VERB: "kill hurt destroy beat shoot stab burn hang crush smash punish",
    TARGET: "you your yours yourself u ur he she him her they them their these those",
    NOT: "not never nobody isn't aren't wasn't weren't don't doesn't didn't won't can't cannot",
    REPORT: "said says saying wrote writes claimed claims alleged quoted quotes called reported reportedly according",
}

#: Words that insult whatever the labels show, so that few labels still give a lexicon. Fixed values.
SEEDS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown"
SEED_WEIGHT = 6.0

#: Lengths of the stems that are learned beside whole words.
STEMS = (4, 5, 6)

#: Words after a negation that it reaches.
REACH = 3

TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;:\n]")
BREAKS = frozenset(".!?;:\n")

#: Word classes a worker remembers before it starts afresh.
KNOWN_WORDS = 300_000


# Each transducer: (first state, step). A step takes a state and a class and gives the
# next state, a factor on the weight of an insult here, and a weight of its own.


def insults(state, cls):
    """The first insult of a clause counts in full, more of them a little less."""
    if cls == INSULT:
        return "seen", 1.0 if state == "none" else 0.8, 0.0
    return ("none" if cls == END else state), 1.0, 0.0


def threats(state, cls):
    """will ... kill ... you: each step may have other words between."""
    if cls == END:
        return "none", 1.0, 0.0
    if cls == MODAL:
        return "will", 1.0, 0.0
    if cls == VERB and state == "will":
        return "act", 1.0, 2.0
    if cls == TARGET and state == "act":
        return "none", 1.0, 4.0
    return state, 1.0, 0.0


def targets(state, cls):
    """An insult that follows a target in its clause is aimed at somebody."""
    if cls == END:
        return "nobody", 1.0, 0.0
    if cls == TARGET:
        return "somebody", 1.0, 0.0
    return state, 1.25 if cls == INSULT and state == "somebody" else 1.0, 0.0


def negation(state, cls):
    """A negation halves what follows within ``REACH`` words."""
    if cls == END:
        return 0, 1.0, 0.0
    if cls == NOT:
        return REACH, 1.0, 0.0
    return max(0, state - 1), 0.5 if cls == INSULT and state else 1.0, 0.0


def reports(state, cls):
    """What a clause reports as said counts for half."""
    if cls == END:
        return "own", 1.0, 0.0
    if cls == REPORT:
        return "reported", 1.0, 0.0
    return state, 0.5 if cls == INSULT and state == "reported" else 1.0, 0.0


TRANSDUCERS = (("none", insults), ("none", threats), ("nobody", targets), (0, negation), ("own", reports))


def compose() -> list[list[tuple[int, float, float]]]:
    """The product of the transducers: for each state and class (next, factor, weight)."""
    first = tuple(start for start, _ in TRANSDUCERS)
    numbers, todo, rows = {first: 0}, [first], []
    while todo:
        states, row = todo.pop(0), []
        for cls in range(8):
            moves = [step(state, cls) for state, (_, step) in zip(states, TRANSDUCERS, strict=True)]
            after = tuple(m[0] for m in moves)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            row.append((numbers[after], math.prod(m[1] for m in moves), sum(m[2] for m in moves)))
        rows.append(row)
    return rows


class Grammar:
    """Scores the clauses of a text with a lexicon of words and stems (``stem*``)."""

    def __init__(self, lexicon: dict[str, float]):
        self.table = compose()
        self.lexicon = lexicon
        self.fixed = {word: cls for cls, line in CLASSES.items() for word in line.split()}
        self.known: dict[str, tuple[int, float]] = {}

    def classify(self, word: str) -> tuple[int, float]:
        if word in BREAKS:
            return END, 0.0
        plain = word.replace("’", "'")
        weight = max(
            (self.lexicon.get(f, 0.0) for f in itertools.chain([plain], (f"{plain[:n]}*" for n in STEMS if len(plain) >= n))),
            default=0.0,
        )
        if weight > 0:
            return INSULT, weight
        return self.fixed.get(plain, OTHER), 0.0

    def clauses(self, text: str | None) -> list[float]:
        """Weights of the clauses that match; null and empty texts have none."""
        known, tokens = self.known, TOKEN.findall((text or "").lower())
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(tokens):
            if word not in known:
                known[word] = self.classify(word)
        read = [known[t] for t in tokens]
        classes = np.fromiter((c for c, _ in read), np.int8, len(read))
        hits = np.flatnonzero((classes == INSULT) | (classes == VERB))
        if not len(hits):
            return []
        ends = np.concatenate([[-1], np.flatnonzero(classes == END), [len(read)]])
        found = []
        for which in np.unique(np.searchsorted(ends, hits)):
            state, total = 0, 0.0
            for cls, weight in read[ends[which - 1] + 1 : ends[which]]:
                state, factor, own = self.table[state][cls]
                total += factor * weight + own
            if total > 0:
                found.append(total)
        return found


def summary(weights: list[float]) -> tuple[float, float]:
    """What the score depends on: the strongest clause, and all of them."""
    return (math.log1p(max(weights)), math.log1p(sum(weights))) if weights else (0.0, 0.0)


def bucket(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


def learn_lexicon(sample: DataFrame, *, least: int, most: int) -> dict[str, float]:
    """Weights of words and stems that mark toxic texts.

    ``sample`` has text and toxic. A feature must follow at least ``least`` different words
    in toxic texts: words that merely stand in copies of one text do not. Its weight is the
    log of how much oftener toxic texts hold it; the ``most`` heaviest above 2 are kept.
    """

    @F.pandas_udf("array<string>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: list({f for w in set(TOKEN.findall((t or "").lower())) - BREAKS for f in word_features(w)})
        )

    @F.pandas_udf("array<string>")
    def places(texts: pd.Series) -> pd.Series:
        def of(text):
            tokens = TOKEN.findall((text or "").lower())
            pairs = {(f, before) for before, w in zip(["", *tokens], tokens, strict=False) if w not in BREAKS for f in word_features(w)}
            return [f"{f}\n{before}" for f, before in pairs]

        return texts.map(of)

    texts = sample.dropDuplicates(["text"])
    n_toxic, n_clean = texts.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))
    ).first()
    toxic = texts.where("toxic = 1")
    spread = (
        toxic.select(F.explode(places("text")).alias("place"))
        .distinct()
        .groupBy(F.substring_index("place", "\n", 1).alias("feature"))
        .agg(F.count("*").alias("contexts"))
        .where(F.col("contexts") >= least)
    )
    held = texts.select("toxic", F.explode(features("text")).alias("feature"))
    counts = held.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    weight = F.log((F.col("a") + 0.5) / (n_toxic + 1)) - F.log((F.col("b") + 0.5) / (n_clean + 1))
    best = (
        counts.join(spread, "feature")
        .where(F.col("a") >= least)
        .select("feature", weight.alias("weight"))
        .where("weight > 2")
        .orderBy(F.desc("weight"), "feature")
        .limit(most)
        .collect()
    )
    return dict.fromkeys(SEEDS.split(), SEED_WEIGHT) | {r.feature: float(r.weight) for r in best}


def fit_curve(points: np.ndarray, truth: np.ndarray) -> list[float]:
    """Intercept and slopes of a logistic curve, held near a plausible one where data are few."""
    prior = np.array([-3.0, 1.0, 1.0])
    x = np.column_stack([np.ones(len(points)), points]) if len(points) else np.zeros((0, 3))
    beta, penalty = prior.copy(), np.diag([0.05, 0.5, 0.5])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (truth - p) - penalty @ (beta - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return [float(b) for b in beta]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    training_rows: int = 20_000,
    lexicon_size: int = 5_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[dict[str, float], list[float]]:
    """Lexicon and curve, learned from labelled rows whose ``bucket`` is not 0.

    Of these at most ``training_rows`` are read, the first by a hash of their id; buckets
    1 to 3 teach the lexicon, bucket 4 the curve. Null labels do not count, of several
    labels of a document the largest does. Without labels the seeds and a fixed curve hold.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where(F.col("toxic").isNotNull() & (bucket(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("__doc"), "__doc")
        .limit(training_rows)
        .collect()  # training_rows ids at most
    )
    picked = F.broadcast(spark.createDataFrame(chosen, "__doc long, toxic int"))
    sample = materialize(
        docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
        .join(picked, "__doc")
        .select("text", "toxic", bucket(F.col("__doc")).alias("bucket")),
        "toxicity-sample",
    )
    teaching = sample.where("bucket <> 4")
    least = max(3, teaching.where("toxic = 1").count() // 100)
    lexicon = learn_lexicon(teaching, least=least, most=lexicon_size)

    @F.pandas_udf("struct<top:double,all:double>")
    def clause_points(texts: pd.Series) -> pd.DataFrame:
        grammar = Grammar(lexicon)
        return pd.DataFrame([summary(grammar.clauses(t)) for t in texts], columns=["top", "all"])

    rows = sample.where("bucket = 4").select(clause_points("text").alias("p"), "toxic").collect()
    points = np.array([(r.p.top, r.p["all"]) for r in rows]).reshape(-1, 2)
    return lexicon, fit_curve(points, np.array([r.toxic for r in rows], float))


def score(text: Column, lexicon: dict[str, float], curve: list[float]) -> Column:
    """A struct of ``score`` (0 to 1), ``clauses`` (that match) and ``top`` (the heaviest's weight)."""

    @F.pandas_udf("struct<score:double,clauses:long,top:double>")
    def of(texts: pd.Series) -> pd.DataFrame:
        grammar, rows = Grammar(lexicon), []
        for text in texts:
            found = grammar.clauses(text)
            high, total = summary(found)
            logit = curve[0] + curve[1] * high + curve[2] * total
            rows.append((1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))), len(found), max(found, default=0.0)))
        return pd.DataFrame(rows, columns=["score", "clauses", "top"])

    return of(text)
