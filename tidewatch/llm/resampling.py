"""Importance resampling towards a target: hashed words and word runs by an Aho-Corasick dictionary.

The corpus' most frequent words, each between two delimiters, form the dictionary; a word
carries its CRC-32 and its length in bytes. Scanning a text emits the payloads of its words
in order. The CRC of a run of words follows from those of its words and their lengths alone,
since appending bytes shifts a CRC by a linear map, so runs are never spelled out. CRCs give
buckets, whose counts in corpus and target give gains, whose sums weigh documents.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.positions import with_positions
from tidewatch.session import materialize, release

#: Words of the dictionary, and bytes of the longest: what bounds the broadcast. Payloads of
#: the words beyond are computed where they stand, to the same effect.
DICTIONARY_WORDS, LONGEST_WORD = 60_000, 48

#: Bytes as words see them: A-Z in lower case, delimiters as 0, all others as they are.
VIEW = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0 for b in range(256)
)

POLYNOMIAL = 0xEDB88320


def _tables(images: np.ndarray) -> np.ndarray:
    """Four tables of 256 for a linear map of 32 bits, from the images of the bits."""
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            out[byte, np.arange(256) >> bit & 1 == 1] ^= images[8 * byte + bit]
    return out


def _apply(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    part = lambda n: tables[n][crcs >> np.uint32(8 * n) & np.uint32(255)]
    return part(0) ^ part(1) ^ part(2) ^ part(3)


def _shifts() -> list[np.ndarray]:
    """Tables of the maps that append 1, 2, 4, 8, ... zero bytes to a CRC's bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    one = bits.copy()
    for _ in range(8):
        one = np.where(one & np.uint32(1), one >> np.uint32(1) ^ np.uint32(POLYNOMIAL), one >> np.uint32(1))
    out = [_tables(one)]
    for _ in range(31):
        out.append(_tables(_apply(out[-1], _apply(out[-1], bits))))
    return out


class Composer:
    """CRCs of words followed by words."""

    def __init__(self):
        self._shifts = _shifts()
        self._blank = np.uint32(zlib.crc32(b" "))

    def join(self, left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRCs of left's bytes followed by right's, which are ``length`` many."""
        out = left.copy()
        for bit in range(int(length.max(initial=0)).bit_length()):
            chosen = length >> bit & 1 == 1
            out[chosen] = _apply(self._shifts[bit], out[chosen])
        return out ^ right

    def runs(self, crcs: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
        """CRCs of all runs of 1 to ``most`` adjacent words, joined by one space."""
        out = [crcs]
        for size in range(2, min(most, len(crcs)) + 1):
            spaced = self.join(out[-1][:-1], np.full(len(out[-1]) - 1, self._blank), np.ones(len(out[-1]) - 1, np.int64))
            out.append(self.join(spaced, crcs[size - 1 :], lengths[size - 1 :]))
        return np.concatenate(out)


class Scanner:
    """Payloads of a text's words, by an automaton over the dictionary's."""

    def __init__(self, dictionary: list[bytes]):
        self._crcs = np.array([zlib.crc32(w) for w in dictionary], np.uint32)
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, word in enumerate(dictionary):
            self._automaton.add_word(f"\0{word.decode('latin-1')}\0", number)
        self._automaton.make_automaton()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """CRCs and lengths of all words, in order."""
        seen = b"\0" + text.encode().translate(VIEW) + b"\0" if text else b"\0"
        held = np.frombuffer(seen, np.uint8) != 0
        edges = np.flatnonzero(held[1:] != held[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        crcs = np.zeros(len(starts), np.uint32)
        found = np.zeros(len(starts), bool)
        if len(self._crcs) and len(starts):
            hits = list(self._automaton.iter(seen.decode("latin-1")))
            if hits:
                at, number = np.array(hits, np.int64).T
                nth = np.searchsorted(ends, at)
                crcs[nth], found[nth] = self._crcs[number], True
        for nth in np.flatnonzero(~found):
            crcs[nth] = zlib.crc32(seen[starts[nth] : ends[nth]])
        return crcs, ends - starts


def frequent_words(docs: DataFrame, text_col: str, most: int = DICTIONARY_WORDS) -> list[bytes]:
    """Most frequent words of all texts, at most ``most``, none longer than ``LONGEST_WORD`` bytes.

    Words are counted in each batch and then over all. A histogram of eighths of the counts'
    logarithm gives the least class of counts whose words still fit with those above; so only
    words that are kept reach the driver, less than 3 MB.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = Counter()
            for text in frame["text"]:
                if text:
                    seen.update(text.encode().translate(VIEW).replace(b"\0", b" ").split(b" "))
            seen.pop(b"", None)
            rows = [(w, n) for w, n in seen.items() if len(w) <= LONGEST_WORD]
            yield pd.DataFrame(rows, columns=["word", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "word binary, n long")
    summed = materialize(
        counted.groupBy("word").agg(F.sum("n").alias("n")).select("word", F.floor(8 * F.log2("n")).alias("class")), "word-counts"
    )
    left, least = most, None
    for row in sorted(summed.groupBy("class").count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        least = row["class"]
    kept = [] if least is None else [bytes(r.word) for r in summed.where(F.col("class") >= least).select("word").collect()]
    release(summed)
    return sorted(kept)


def hashed(docs: DataFrame, keep: dict, dictionary: list[bytes], *, text_col: str, most_words: int, buckets: int) -> DataFrame:
    """The columns of ``keep`` with n_words and the buckets of all features of each text, repeats counted."""
    packed = docs.sparkSession.sparkContext.broadcast(dictionary)  # bounded, see DICTIONARY_WORDS

    @F.pandas_udf("struct<n_words:long,buckets:array<int>>")
    def scan(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner, composer = Scanner(packed.value), Composer()
        for texts in series:
            rows = []
            for text in texts:
                crcs, lengths = scanner(text)
                rows.append((len(crcs), (composer.runs(crcs, lengths, most_words) % buckets).astype(np.int32)))
            yield pd.DataFrame(rows, columns=["n_words", "buckets"])

    return docs.select(*[c.alias(n) for n, c in keep.items()], scan(F.col(text_col)).alias("s")).select(*keep, "s.*")


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus share, rounded down, for every bucket.

    One is added to each count. The driver gets a row per bucket.
    """

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))

    both = counted(corpus, "s").join(counted(target, "t"), "bucket", "full").na.fill(0).collect()
    counts = np.zeros((2, buckets), np.int64)
    for row in both:
        counts[:, row.bucket] = row.s, row.t
    whole, aim = counts.sum(axis=1).tolist()
    share = (counts[1] + 1.0) * float(whole + buckets) / ((counts[0] + 1.0) * float(aim + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    most_words: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    dictionary_words: int = DICTIONARY_WORDS,
) -> DataFrame:
    """Rows (doc, n_words, n_features, weight, score, rank), one per row of ``docs``.

    A document's weight is the sum of the gains of its features: all runs of 1 to
    ``most_words`` words. Its score adds Gumbel noise from a hash of ``seed`` and id, so that
    the highest scores are a draw without replacement by weight. Of the documents with
    ``least_words`` words or more ``percent`` in a hundred are drawn and ranked from 1, ties
    to the smaller id; all others have a null rank.

    Null and empty texts have no features and weigh 0. Null ids hash as the empty string and
    come last in ties; rows that share an id are drawn apart from each other. An empty target
    gives every document gains from its own counts alone; an empty table gives no rows. Other
    columns are not read. Long texts are scanned whole, one at a time.
    """
    dictionary = frequent_words(docs, text_col, dictionary_words)
    how = {"most_words": most_words, "buckets": buckets}
    rows = materialize(hashed(docs, {"doc": F.col(id_col)}, dictionary, text_col=text_col, **how), "resample-buckets")
    aims = hashed(target, {}, dictionary, text_col=target_text_col, **how)
    gains = bucket_gains(rows, aims, buckets)

    @F.pandas_udf("long")
    def weigh(found: pd.Series) -> pd.Series:
        return found.map(lambda b: int(gains[b].sum())).astype("int64")

    decimal = F.coalesce(F.col("doc").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), decimal), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = rows.select(
        "doc", "n_words", F.size("buckets").cast("long").alias("n_features"), weigh("buckets").alias("weight")
    ).withColumn("score", F.col("weight") + noise)
    apt = F.col("n_words") >= least_words
    order = [apt.desc(), F.desc("score"), F.asc_nulls_last("doc"), F.asc("n_features"), F.asc("weight")]
    placed = with_positions(scored, order, name="resample-order")
    drawn = placed.where(apt).count() * percent // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    return placed.select("doc", "n_words", "n_features", "weight", "score", rank.alias("rank"))
