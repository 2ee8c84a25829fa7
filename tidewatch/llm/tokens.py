"""Token counts: huge documents are encoded in overlapping chunks and spliced where both agree.

Texts of up to ``HUGE`` characters are counted whole. Longer ones are cut every ``CHUNK``
characters; a chunk reaches over its end by an overlap, and the chunks of a document are
encoded in different tasks, with offsets. Two neighbours are spliced at a stable boundary in
their overlap: a place where every tokenization of every text around it ends a token, seen
from the two characters beside it alone, and where both encodings do end one. If an overlap
holds none, it is doubled; if it would reach the next cut, the cut goes. That is seen from the
text when it is cut; should two encodings still not meet, the document is encoded anew with
wider overlaps.

A place between two characters is stable if they are of different kinds (letter, digit, sign,
white space), the first is not white space, the pair is not an apostrophe and a letter, and
no special string of the tokenizer holds the pair. The byte-level pattern has no piece with
such a pair inside; pieces before it don't look beyond it, pieces behind it don't look back.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.packing import _byte_letters
from tidewatch.session import materialize, release

#: Characters that a text may have to be encoded whole, and of a chunk and the first overlap of longer ones.
HUGE, CHUNK, OVERLAP = 16384, 8192, 256

#: Stable boundaries of an overlap that are compared.
COMPARED = 16

#: Pieces whose counts a worker remembers before it starts afresh.
KNOWN_PIECES = 400_000

#: Characters whose kinds all versions of Unicode since 3.2 agree on. Fixed values.
LETTERS = "A-Za-zÀ-ÖØ-öø-ȟΑ-ΡΣ-Ωα-ωЀ-ҁぁ-ゔ一-龥가-힣"
DIGITS = "0-9"
SIGNS = r"!-/:-@\[-`{-~、。！，？"
BLANKS = r"\t\n\r\x20"

CUTS = "array<struct<at:int,overlap:int>>"
PIECES = "array<struct<number:int,last:boolean,at:int,overlap:int,right:int,right_overlap:int,piece:string>>"
ENCODED = "struct<total:long,left:array<struct<at:int,before:long>>,right:array<struct<at:int,before:long>>>"


def byte_level(path: str) -> tuple[Tokenizer, list[str]]:
    """The tokenizer and its special strings; an error if the rules above don't hold for it."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    split = parts["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    stripped = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    if not plain or stripped or parts["normalizer"] or parts["model"]["type"] != "BPE":
        raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [t["content"] for t in parts["added_tokens"]]


class TokenCount(dict):
    """How many tokens a text has, summed over the pattern's pieces, which are counted once.

    Texts with a special string or characters outside the classes above are left to the
    tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self._tokenizer, self._special = byte_level(path)
        self._model = self._tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._pieces = regex.compile(public_tokenizers.PATTERN).findall
        self._odd = regex.compile(f"[^{LETTERS}{DIGITS}{SIGNS}{BLANKS}]").search

    def __missing__(self, piece: str) -> int:
        count = len(self._model("".join([self._letters[b] for b in piece.encode()])))
        if len(piece) <= 64:
            if len(self) >= KNOWN_PIECES:
                self.clear()
            self[piece] = count
        return count

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self._odd(text) or any(s in text for s in self._special):
            return len(self._tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, self._pieces(text)))


class Boundaries:
    """Stable boundaries of a text."""

    def __init__(self, special: list[str]):
        kinds = {"letter": LETTERS, "digit": DIGITS, "sign": SIGNS}
        after = {k: "".join(v for n, v in (kinds | {"blank": BLANKS}).items() if n != k) for k in kinds}
        self._change = regex.compile("|".join(f"(?<=[{kinds[k]}])(?=[{after[k]}])" for k in kinds))
        self._inside = {s[i : i + 2] for s in special for i in range(len(s) - 1)}

    def __call__(self, text: str, low: int, high: int) -> list[int]:
        """The first ``COMPARED`` of them from ``low`` on, before ``high``."""
        found = []
        for match in self._change.finditer(text, max(low, 1), min(high, len(text))):
            at = match.start()
            pair = text[at - 1 : at + 1]
            if len(pair) < 2 or pair in self._inside or (pair[0] == "'" and pair[1].isalpha()):
                continue
            found.append(at)
            if len(found) == COMPARED:
                break
        return found


def first_cuts(text: str, stable: Boundaries) -> list[tuple[int, int]]:
    """Cuts every ``CHUNK`` characters, each with the least overlap that holds a stable boundary."""
    cuts = []
    for at in range(CHUNK, len(text), CHUNK):
        overlap = OVERLAP
        while overlap < CHUNK and not stable(text, at + 1, at + overlap):
            overlap *= 2
        if overlap < CHUNK:
            cuts.append((at, overlap))
    return cuts


def cut_text(text: str, cuts: list[tuple[int, int]]) -> list[tuple]:
    """Overlapping chunks: number, whether it is the last, its cut and overlap, the next ones, and its text."""
    starts = [(0, 0), *cuts]
    ends = [*cuts, (len(text), 0)]
    return [
        (n, n == len(cuts), start, overlap, end, reach, text[start : end + reach])
        for n, ((start, overlap), (end, reach)) in enumerate(zip(starts, ends, strict=True))
    ]


def encode_chunk(tokenizer: Tokenizer, stable: Boundaries, row) -> tuple:
    """Tokens of a chunk, and those before each stable boundary of its two overlaps."""
    offsets = tokenizer.encode(row.piece, add_special_tokens=False).offsets
    starts = [o[0] for o in offsets]

    def ended(low: int, high: int) -> list[tuple[int, int]]:
        out = []
        for at in stable(row.piece, low, high):
            before = bisect_left(starts, at)
            if before < len(starts) and starts[before] == at and (not before or offsets[before - 1][1] == at):
                out.append((row.at + at, before))
        return out

    left = ended(0, row.overlap) if row.at else []
    right = [] if row.last else ended(row.right - row.at, row.right - row.at + row.right_overlap)
    return len(offsets), left, right


def encode_chunks(texts: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (key, number, last, at, overlap, total, left, right) for rows (key, text, cuts).

    ``cuts`` are places and overlaps; null leaves them to :func:`first_cuts`.
    """

    _, special = byte_level(tokenizer)

    @F.pandas_udf(PIECES)
    def pieces(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        stable = Boundaries(special)
        return pd.Series(
            [
                cut_text(t, first_cuts(t, stable) if c is None else [(x["at"], x["overlap"]) for x in c])
                for t, c in zip(texts, cuts, strict=True)
            ]
        )

    @F.pandas_udf(ENCODED)
    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, special = byte_level(tokenizer)
        stable = Boundaries(special)
        for frame in frames:
            yield pd.DataFrame(
                [encode_chunk(encoder, stable, row) for row in frame.itertuples(index=False)],
                columns=["total", "left", "right"],
            )

    chunks = texts.select("key", F.explode(pieces("text", "cuts")).alias("c")).select("key", "c.*")
    dealt = chunks.repartition("key", "number")
    fields = F.struct("last", "at", "overlap", "right", "right_overlap", "piece")
    return dealt.select("key", "number", "last", "at", "overlap", encoded(fields).alias("e")).select(
        "key", "number", "last", "at", "overlap", "e.*"
    ).distinct()


def splices(chunks: DataFrame) -> DataFrame:
    """Rows (key, number, at, overlap, tokens) for every chunk: the tokens it adds to those before it.

    A chunk adds its own behind the splice, and takes away what its predecessor has behind
    it. Null where the overlap has no boundary that both have.
    """
    before = chunks.select("key", (F.col("number") + 1).alias("number"), F.col("total").alias("former"), F.col("right").alias("r"))
    places = lambda c: F.transform(c, lambda x: x["at"])
    common = F.array_min(F.array_intersect(places("left"), places("r")))
    count = lambda c: F.get(F.filter(c, lambda x: x["at"] == F.col("place")), F.lit(0))["before"]
    met = chunks.join(before, ["key", "number"], "left").withColumn("place", common)
    added = F.col("total") - count("left") - (F.col("former") - count("r"))
    tokens = F.when(F.col("number") == 0, F.col("total")).otherwise(added)
    return met.select("key", "number", "at", "overlap", tokens.alias("tokens"))


def wider(spliced: DataFrame) -> DataFrame:
    """New cuts (key, cuts) for the documents in which a splice failed.

    Failed overlaps are doubled; a cut whose overlap would be as long as a chunk goes. The
    other cuts stay, so that a document has no more of them than before.
    """
    open_ = spliced.where("tokens IS NULL").select("key").distinct()
    failed = F.col("tokens").isNull()
    stays = (F.col("number") > 0) & ~(failed & (2 * F.col("overlap") >= CHUNK))
    cut = F.when(stays, F.struct("at", F.when(failed, 2 * F.col("overlap")).otherwise(F.col("overlap")).alias("overlap")))
    return spliced.join(open_, "key", "left_semi").groupBy("key").agg(
        F.sort_array(F.collect_list(cut)).cast(CUTS).alias("cuts")
    )


def count_huge(texts: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (key, tokens) for distinct texts (key, text) that may be too long for one task.

    Documents in which a splice fails are encoded anew with wider overlaps, until none
    fails: at most ``log2(CHUNK / OVERLAP)`` times. Rows of one key must have one text. No
    rows give no rows.
    """
    found, todo = None, texts.withColumn("cuts", F.lit(None).cast(CUTS))
    while True:
        chunks = materialize(encode_chunks(todo, tokenizer), "token-chunks")
        spliced = materialize(splices(chunks), "token-splices")
        release(chunks)
        counts = spliced.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count_if(F.isnull("tokens")).alias("open"))
        done = counts.where("open = 0").select("key", "tokens")
        found = done if found is None else found.unionByName(done)
        if not spliced.where("tokens IS NULL").limit(1).count():
            return found
        former, todo = todo, materialize(todo.drop("cuts").join(wider(spliced), "key"), "token-texts")
        if hasattr(former, "written_to"):
            release(former)


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc, n_bytes, n_tokens), one per row of ``docs``.

    ``tokenizer`` is the file of a byte-level BPE tokenizer. Special strings in a text are
    one token each, nothing is added or cut off. Null and empty texts have no tokens. Very
    long texts are spread over tasks by chunks; only a run without any stable boundary must
    fit a task. Ids are passed through, null ones and repeated ones too; equal huge texts
    are one key. Other columns are not read; an empty table gives no rows.
    """

    @F.pandas_udf("long")
    def whole(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = TokenCount(tokenizer)
        for texts in series:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    text = F.col(text_col)
    huge = F.coalesce(F.char_length(text) > HUGE, F.lit(False))
    long_ = docs.where(huge).select(F.sha2(text, 256).alias("key"), text.alias("text"))
    rows = docs.select(
        F.col(id_col).alias("doc"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.when(huge, F.sha2(text, 256)).alias("key"),
        whole(F.when(~huge, text)).alias("short"),
    )
    return rows.join(count_huge(long_, tokenizer), "key", "left").select(
        "doc", "n_bytes", F.coalesce("tokens", "short").alias("n_tokens")
    )
