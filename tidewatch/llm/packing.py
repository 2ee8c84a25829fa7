"""Best-fit packing planned on the histogram of lengths.

A plan is made over counts: there are at most ``capacity`` different lengths, so the
plan stays small however many documents there are. Each document then finds its slot
by its rank among the pieces of its length.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.session import materialize

#: Ranks are counted in this many parts of each length, so that a length which a third
#: of all pieces share is still dealt over many tasks.
RANK_PARTS = 1024

#: Words whose ids a worker remembers; once there are as many, it forgets those that the next batch of texts lacks.
KNOWN_WORDS = 250_000

#: Bytes of texts whose words are looked up together, beside one that is longer.
BATCH_BYTES = 1 << 23

PLAN = "length int, first long, last long, sequence long, each long, offset long"


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one above 255."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printing]
    return [chr(b if b in printing else 256 + others.index(b)) for b in range(256)]


class WordIds:
    """Ids of texts as little-endian 32-bit numbers, word by word.

    For tokenizers that drop white space, split words into runs of letters and of other
    signs, and write bytes as letters; then a text has the ids of its words. Arrow splits the
    texts of a batch and numbers their words, so that Python sees each different word once;
    its ids are then dealt to all its places. Signs at the end of a word are split off first:
    there are far fewer words without them. Runs of letters go to the vocabulary's model;
    everything else is left to the tokenizer itself.
    """

    TAIL = ".,!?;:*&%$#"

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self._encode = tokenizer.encode
        self._normal = tokenizer.normalizer.normalize_str
        self._model = tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._known: dict[str, bytes] = {}

    def _keep(self, key: str, packed: bytes) -> bytes:
        if len(key) <= 64 and len(self._known) < KNOWN_WORDS:
            self._known[key] = packed
        return packed

    def _whole(self, part: str) -> bytes:
        ids = self._encode(part, add_special_tokens=False).ids
        return self._keep(part, struct.pack(f"<{len(ids)}I", *ids))

    def _normalized(self, heads: list[str]) -> list[str]:
        """Heads as the tokenizer normalizes them; those of letters alone many in a call, kept apart by blanks."""
        odd = {h for h in heads if not h.isascii()}
        found = {h: self._normal(h) for h in odd if not h.isalpha()}
        joint = [h for h in odd if h not in found]
        for at in range(0, len(joint), 256):
            part = joint[at : at + 256]
            found.update(zip(part, self._normal(" ".join(part)).split(" "), strict=True))
        return [h.lower() if h.isascii() else found[h] for h in heads]

    def _learn(self, word: str, head: str, run: str) -> bytes:
        """Ids of a word that is not known; it and its parts are, from now on."""
        if not run.isalpha():  # other signs inside, or nothing else
            return self._whole(word)
        packed = self._known.get(run)
        if packed is None:
            letters = run if run.isascii() else "".join([self._letters[b] for b in run.encode()])
            ids = [t.id for t in self._model(letters)]
            packed = self._keep(run, struct.pack(f"<{len(ids)}I", *ids))
        if len(head) < len(word):
            tail = word[len(head) :]
            packed += self._known.get(tail) or self._whole(tail)
        return packed if word == run else self._keep(word, packed)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of different words. If not all can be remembered, the first are: they tend to be the frequent ones."""
        known = self._known
        if len(known) >= KNOWN_WORDS:
            self._known = known = {w: known[w] for w in words if w in known}
        new = [w for w in words if w not in known]
        heads = [w.rstrip(self.TAIL) for w in new]
        learned = dict(zip(new, map(self._learn, new, heads, self._normalized(heads)), strict=True))
        return [learned[w] if w in learned else known[w] for w in words]

    def _batch(self, texts: pa.Array) -> pa.Array:
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        starts, words = split.offsets, split.values.dictionary_encode()
        del split  # as large as the texts
        learned = self._words(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        dealt = pa.array(learned, pa.large_binary()).take(words.indices)
        return pc.binary_join(pa.ListArray.from_arrays(starts, dealt), pa.scalar(b"", pa.large_binary()))

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, none for null ones."""
        behind = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype="int64")
        cuts = np.flatnonzero(np.diff(behind // BATCH_BYTES)) + 1
        for start, end in pairwise([0, *cuts.tolist(), len(texts)]):
            for ids in self._batch(texts.slice(start, end - start)):
                yield ids.as_py()

    def __call__(self, text: str) -> bytes:
        return next(self.many(pa.array([text], pa.string())))


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32.

    A document's ids are those of its text and then ``end_id``. Longer ones than
    ``capacity`` are cut into pieces of that length; the last may be shorter. Null and
    empty texts have ``end_id`` alone. A null id stays null, repeated rows are pieces of
    their own, other columns are not read.
    """
    size = 4 * capacity
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    numbers = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "ids_crc32": pa.int64()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(tokenizer)
        tail = end_id.to_bytes(4, "little")
        for batch in batches:
            places, rows = [], []
            for place, ids in enumerate(ids_of.many(batch["text"])):
                data = ids + tail
                for number, at in enumerate(range(0, len(data), size)):
                    part = data[at : at + size]
                    places.append(place)
                    rows.append((number, at // 4, len(part) // 4, zlib.crc32(part)))
            owners = batch["doc_id"].take(pa.array(places, pa.int64()))
            columns = zip(zip(*rows, strict=True) if rows else [()] * len(numbers), numbers.values(), strict=True)
            yield pa.RecordBatch.from_arrays([owners, *(pa.array(c, t) for c, t in columns)], ["doc_id", *numbers])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length int, ids_crc32 long")


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths.

    Returns runs (length, first, last, sequence, each, offset): the pieces of that length
    ranked first to last go to sequences from ``sequence`` on, ``each`` to a sequence,
    one behind the other from ``offset``. A bin takes the fullest place that fits; as a
    bin only gets fuller by taking a piece, it is the best place for the next one of that
    length too, so whole groups of equally full bins are served at once.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # groups (first bin, bins) by space left
    runs = []
    bins = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def serve(space: int, start: int, size: int) -> int:
            """Fill a group of bins; returns how many of them were not needed."""
            nonlocal rank, left
            each = space // length
            full = min(size, left // each)
            rest = min(left - full * each, each) if full < size else 0
            for begin, many, take in ((start, full, each), (start + full, 1 if rest else 0, rest)):
                if many:
                    runs.append((length, rank, rank + many * take - 1, begin, take, capacity - space))
                    room[space - take * length].append((begin, many))
                    rank, left = rank + many * take, left - many * take
            return size - full - (1 if rest else 0)

        for space in range(length, capacity + 1):
            groups, room[space] = room[space], []
            for start, size in groups:
                spare = serve(space, start, size) if left else size
                if spare:
                    room[space].append((start + size - spare, spare))
            if not left:
                break
        if left:
            each = capacity // length
            fresh = -(-left // each)
            serve(capacity, bins, fresh)
            bins += fresh
    return runs


def ranked(pieces: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank``, from 0, among the pieces of the same length.

    Each length is dealt into parts by a hash; a part's first rank comes from the counts
    of the parts before it.
    """
    parted = pieces.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(RANK_PARTS)))
    sizes = parted.groupBy("length", "part").agg(F.count("*").alias("many"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy(*order)
    numbered = parted.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place")).drop(
        "base", "place", "part"
    )


def pack(pieces: DataFrame, *, capacity: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with doc_id, piece, start, length, ids_crc32.

    What goes through the driver is one count per length, ``capacity`` of them at most;
    the plan has a few runs per length and is broadcast. No pieces give no rows. Equal
    rows get different slots. Lengths are 1 to ``capacity``.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    counts = {r.length: r.many for r in pieces.groupBy("length").agg(F.count("*").alias("many")).collect()}
    plan = spark.createDataFrame(plan_slots(counts, capacity), PLAN)
    placed = ranked(pieces, ["doc_id", "piece", "start", "ids_crc32"])
    slot = F.col("rank") - F.col("first")
    return (
        placed.alias("p")
        .join(
            F.broadcast(plan).alias("s"),
            (F.col("p.length") == F.col("s.length")) & F.col("rank").between(F.col("first"), F.col("last")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            F.col("p.length").cast("long").alias("length"),
            "ids_crc32",
            (F.col("sequence") + F.floor(slot / F.col("each"))).alias("sequence_id"),
            (F.col("s.offset") + F.pmod(slot, F.col("each")) * F.col("p.length")).alias("offset"),
        )
    )
