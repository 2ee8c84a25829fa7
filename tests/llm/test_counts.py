"""Token counts against the tokenizer, resampling against plain hashing."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import resampling, tokens
from tidewatch.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LAYOUT = "doc_id long, text string, n_tokens string, `a.b` string, key int, weight int"
ODD = "ab 'sT3. \n\té漢。\u1e9e\u00a0\u200b\x1c<|endoftext|>  !?😀"


def texts():
    rng = random.Random(9)
    prose = " ".join("".join(rng.choice("etaoinß") for _ in range(rng.randint(1, 9))) for _ in range(8000))
    return [
        None, "", " ", "word", "it's <|endoftext|> here", "".join(rng.choice(ODD) for _ in range(3000)), prose, prose,
        "x" * 40_000, " " * 30_000 + "end", "漢字" * 12_000, prose[:20_000] + "z" * 9_000 + prose[:20_000],
        "ab<|endoftext|>" * 3000, ("é" * 700 + ". ") * 60, "".join(rng.choice(ODD) for _ in range(60_000)),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(n, t, "x", "y", 1, 2) for n, t in rows], LAYOUT).repartition(3)


def test_counts_are_the_tokenizers(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = [*enumerate(texts()), (None, "null id"), (3, "word")]
    got = sorted(map(tuple, tokens.count_tokens(frame(spark, rows), TOKENIZER).collect()), key=repr)
    want = [(n, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for n, t in rows]
    assert got == sorted(want, key=repr)


def test_overlaps_widen_until_chunks_meet(spark, monkeypatch):
    """With cuts that don't look at the text, splices fail and are tried again."""
    monkeypatch.setattr(tokens, "first_cuts", lambda text, _: [(at, 256) for at in range(8192, len(text), 8192)])
    tries, widen = [], tokens.wider
    monkeypatch.setattr(tokens, "wider", lambda spliced: tries.append(1) or widen(spliced))
    test_counts_are_the_tokenizers(spark)
    assert len(tries) == 5


def test_given_documents(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    folder = "/root/testdata/sf0.01"
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op13_token_counts"](spark, folder).collect()
    assert len(got) == len(given) and max(len(t) for t in given.values()) > tokens.HUGE
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len(given[r.doc_id].encode()), len(tokenizer.encode(given[r.doc_id]).ids))
        assert r.over_limit == (r.n_tokens > 1024)


def test_no_documents(spark):
    none = spark.createDataFrame([], LAYOUT)
    assert tokens.count_tokens(none, TOKENIZER).count() == 0
    assert resampling.resample(none, none).count() == 0


def test_stable_boundaries_split_any_text():
    tokenizer, special = tokens.byte_level(TOKENIZER)
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    stable, rng, seen = tokens.Boundaries(special), random.Random(4), 0
    for _ in range(400):
        text = "".join(rng.choice(ODD) for _ in range(40)) + rng.choice(["", "<|endoftext|>"]) + rng.choice(["s a", "'s 1", ""])
        for at in stable(text, 0, len(text)):
            seen += 1
            assert count(text) == count(text[:at]) + count(text[at:])
    assert seen > 1000


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.byte_level(public_tokenizers.path("word_bpe_49k.json"))


def plain_resample(docs, target, most_words=1, buckets=10_000, percent=10, least=20):
    def features(text):
        found = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
        runs = [b" ".join(found[i : i + m]) for m in range(1, most_words + 1) for i in range(len(found) - m + 1)]
        return len(found), [zlib.crc32(r) % buckets for r in runs]

    held = [(n, *features(t)) for n, t in docs]
    s = Counter(b for _, _, bs in held for b in bs)
    t = Counter(b for x in target for b in features(x)[1])
    whole, aim = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * whole / ((s[b] + 1.0) * aim))) for b in s}
    out = []
    for n, words, bs in held:
        h = int(hashlib.sha256(f"2024:{'' if n is None else n}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        out.append([n, words, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    apt = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(apt[: len(apt) * percent // 100]):
        row[5] = place + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("most_words, dictionary", [(1, 60_000), (3, 5), (2, 0)])
def test_resampling(spark, most_words, dictionary):
    rng = random.Random(6)
    letters = ["the", "The", "été", "x1", "ß", "漢字", "a" * 70, "zeta", "other-words", "e\x00f"]
    prose = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    rows = [(n, prose(rng.randint(0, 60))) for n in range(150)]
    rows += [(200, None), (201, ""), (202, "., ,."), (203, prose(30_000)), (None, prose(40))]
    target = [prose(20) for _ in range(5)] + [None, "zeta zeta"]
    found = resampling.resample(
        frame(spark, rows), frame(spark, list(enumerate(target))), most_words=most_words, dictionary_words=dictionary
    )
    assert sorted(map(tuple, found.collect()), key=repr) == plain_resample(rows, target, most_words)


def test_repeated_rows_and_ties(spark):
    rows = [(7, "one two three " * 10)] * 30 + [(n, "one two three " * 10) for n in range(40)]
    got = resampling.resample(frame(spark, rows), frame(spark, [(1, "two")])).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 8)) and len(got) == 70
    best = sorted((r for r in got), key=lambda r: (-r.score, r.doc))
    assert [r.doc for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == [r.doc for r in best[:7]]


def test_empty_target(spark):
    rows = [(n, f"w{n} common") for n in range(30)]
    got = resampling.resample(frame(spark, rows), frame(spark, []), least_words=1).collect()
    assert sorted(map(tuple, got), key=repr) == plain_resample(rows, [], least=1)
