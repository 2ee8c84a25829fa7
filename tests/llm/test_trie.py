"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import trie

LAYOUT = "conv_id long, turn long, role string, text string, depth string, `a.b` string, first int"


def plain_sequences(rows, family=5, heads=9):
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", md5(text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % heads
        base = conv - (abs(conv) % family) * (1 if conv >= 0 else -1)
        out[conv] = own.get(base, [])[:h] + own[conv][h:]
    return out


def plain_trie(sequences):
    members, ends = {}, {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        saved[node] = own + sum(saved[k] for k in below)
    written = lambda node: ",".join(map(str, sorted(ends.get(node, [])))).encode()
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])), leaves[node],
            saved[node], hashlib.sha256(written(node)).hexdigest(),
        )
        for node, m in members.items()
    )


def made(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], LAYOUT)
    return sorted(map(tuple, trie.prefix_trie(trie.rebuild(frame)).collect()), key=lambda r: r[:2])


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*range(-7, 30), 10**12]:
        if conv % 11 == 4:
            continue  # absent bases
        for turn in range(rng.randint(1, 12)):
            turn = None if rng.random() < 0.1 else turn - rng.randint(0, 1)
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "ho", "", None, "été 😀"])))
    rows += rows[:25] + [(None, 1, "user", "lost")] + [(40, t, "user", "x" * 60_000) for t in range(3)]
    assert made(spark, rows) == plain_trie(plain_sequences(rows))


def test_hot_conversation_and_copies_in_small_parts(spark, monkeypatch):
    """A conversation with a third of all turns, a third of equal ones, and chains over many parts."""
    monkeypatch.setattr(trie, "PART", 16)
    rows = [(500, t, "user", f"t{t}") for t in range(300)]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1100) for t in range(3)]
    rows += [(c, t, "user", f"{t * c % 3}") for c in range(60) for t in range(5)]
    assert made(spark, rows) == plain_trie(plain_sequences(rows))


def test_nothing(spark):
    assert made(spark, []) == []


@pytest.mark.parametrize("count", [1, 2, 17, 1000])
def test_list_ranks(spark, monkeypatch, count):
    monkeypatch.setattr(trie, "PART", 32)
    order = list(range(count))
    random.Random(count).shuffle(order)
    follows = dict(zip(order, [*order[1:], -1]))
    arcs = spark.createDataFrame(list(follows.items()), "arc long, next long")
    got = {r.arc: r.place for r in trie.rank_list(arcs, count).collect()}
    assert [a for a, _ in sorted(got.items(), key=lambda x: x[1])] == order
    placed = spark.createDataFrame([(p, p + 1) for p in got.values()], "place long, v long")
    sums = trie.running_sums(placed, "place", ["v"], count).agg(F.sum(F.abs(F.col("v") - F.expr("(place + 1) * (place + 2) div 2")))).first()
    assert sums[0] == 0
