"""Plain versions of what the operators compute, one row at a time."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = "".join(map(chr, [32, *range(9, 14)]))
LOWER = {u: u + 32 for u in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def line_dedup(docs):
    """{id: (lines, dropped, kept text)} for (id, text)."""

    def key(line):
        return line.strip(SPACES).translate(LOWER)

    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingles(text, size):
    found = (text or "").translate(LOWER)
    found = words(found)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def near_groups(docs, size, percent=80):
    """{id: least id reached} over links of all pairs."""
    sets = [(doc, shingles(text, size)) for doc, text in docs]
    top = {doc: doc for doc, _ in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                top[high] = low
    return {doc: root(doc) for doc in top}


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            twice += line in seen
            seen.add(line)
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        twice,
        len(covered),
    )


BASE = (
    ("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]+", 24, 0),
)


def base_spans(text):
    """(start, kind number, end) of the base patterns, in order."""
    found = []
    for number, (_, pattern, least, group) in enumerate(BASE):
        found += [(m.start(), number, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return sorted(found)


def pieces(text, encode, capacity=4096):
    """(piece, start, length, crc) of a text's ids and the end id."""
    ids = (encode(text) if text else []) + [1]
    out = []
    for number, start in enumerate(range(0, len(ids), capacity)):
        part = ids[start : start + capacity]
        out.append((number, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
