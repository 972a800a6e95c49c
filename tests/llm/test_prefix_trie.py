"""The trie against a plain version, with small pieces, slices and chunks too."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from saleswh.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int, total int"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    for c in convs:
        convs[c].sort(key=lambda t: t[:3])
    seqs = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(t[3:] for t in convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(p))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in T.prefix_trie(T.rebuilt(df)).collect()), key=str)
    assert got == plain(rows)
    return got


def conversations(rng, n, turns, texts):
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(texts)) for c in range(n) for t in range(rng.randrange(turns))]


@pytest.fixture
def small(monkeypatch):
    for name, value in {"WIDTH": 2, "SLICE": 8, "CHUNK": 5, "HEAVY": 3}.items():
        monkeypatch.setattr(T, name, value)


def test_like_the_plain_version(spark):
    check(spark, conversations(random.Random(1), 120, 6, ["", "a", "a b"]))


def test_small_pieces_and_chunks(spark, small):
    check(spark, conversations(random.Random(2), 90, 9, ["a", "b c"]))


def test_hot_conversation_and_copies(spark, small):
    """One conversation with a third of all turns, a first turn that all share and a third of the conversations alike."""
    rng = random.Random(3)
    rows = [(40, t, "user", "long" if t % 9 else "turn by turn") for t in range(90)]
    rows += [(c, t, "user", f"{t} same") for c in range(100, 130) for t in range(4)]
    rows += [(c, t, "user", "hello" if t == 0 else rng.choice("xy")) for c in range(200, 240) for t in range(4)]
    check(spark, rows)


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, None), (1, None, "", ""), (1, 0, "a", "bc"), (1, 0, "ab", "c"), (1, 0, "ab", "c"), (None, 1, "u", "x")]
    rows += [(20, 1, "u", "y\x0bz q"), (21, 5, "u", "only"), (22, -3, "u", "w " * 50_000), (40, 0, "u", ""), (-7, 0, "u", "neg"), (-20, 0, "u", "neg")]
    check(spark, rows)


def test_empty_and_single(spark):
    assert check(spark, []) == []
    assert check(spark, [(None, 1, "u", "x")]) == []
    for c in range(8):  # some lose their only turn: the root is then a leaf
        check(spark, [(c + 1, 0, "u", "x")])


def test_extents_like_brute_force():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64, 200):
        lcp = rng.integers(0, 4, n)
        at, depth = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(1, 5)))
        left, right = T.extents(lcp, at, depth)
        for i, d, a, b in zip(at, depth, left, right):
            x = y = i
            while x > 0 and lcp[x] >= d:
                x -= 1
            while y < n - 1 and lcp[y + 1] >= d:
                y += 1
            assert (a, b) == (x, y)
        values = rng.integers(0, 9, n)
        found = T.range_argmin(values, left, right)
        assert all(values[f] == values[a : b + 1].min() and a <= f <= b for f, a, b in zip(found, left, right))
