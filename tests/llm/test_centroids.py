"""Clustering by a vantage-point tree against a plain version."""

import hashlib

import numpy as np
import pytest

from saleswh.llm import centroids as C

NAN, INF = float("nan"), float("inf")


def plain(rows, dims, k, rounds, scale, seed):
    """rows: (vec_id, components); the result rows as a sorted list."""
    good = [(i, tuple(int(np.floor(scale * float(x))) for x in v)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    place = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(good, key=place)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        mine = {}
        for _, v in good:
            mine.setdefault(near(v)[1], []).append(v)
        cents = [tuple(sum(x) // len(mine[n]) for x in zip(*mine[n])) if n in mine else c for n, c in enumerate(cents)]
    found = [(i, *near(v)) for i, v in good]
    per = {}
    for _, d, n in found:
        per[n] = per.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, n, d, per[n], sum(per.values()), sha[n]) for i, d, n in found), key=str)


def check(spark, rows, dims, k=5, rounds=4, scale=8):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v int")
    got = [tuple(r) for r in C.centroid_clusters(df, dims=dims, k=k, rounds=rounds, scale=scale).collect()]
    assert sorted(got, key=str) == plain(rows, dims, k, rounds, scale, C.SEED)
    return got


@pytest.mark.parametrize("k", [1, 5, 40])
def test_like_the_plain_version(spark, k):
    rng = np.random.default_rng(k)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(250)]
    check(spark, rows, 3, k)


def test_ties_repeats_and_bad_vectors(spark):
    """A coarse grid: many equal vectors, equal centroids and equal distances, and empty clusters."""
    rng = np.random.default_rng(4)
    rows = [(i % 50, rng.integers(-1, 2, 2).astype(float).tolist()) for i in range(120)]
    rows += [(None, [1.0, 1.0]), (None, [0.0, 1.0]), (500, None), (501, []), (502, [1.0]), (503, [None, 1.0]), (504, [NAN, 1.0])]
    rows += [(505, [INF, 1.0]), (506, [-INF, 1.0]), (507, [1.0, 1.0, 1.0])]
    got = check(spark, rows, 2, 9, scale=1)
    assert len(got) == 122


def test_few_and_no_vectors(spark):
    assert check(spark, [(1, [0.5, 0.5]), (2, [0.25, 0.5])], 2, 5)
    assert check(spark, [(1, [0.5])], 2) == check(spark, [], 2) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(i % 7) * 2.0**27, 1.0 + i]) for i in range(40)]
    check(spark, rows, 2, 4, scale=3)


@pytest.mark.parametrize("k, dims, spread", [(1, 2, 3), (2, 2, 3), (8, 64, 400), (300, 4, 6), (200, 3, 1 << 24), (60, 2, 1)])
def test_search_like_brute_force(k, dims, spread):
    rng = np.random.default_rng(k)
    cents, rows = rng.integers(-spread, spread + 1, (k, dims)), rng.integers(-spread, spread + 1, (500, dims))
    best, sq = C.nearest(rows, C.build_tree(cents))
    d = ((rows[:, None] - cents[None]) ** 2).sum(axis=2)
    assert (sq == d.min(axis=1)).all() and (best == d.argmin(axis=1)).all()


def test_search_far_from_the_centroids():
    """Bounds of distant vectors keep ties although roots are rounded."""
    cents = np.array([[0, 0], [0, 2], [2, 0], [1, 1], [0, 0], [2, 2]])
    rows = np.array([[1 << 25, 1 << 25], [-(1 << 25), 1 << 25], [1, 0], [0, 1], [1, 1], [1 << 25, 1]])
    best, sq = C.nearest(rows, C.build_tree(cents))
    d = ((rows[:, None] - cents[None]) ** 2).sum(axis=2)
    assert (sq == d.min(axis=1)).all() and (best == d.argmin(axis=1)).all()


def test_search_prunes(monkeypatch):
    """Well-separated centroids: most distances are never taken."""
    rng = np.random.default_rng(1)
    cents = rng.integers(-(1 << 20), 1 << 20, (256, 2))
    rows = cents[rng.integers(0, 256, 2000)] + rng.integers(-9, 10, (2000, 2))
    taken = []
    plain_squared = C.squared
    tree = C.build_tree(cents)
    monkeypatch.setattr(C, "squared", lambda a, b: taken.append(len(a)) or plain_squared(a, b))
    C.nearest(rows, tree)
    assert sum(taken) < 2000 * 256 / 8
