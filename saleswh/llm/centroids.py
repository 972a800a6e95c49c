"""Centroid clustering with a vantage-point tree over the centroids.

Vectors become integers, so distances, means and ties are exact. Each round builds a vantage-point tree over the centroids
on the driver (their number is a parameter) and broadcasts it. Every vector searches the tree best-first: a heap of
subtrees ordered by a lower bound of the distance, pruned only when the bound exceeds the best distance so far, so that a
centroid at exactly that distance is still seen and the smaller number wins. Distances at vantage points and in leaves are
integers. A batch of vectors searches at once: at each step every vector opens its own nearest subtree.

A round reads the written integer vectors once and sends one row per task, cluster and component to the shuffle; only the
new centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table
from saleswh.llm.staging import settle

DIMS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Centroids in a leaf of the tree.
LEAF = 2
#: Heap entries (vectors times nodes of the tree) that a search holds at once.
HEAP = 1 << 20
#: Relative error allowed for roots and their differences when a subtree is pruned.
ERROR = 1e-12
#: Components up to this magnitude keep squared distances and partial sums of a batch within 64 bits; others take Python's integers.
SMALL = 1 << 26


@dataclass
class Tree:
    """A vantage-point tree as arrays over its nodes; the root is node 0.

    A node holds its vantage point's number or, in a leaf (``inner`` < 0), the numbers of its centroids. The distance of the
    vantage point to all centroids below a child lies between the child's low and high bound.
    """

    centroids: np.ndarray
    members: list[list[int]] = field(default_factory=list)
    inner: list[int] = field(default_factory=list)
    outer: list[int] = field(default_factory=list)
    low: list[float] = field(default_factory=list)
    high: list[float] = field(default_factory=list)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of a to b."""
    d = a - b
    return (d * d).sum(axis=-1)


def exact(rows: np.ndarray) -> np.ndarray:
    """Integer rows, as Python's integers when 64 bits could overflow."""
    return rows if rows.dtype == object or not rows.size or np.abs(rows).max() <= SMALL else rows.astype(object)


def build_tree(centroids: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree over all centroids, equal ones included."""
    tree = Tree(exact(centroids))
    # numbers of the centroids, the bounds of their distance to the vantage point above, and the place to note the new node
    todo = [(list(range(len(centroids))), 0.0, np.inf, None)]
    while todo:
        numbers, low, high, parent = todo.pop(0)
        at = len(tree.members)
        if parent is not None:
            side, node = parent
            side[node] = at
        tree.low.append(low)
        tree.high.append(high)
        tree.inner.append(-1)
        tree.outer.append(-1)
        if len(numbers) <= leaf:
            tree.members.append(numbers)
            continue
        # the vantage point is the centroid farthest from the first one: it spreads the others' distances
        first = squared(tree.centroids[numbers], tree.centroids[numbers[0]]).astype(float)
        vantage = numbers[int(first.argmax())]
        rest = [n for n in numbers if n != vantage]
        away = np.sqrt(squared(tree.centroids[rest], tree.centroids[vantage]).astype(float))
        order = np.argsort(away, kind="stable")
        half = (len(rest) + 1) // 2
        tree.members.append([vantage])
        for side, part in ((tree.inner, order[:half]), (tree.outer, order[half:])):
            if len(part):
                todo.append(([rest[i] for i in part], away[part].min(), away[part].max(), (side, at)))
    return tree


def nearest(rows: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of the nearest centroid, the smaller one on ties, and the exact squared distance."""
    rows = exact(rows)
    if tree.centroids.dtype == object and rows.dtype != object:
        rows = rows.astype(object)
    n = len(rows)
    best = np.full(n, -1, np.int64)
    best_sq = np.zeros(n, rows.dtype)
    radius = np.full(n, np.inf)
    # each row's heap: the lower bound of every subtree it may still open
    bound = np.full((n, len(tree.members)), np.inf)
    bound[:, 0] = 0
    live = np.arange(n)
    while len(live):
        node = bound[live].argmin(axis=1)
        least = bound[live, node]
        # inclusive: a subtree whose bound equals the radius may hold a tie
        going = (least <= radius[live] * (1 + ERROR)) & np.isfinite(least)
        live, node, least = live[going], node[going], least[going]
        bound[live, node] = np.inf
        for t in np.unique(node):
            mine, floor = live[node == t], least[node == t]
            for number in tree.members[t]:
                d = squared(rows[mine], tree.centroids[number])
                closer = (best[mine] < 0) | (d < best_sq[mine]) | ((d == best_sq[mine]) & (number < best[mine]))
                won = mine[closer.astype(bool)]
                best[won], best_sq[won] = number, d[closer.astype(bool)]
                radius[won] = np.sqrt(best_sq[won].astype(float))
            away = np.sqrt(d.astype(float))
            for child in (tree.inner[t], tree.outer[t]):
                if child >= 0:
                    low, high = tree.low[child], tree.high[child]
                    # roots are off by a few units in the last place: the bound is lowered by more than that
                    apart = np.maximum(away - high - ERROR * (away + high), low - away - ERROR * (away + low))
                    bound[mine, child] = np.maximum(floor, apart)
    return best, best_sq


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().reshape(-1, dims)


def _pieces(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    most = max(64, HEAP // max(1, len(tree.members)))
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def _sums(batches: Iterator[pa.RecordBatch], tree, dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """One row per cluster that a task's vectors chose: their number and exact componentwise sums."""
    counts, sums = [0] * k, np.zeros((k, dims), object)
    for batch in _pieces(batches, tree.value):
        rows = exact(_rows(batch, dims))
        chosen, _ = nearest(rows, tree.value)
        for c in np.unique(chosen):
            mine = rows[chosen == c]
            counts[c] += len(mine)
            sums[c] += mine.sum(axis=0).astype(object)
    used = [c for c in range(k) if counts[c]]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int32()),
            pa.array([counts[c] for c in used], pa.int64()),
            pa.array([[str(x) for x in sums[c]] for c in used], pa.list_(pa.string())),
        ],
        ["cluster", "n", "sums"],
    )


def _assigned(batches: Iterator[pa.RecordBatch], tree, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches, tree.value):
        chosen, sq = nearest(_rows(batch, dims), tree.value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(chosen, pa.int32()), pa.array([int(x) for x in sq], pa.int64())],
            ["vec_id", "cluster", "distance"],
        )


def integer_vectors(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """vec_id and v, the components as floor(scale * x), of vectors with exactly dims components, all finite."""
    rows = vectors.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    # a null component makes forall null, which no filter passes
    rows = rows.filter(F.size("x") == dims).filter(F.forall("x", lambda e: F.abs(e) < F.lit(float("inf"))))
    return rows.select("vec_id", F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e).cast("bigint")).alias("v"))


def new_centroids(rows: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floored means of the vectors nearest to each old centroid; an old one without vectors stays."""
    k, dims = old.shape
    shared = rows.sparkSession.sparkContext.broadcast(build_tree(old))
    try:
        parts = rows.select("v").mapInArrow(partial(_sums, tree=shared, dims=dims, k=k), "cluster int, n long, sums array<string>")
        cells = parts.select("cluster", "n", F.posexplode("sums").alias("place", "s"))
        found = cells.groupBy("cluster", "place").agg(
            F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")
        )
        new = old.astype(object)
        for r in found.collect():  # at most a row per centroid and component
            new[r.cluster, r.place] = int(r.s) // r.n
    finally:
        shared.destroy()
    return exact(new.astype(np.int64))


def centroid_clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = DIMS,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """One row per clustered vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another length, or hold null or non-finite components are left out. The first centroids are the
    k vectors with the smallest sha256 of "seed:vec_id"; vectors that repeat a key follow by their components, null keys
    come last (they are clustered like any other). With fewer than k vectors each is a centroid. Equal centroids and equal
    distances: the smaller number wins. Every row is kept, repeated ones too; other columns are not read. No vectors give no
    rows. Components or distances beyond 64 bits are an error, never rounded.
    """
    spark = vectors.sparkSession
    rows = settle(integer_vectors(vectors, key, vector, dims, scale), "integer-vectors")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("v", place.alias("place")).orderBy(F.col("place").asc_nulls_last(), "v").limit(k).collect()
    schema = "cluster int, centroid_sha256 string"
    centroids = np.array([r.v for r in first], np.int64).reshape(len(first), dims)
    for _ in range(rounds if len(first) else 0):
        before, centroids = centroids, new_centroids(rows, centroids)
        if (before == centroids).all():
            break  # all further rounds would give the same again
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = spark.createDataFrame(list(enumerate(digests)), schema)
    shared = spark.sparkContext.broadcast(build_tree(centroids))
    kind = rows.schema["vec_id"].dataType.simpleString()
    try:
        found = settle(rows.mapInArrow(partial(_assigned, tree=shared, dims=dims), f"vec_id {kind}, cluster int, distance long"), "assigned")
    finally:
        shared.destroy()
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    # a row per centroid: small enough to broadcast for any k the driver can hold
    whole = per.select(*per.columns, F.sum("s").over(Window.partitionBy()).alias("t")).join(named, "cluster")
    return found.join(F.broadcast(whole), "cluster").select(
        "vec_id", "cluster", "distance",
        F.col("s").cast("bigint").alias("cluster_inertia"), F.col("t").cast("bigint").alias("inertia"), "centroid_sha256",
    )


def _sql(rounds: int) -> str:
    """Lloyd's rounds as one statement per round; comparing every vector with every centroid."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2])::HUGEINT * (p[1] - p[2])))"
    steps = [f"""
e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIMS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c FROM e
  ORDER BY cluster LIMIT {CENTROIDS})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, min((d, cluster)) AS best
  FROM (SELECT e.*, cluster, {distance} AS d FROM e, c{i}) GROUP BY r, vec_id, v)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS c FROM (
    SELECT best[2] AS cluster, j, sum(v[j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i}, range(1, {DIMS + 1}) AS o(j)
    GROUP BY ALL) GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, cluster, best[1]::BIGINT AS distance,
  CAST(sum(best[1]) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best[2] = cluster
"""


OP11_SQL = _sql(ROUNDS)


@query(OP11_SQL)
def op11_centroid_clusters(spark, sf_dir):
    return centroid_clusters(table(spark, sf_dir, "embeddings"))
