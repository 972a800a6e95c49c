"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it when its cosine with the direction reaches a threshold.
Directions come from a random product code: after a random rotation the coordinates are split
into two halves, each half has its own list of random unit vectors, and every pair of one from
each list is a direction. A vector's score is then a sum of two terms, so all
directions over the threshold can be listed without looking at the others: one list is sorted, and
each entry of the other takes a prefix of it.

The threshold rises with the number of vectors so that a filter passes about ``PASS`` unrelated ones, up to the least
cosine of a pair. The number of directions follows from the chance that a pair at the least cosine passes a common
filter, both taken from the distribution of the cosine in the vectors' dimension: the expected number of common filters is
``SAFETY * log(1 / MISS)``, dealt over ``CODES`` rotations; vectors of few dimensions have a list of single
directions and ``log(1 / MISS)``. Vectors meet in the
filters they share, in blocks of bounded size, and every pair is verified. A pair counts in its smallest common filter
only. A block returns sums per vector and a spanning forest of its links, so a group of near
copies never turns into rows for all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.blocks import by_group, in_blocks
from saleswh.llm.components import components
from saleswh.llm.registry import query, table
from saleswh.storage import stage

LEAST = 0.9
#: Unrelated vectors that pass a filter.
PASS = 64
#: A pair at the least cosine is missed with about this chance, were filters independent ...
MISS = 1e-3
#: ... and with so many more filters, since those that share a half are not.
SAFETY = 4.0
BLOCK = 1500
SEED = 7


#: Up to this dimension directions are single vectors, not pairs: halves of so few coordinates are often out of balance.
SINGLE = 7
#: Product codes with rotations of their own that share the filters of a dimension.
CODES = 8


@dataclass(frozen=True)
class Plan:
    """Filters for vectors of one dimension: cosine threshold, length of a list, number of codes, first filter."""

    cut: float
    length: int
    codes: int
    first: int = 0

    @property
    def filters(self) -> int:
        return self.length if self.codes == 0 else self.length * self.length * self.codes


def _tail(cosine, dims: int):
    """Chance that a random direction has at least this cosine with a fixed one."""
    cosine = np.asarray(cosine, np.float64)
    if dims == 1:
        return np.where(cosine <= -1, 1.0, np.where(cosine <= 1, 0.5, 0.0))
    edges = np.linspace(0, math.pi, 100_001)
    share = np.concatenate([[0], np.cumsum(np.sin((edges[1:] + edges[:-1]) / 2) ** (dims - 2))])
    return np.interp(np.arccos(np.clip(cosine, -1, 1)), edges, share / share[-1])


def _common(cut: float, dims: int, least: float) -> float:
    """Chance that a vector passes a filter that its partner at cosine least passes."""
    widest = math.acos(cut)
    angle = (np.arange(4000) + 0.5) / 4000 * widest
    density = np.sin(angle) ** (dims - 2)
    # the partner's cosine is least * cos(angle) and a part across, a random direction in one dimension less
    across = (cut - least * np.cos(angle)) / (math.sqrt(1 - least * least) * np.sin(angle))
    both = np.where(across <= 1, _tail(across, dims - 1), 0.0)
    return float((density * both).sum() / density.sum())


def filter_plan(vectors: int, dims: int, least: float = LEAST) -> Plan:
    """Threshold and lists from the tails of the cosine in this dimension, not from those of a normal."""
    if dims == 1:
        return Plan(-2.0, 1, 0)
    rate = min(0.1, PASS / max(vectors, 1))
    low, high = 0.0, max(least, 0.0)  # beyond the pair's cosine filters would be shared by nearer pairs only
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (mid, high) if _tail(mid, dims) > rate else (low, mid)
    wanted = math.log(1 / MISS) / _common(low, dims, least) / float(_tail(low, dims))
    if dims <= SINGLE:
        return Plan(low, math.ceil(wanted), 0)
    return Plan(low, max(4, math.ceil(math.sqrt(SAFETY * wanted / CODES))), CODES)


def filter_plans(counts: dict[int, int], least: float = LEAST) -> dict[int, Plan]:
    """Plans by dimension; no filter serves two dimensions."""
    plans, first = {}, 0
    for dims, vectors in sorted(counts.items()):
        plans[dims] = replace(filter_plan(vectors, dims, least), first=first)
        first += plans[dims].filters
    return plans


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def product_code(dims: int, length: int, number: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The two lists as directions in the space before the rotation: (length, dims) each, of norm 1 / sqrt(2)."""
    rng = np.random.default_rng([SEED, dims, length, number])
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    half = dims // 2
    lists = []
    for at in (slice(0, half), slice(half, dims)):
        code = np.zeros((length, dims))
        code[:, at] = rng.standard_normal((length, code[:, at].shape[1]))
        code /= np.linalg.norm(code, axis=1, keepdims=True) * math.sqrt(2)
        lists.append(code @ rotation)
    return lists[0], lists[1]


def plan_codes(dims: int, plan: Plan) -> list[tuple[np.ndarray, ...]]:
    """The lists of a plan: two of each product code, or a single one of whole directions."""
    if plan.codes:
        return [product_code(dims, plan.length, number) for number in range(plan.codes)]
    return [(_unit(np.random.default_rng([SEED, dims, plan.length]).standard_normal((plan.length, dims))),)]


def filters_of(unit: np.ndarray, plan: Plan, codes: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Sorted filters that a unit vector passes."""
    if not plan.codes:
        return plan.first + np.flatnonzero(codes[0][0] @ unit >= plan.cut)
    found = []
    for number, (heads, tails) in enumerate(codes):
        first, second = heads @ unit, tails @ unit
        order = np.argsort(-second)
        taken = np.searchsorted(-second[order], first - plan.cut, side="right")
        some = np.flatnonzero(taken)
        at = plan.first + (number * plan.length + some) * plan.length
        found.extend(a + order[:k] for a, k in zip(at, taken[some]))
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _decoded(batches: Iterator[pa.RecordBatch], plans: dict[int, Plan]) -> Iterator[pa.RecordBatch]:
    """vec, copies, embedding, filters (sorted)."""
    codes: dict[int, list[tuple[np.ndarray, ...]]] = {}
    for batch in batches:
        filters = []
        for x in batch.column("embedding"):
            x = np.asarray(x.values)
            dims = len(x)
            if dims not in codes:
                codes[dims] = plan_codes(dims, plans[dims])
            filters.append(filters_of(_unit(x[None, :])[0], plans[dims], codes[dims]))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in filters])]), pa.int32())
        values = pa.array(np.concatenate(filters) if filters else [], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec"), batch.column("copies"), batch.column("embedding"), pa.ListArray.from_arrays(offsets, values)],
            ["vec", "copies", "embedding", "filters"],
        )


def _links(table: pa.Table, least: float) -> Iterator[pa.RecordBatch]:
    """vec, n: weight of the links counted here; and vec, to: edges of a spanning forest (n = 0)."""
    vecs, copies, side = (table.column(c).to_numpy() for c in ("vec", "copies", "side"))
    two = side.any()
    unit = _unit(np.stack([np.asarray(x.values) for x in table.column("embedding").combine_chunks()]))
    linked = np.zeros((len(vecs), len(vecs)), bool)
    for at in range(0, len(vecs), 512):
        linked[at : at + 512] = unit[at : at + 512] @ unit.T >= least
    linked &= (side[:, None] != side[None, :]) if two else (vecs[:, None] != vecs[None, :])
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return
    linked = linked[np.ix_(some, some)]
    vecs, copies = vecs[some], copies[some]
    # a pair belongs to its smallest common filter
    lists = table.column("filters").combine_chunks().take(pa.array(some))
    earlier = [np.asarray(x.values) for x in lists]
    names, index = np.unique(np.concatenate(earlier), return_inverse=True)
    has = np.zeros((len(some), len(names)), np.float32)
    has[np.repeat(np.arange(len(some)), [len(f) for f in earlier]), index] = 1
    if len(names):
        linked &= (has @ has.T) == 0
    counts = linked @ copies
    a, b = [], []
    new = np.ones(len(some), bool)
    for start in range(len(some)):
        if not new[start]:
            continue
        new[start] = False
        stack = [start]
        while stack:
            i = stack.pop()
            found = np.flatnonzero(linked[i] & new)
            new[found] = False
            stack.extend(found)
            a.append(np.full(len(found), vecs[i]))
            b.append(vecs[found])
    a, b = np.concatenate(a), np.concatenate(b)
    full = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([vecs[full], a]), pa.int64()),
            pa.array(np.concatenate([vecs[full], b]), pa.int64()),
            pa.array(np.concatenate([counts[full], np.zeros(len(a), np.int64)]), pa.int64()),
        ],
        ["vec", "to", "n"],
    )


def vector_links(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", least: float = LEAST) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    Vectors that are null or empty, zero, or hold null or non-finite components link with nothing; nor do vectors of
    different lengths. Equal vectors are copies of one and link with each other. kept is key = component_id.
    Labels and other columns are not read. No rows give no rows.
    """
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{embedding}`").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("embedding").isNotNull() & ~odd & F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(good, F.lit(False))
    distinct = rows.filter(good).groupBy("embedding").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    distinct = stage(distinct.withColumn("vec", F.monotonically_increasing_id()), "vectors")
    dims = distinct.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("vectors")).collect()
    plans = filter_plans({r.dims: r.vectors for r in dims}, least)
    kind = distinct.schema["embedding"].dataType.simpleString()
    found = distinct.select("vec", "copies", "embedding").mapInArrow(
        partial(_decoded, plans=plans), f"vec long, copies long, embedding {kind}, filters array<long>"
    )
    spread = found.select("vec", "copies", "embedding", "filters", F.posexplode("filters").alias("at", "filter"))
    # a block reads only the filters before its own
    spread = spread.select("vec", "copies", "embedding", F.slice("filters", F.lit(1), F.col("at")).alias("filters"), "filter")
    links = stage(
        in_blocks(spread, "filter", "vec", BLOCK).mapInArrow(
            by_group(["filter", "block"], partial(_links, least=least)), "vec long, to long, n long"
        ),
        "links",
    )
    counts = links.groupBy("vec").agg(F.sum("n").alias("n"))
    reached = components(links.filter("n = 0").select("vec", "to"))
    placed = (
        distinct.join(counts, "vec", "left").join(reached.withColumnRenamed("node", "vec"), "vec", "left")
        .withColumn("component", F.coalesce("component", "vec"))
    )
    named = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = placed.join(named, "component").select(
        F.col("embedding").alias("same"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = rows.withColumn("good", good).join(placed, F.col("good") & (F.col("embedding") == F.col("same")), "left")
    component = F.when(F.col("same").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return linked.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.c),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id)
SELECT m.vec_id, coalesce(n.n, 0) AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN n ON n.a = m.vec_id
"""


@query(OP3_SQL)
def op3_cap_filters(spark, sf_dir):
    return vector_links(table(spark, sf_dir, "embeddings"))
