r"""Trie of conversation prefixes, from range minima over the common prefixes of sorted conversations.

Every turn of a conversation is named by two 64-bit hashes of its place and the digest of its role and text; the exclusive
or of the first d names is the key of the node at depth d. A conversation is cut into pieces of ``WIDTH`` turns, each
with the key of the turns before it. Equal pieces are merged and the rest sorted, so that the
members of every node stand together. In a chunk of sorted pieces a sparse table gives the minimum of the common-prefix
lengths of any range; each candidate prefix searches its left and right extent in it by halving steps, on its own and all
candidates at once. What a chunk finds of a node is one row; a node whose interval crosses chunks or tasks is the sum of these rows.
So no conversation, no first turn that many share and no group of copies has to fit into one task.

Subtrees are not walked either. A node belongs to its smallest member, which owns all nodes below it on its own path. Let A(c)
be the words of conversation c before the first node it owns. A node at depth d with owner o saves, over its subtree,
the sum of A(c) - (words before depth d) over its members but o; its leaves are the members that own a leaf.
Both are sums over the interval, taken in a second pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table
from saleswh.llm.staging import settle
from saleswh.operators.keys import number_rows

WORDS = r"[^\x20\x09-\x0D]+"
#: Turns in a piece of a conversation.
WIDTH = 16
#: Rows of one conversation under one join or window key; longer conversations are dealt in slices.
SLICE = 65_536
#: Pieces whose extents are searched at once.
CHUNK = 32_768
#: A node with at least 1/HEAVY of all nodes as children hands its owner on by broadcast: at most HEAVY nodes.
HEAVY = 1000


# --- turns in order


def ordered_turns(conversations: DataFrame, key: str = "conv_id", order: str = "turn") -> tuple[DataFrame, DataFrame]:
    """(turns, starts): conv_id, no, digest, words of every turn, numbered over the whole table in order; conv_id, first, length.

    Turns are in the order of ``order``, null first, then of their digest, so that equal rows are interchangeable. Null roles and
    texts are empty. Rows without a conversation key belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    # the role's length keeps ("a", "bc") and ("ab", "c") apart
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col(f"`{key}`").cast("bigint").alias("conv_id"),
        F.col(f"`{order}`").alias("turn"),
        F.unhex(F.sha2(named, 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words"),
    ).filter(F.col("conv_id").isNotNull())
    turns = number_rows(rows, ["conv_id", F.col("turn").asc_nulls_first(), "digest"], "no").drop("turn")
    return turns, turns.groupBy("conv_id").agg(F.min("no").alias("first"), F.count("*").alias("length"))


def placed(turns: DataFrame, starts: DataFrame) -> DataFrame:
    """Turns with the columns of their conversation and ``place``, 0 for its first turn.

    The join key holds a slice of the numbering, so a conversation with a third of all turns is spread.
    """
    def part(no):
        return F.floor(no / SLICE).cast("bigint")

    spread = F.explode(F.sequence(part(F.col("first")), part(F.col("first") + F.col("length") - 1)))
    dealt = starts.withColumn("_part", spread)
    return turns.withColumn("_part", part(F.col("no"))).join(dealt, ["conv_id", "_part"]).select(
        *starts.columns, "digest", "words", (F.col("no") - F.col("first")).alias("place")
    )


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 3) -> DataFrame:
    """conv_id, total, place, digest, words: the first h turns of conversation c - c % group, then c's own after its first h.

    h is crc32(c in decimal) % (most + 1); the remainder of a negative c is negative, as in SQL. A conversation left without turns is one row with a null place.
    """
    turns, starts = ordered_turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    of_base = starts.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.explode(F.sequence(F.lit(0), F.least(F.col("length"), F.lit(most)) - 1)).alias("k"),
        (F.col("first") + F.col("k")).alias("no"),
    )
    # at most ``most`` turns a base
    heads = of_base.join(turns, "no").groupBy("base").agg(F.sort_array(F.collect_list(F.struct("k", "digest", "words"))).alias("head"))
    own = starts.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h})
    own = own.join(heads, "base", "left")
    own = own.withColumn("taken", F.least("h", F.coalesce(F.size("head"), F.lit(0)).cast("bigint")))
    own = own.withColumn("total", F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0)))
    kept = placed(turns, own.drop("head", "base")).filter(F.col("place") >= F.col("h"))
    kept = kept.select("conv_id", "total", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "words")
    first = own.filter("taken > 0").select("conv_id", "total", F.inline(F.slice("head", F.lit(1), F.col("taken").cast("int"))))
    first = first.select("conv_id", "total", F.col("k").cast("bigint").alias("place"), "digest", "words")
    none = own.filter("total = 0").select("conv_id", "total", *[F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in kept.columns[2:]])
    return kept.unionAll(first).unionAll(none)


# --- pieces of conversations


def pieces(turns: DataFrame) -> DataFrame:
    """One row per conversation and WIDTH turns.

    conv_id, total, piece, slice, names, key1, key2 (of the turns before), before (their words), x1, x2, words (the piece's own).

    turns: conv_id, total (its number of turns), place (0 ... total - 1), digest, words; a null place for no turns.
    """
    def name(*parts):
        return F.when(F.col("place").isNotNull(), F.xxhash64(*parts))

    named = turns.select(
        "conv_id", "total", F.floor(F.coalesce("place", F.lit(0)) / WIDTH).cast("bigint").alias("piece"),
        F.when(F.col("place").isNotNull(), F.struct("place", name("place", "digest").alias("x1"), name("digest", "place").alias("x2"), "words")).alias("t"),
    )
    cut = named.groupBy("conv_id", "piece").agg(
        F.max("total").alias("total"),
        F.sort_array(F.collect_list("t")).alias("t"),
        *[F.coalesce(F.bit_xor(f"t.x{i}"), F.lit(0)).alias(f"x{i}") for i in (1, 2)],
        F.coalesce(F.sum("t.words"), F.lit(0)).alias("words"),
    ).withColumn("slice", F.floor(F.col("piece") / (SLICE // WIDTH)).cast("bigint"))
    cut = settle(cut, "conversation-pieces")

    def upto(part, by, order):
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sums = {"key1": F.bit_xor("x1"), "key2": F.bit_xor("x2"), "before": F.sum("words")}
        return part.withColumns({c: F.coalesce(e.over(w), F.lit(0)) for c, e in sums.items()})

    within = upto(cut, ["conv_id", "slice"], "piece")
    # what the slices before hold: a row per SLICE turns of a conversation
    slices = cut.groupBy("conv_id", "slice").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("words").alias("words")
    )
    carried = upto(slices, ["conv_id"], "slice").filter("slice > 0")
    carried = carried.select("conv_id", "slice", *[F.col(c).alias(f"_{c}") for c in ("key1", "key2", "before")])
    zero = F.lit(0)
    return within.join(carried, ["conv_id", "slice"], "left").select(
        "conv_id", "total", "piece", "slice",
        F.transform("t", lambda e: F.struct(e["x1"].alias("x1"), e["x2"].alias("x2"), e["words"].alias("words"))).alias("names"),
        *[F.col(k).bitwiseXOR(F.coalesce(f"_{k}", zero)).alias(k) for k in ("key1", "key2")],
        (F.col("before") + F.coalesce("_before", zero)).alias("before"), "x1", "x2", "words",
    )


# --- extents of candidate prefixes


def sparse_table(values: np.ndarray, pick) -> list[np.ndarray]:
    """Level k holds pick over every run of 2^k values."""
    levels = [values]
    while len(levels[-1]) > (half := 1 << (len(levels) - 1)):
        levels.append(pick(levels[-1][:-half], levels[-1][half:]))
    return levels


def extents(lcp: np.ndarray, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share the first ``depth`` entries with row ``at``, for each candidate (at, depth).

    lcp[i]: common prefix of rows i - 1 and i. Each search halves its step and asks the table for the minimum over the
    step's range; no candidate uses what another one found.
    """
    n = len(lcp)
    table_ = sparse_table(lcp[1:], np.minimum)  # entry i: rows i and i + 1
    left, right = at.copy(), at.copy()
    for k in range(len(table_) - 1, -1, -1):
        level, step = table_[k], 1 << k
        if not len(level):
            continue
        to = left - step
        ok = (to >= 0) & (level[np.clip(to, 0, len(level) - 1)] >= depth)
        left[ok] = to[ok]
        to = right + step
        ok = (to < n) & (level[np.clip(right, 0, len(level) - 1)] >= depth)
        right[ok] = to[ok]
    return left, right


def range_argmin(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Index of the smallest value in each range."""
    levels = sparse_table(np.arange(len(values)), lambda a, b: np.where(values[a] <= values[b], a, b))
    k = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.zeros(len(left), np.int64)
    for level in np.unique(k):
        mine = k == level
        a, b = levels[level][left[mine]], levels[level][right[mine] - (1 << int(level)) + 1]
        out[mine] = np.where(values[a] <= values[b], a, b)
    return out


_NODE = pa.schema([(c, pa.int64()) for c in (
    "depth", "p1", "p2", "q1", "q2", "owner", "owner_a", "n_convs", "n_ends", "a_sum", "n_leaves", "words", "before")])
_NODE_DDL = ", ".join(f"{c} bigint" for c in _NODE.names)


def _found(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """What one chunk of sorted pieces holds of every node: a row a node."""
    n = t.num_rows
    names = t.column("names").combine_chunks()
    sizes = np.diff(names.offsets.to_numpy())
    flat = names.flatten()
    used = np.arange(WIDTH) < sizes[:, None]
    x = np.zeros((n, WIDTH, 2), np.int64)
    words = np.zeros((n, WIDTH), np.int64)
    x[used, 0], x[used, 1], words[used] = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "x2", "words"))
    col = {c: t.column(c).to_numpy() for c in t.column_names if c != "names"}
    head = np.stack([col["piece"], col["key1"], col["key2"]], axis=1)
    same = (x[1:] == x[:-1]).all(axis=2) & used[1:] & used[:-1] & (head[1:] == head[:-1]).all(axis=1)[:, None]
    lcp = np.concatenate([[0], np.cumprod(same, axis=1).sum(axis=1)])

    at = np.repeat(np.arange(n), sizes)
    depth = np.broadcast_to(np.arange(1, WIDTH + 1), (n, WIDTH))[used]
    left, right = extents(lcp, at, depth)
    # every member finds the same interval; it is told by its first row
    own = left == at
    at, depth, left, right = at[own], depth[own], left[own], right[own]

    def summed(c):
        upto = np.concatenate([[0], np.cumsum(col[c])])
        return upto[right + 1] - upto[left]

    keys = np.bitwise_xor.accumulate(x, axis=1) ^ np.stack([col["key1"], col["key2"]], axis=1)[:, None, :]
    last = depth - 1
    parent = np.where((last > 0)[:, None], keys[at, np.maximum(last - 1, 0)], np.stack([col["key1"], col["key2"]], axis=1)[at])
    owner = range_argmin(col["conv"], left, right)
    upto = np.cumsum(words, axis=1)
    out = {
        "depth": col["piece"][at] * WIDTH + depth, "p1": keys[at, last, 0], "p2": keys[at, last, 1], "q1": parent[:, 0], "q2": parent[:, 1],
        "owner": col["conv"][owner], "owner_a": col["conv_a"][owner], "n_convs": summed("n_convs"),
        # a piece that is the prefix itself sorts before those that go on
        "n_ends": np.where(sizes[left] == depth, col["n_ends"][left], 0),
        "a_sum": summed("a_sum"), "n_leaves": summed("n_leaves"), "words": words[at, last],
        "before": col["before"][at] + upto[at, last] - words[at, last],
    }
    yield from pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()}, schema=_NODE).to_batches(max_chunksize=65_536)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            held.append(batch.slice(start, CHUNK))
            rows += held[-1].num_rows
            if rows >= CHUNK:
                yield from _found(pa.Table.from_batches(held))
                held, rows = [], 0
    if rows:
        yield from _found(pa.Table.from_batches(held))


def nodes_of(cut: DataFrame) -> DataFrame:
    """All nodes but the root from pieces with the columns a and leaf of their conversation.

    depth, p1, p2 (key), q1, q2 (key of the parent), owner, owner_a, n_convs, n_ends, a_sum, n_leaves, words (of the last turn), before.
    """
    last = ((F.col("piece") + 1) * WIDTH >= F.col("total")).cast("bigint")
    equal = cut.groupBy("piece", "key1", "key2", "names").agg(
        F.min("before").alias("before"), F.count("*").alias("n_convs"), F.sum(last).alias("n_ends"),
        F.min("conv_id").alias("conv"), F.min_by("a", "conv_id").alias("conv_a"), F.sum("a").alias("a_sum"), F.sum("leaf").alias("n_leaves"),
    )
    order = ["piece", "key1", "key2", "names"]
    found = equal.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, _NODE_DDL)
    # a row per node and chunk: only nodes that cross chunks meet here
    return found.groupBy("depth", "p1", "p2").agg(
        *[F.min(c).alias(c) for c in ("q1", "q2", "words", "before", "owner")], F.min_by("owner_a", "owner").alias("owner_a"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_ends", "a_sum", "n_leaves")],
    )


# --- the trie


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 over the ids of each key, which come sorted; one running digest is held at a time."""
    key, running = None, None

    def done():
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([running.hexdigest()])], ["depth", "p1", "p2", "ends_sha256"])

    for batch in batches:
        depth, p1, p2, ids = (batch.column(c).to_numpy() for c in ("total", "x1", "x2", "conv_id"))
        cuts = np.flatnonzero((np.diff(depth) != 0) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(ids)]):
            if start == end:
                continue
            here = (int(depth[start]), int(p1[start]), int(p2[start]))
            text = ",".join(map(str, ids[start:end].tolist())).encode()
            if here != key:
                if key is not None:
                    yield done()
                key, running = here, hashlib.sha256(text)
            else:
                running.update(b"," + text)
    if key is not None:
        yield done()


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, total, place, digest, words, as ``rebuilt`` gives them: places 0 ... total - 1 without gaps, each once; a
    conversation without turns is one row with a null place and a member of the root only. No conversations give
    no rows, not even a root. A node is named by its smallest member and its depth. Equal conversations share all nodes.
    """
    spark = turns.sparkSession
    cut = settle(pieces(turns), "pieces-with-keys")
    convs = cut.groupBy("conv_id").agg(
        F.max("total").alias("total"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("words").alias("all_words")
    )
    zero = F.lit(0).cast("bigint")
    found = nodes_of(cut.withColumns({"a": zero, "leaf": zero}))
    owned = found.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("before").alias("owned_from"), F.max((F.col("n_convs") == F.col("n_ends")).cast("bigint")).alias("leaf")
    )
    convs = convs.join(owned, "conv_id", "left").select(
        "conv_id", "total", "x1", "x2", F.coalesce("owned_from", "all_words").alias("a"), F.coalesce("leaf", zero).alias("leaf")
    )
    convs = settle(convs, "conversation-sums")

    dealt = convs.select(
        "conv_id", "a", "leaf", F.explode(F.sequence(zero, F.floor(F.greatest(F.col("total") - 1, zero) / SLICE).cast("bigint"))).alias("slice")
    )
    nodes = nodes_of(cut.join(dealt, ["conv_id", "slice"]))
    root = convs.agg(
        F.min("conv_id").alias("owner"), F.min_by("a", "conv_id").alias("owner_a"), F.count("*").alias("n_convs"),
        F.sum("a").alias("a_sum"), F.greatest(F.sum("leaf"), F.lit(1)).alias("n_leaves"),
    ).filter("n_convs > 0")
    root = root.select(*[
        F.col(c) if c in root.columns else F.lit(None if c in ("q1", "q2") else 0).cast("bigint").alias(c) for c in nodes.columns
    ])
    nodes = settle(nodes.unionAll(root), "trie-nodes")

    at = ["depth", "p1", "p2"]
    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("n_children"))
    ends = convs.repartition("total", "x1", "x2").sortWithinPartitions("total", "x1", "x2", "conv_id").select("total", "x1", "x2", "conv_id")
    ends = ends.mapInArrow(_digests, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")
    full = nodes.join(kids, at, "left").join(ends, at, "left")
    full = settle(full.select(
        "depth", "p1", "p2", "q1", "q2", "owner", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        (F.col("a_sum") - F.col("owner_a") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    ), "trie-sums")

    parents = full.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("owner").alias("parent"), "n_children")
    up = ["depth", "q1", "q2"]
    heavy = F.broadcast(parents.filter(F.col("n_children") * HEAVY >= full.count()).drop("n_children"))
    of_heavy = full.join(heavy, up)
    of_others = full.join(heavy, up, "left_anti").join(parents.drop("n_children"), up, "left")
    return of_heavy.select(*of_others.columns).unionAll(of_others).select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )


OP13_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, words, id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM (
    SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS words,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
    FROM conversations WHERE conv_id IS NOT NULL)),
v AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
      lambda s: [ord(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT c, id, words, row_number() OVER (PARTITION BY c ORDER BY k) AS d FROM (
    SELECT v.c, t.id, t.words, t.pos AS k FROM v JOIN t ON t.c = v.c - v.c % 20 AND t.pos < h
    UNION ALL SELECT v.c, t.id, t.words, t.pos + 3 FROM v JOIN t ON t.c = v.c AND t.pos >= h)),
p AS (
  SELECT c, d, words, string_agg(id, '') OVER (PARTITION BY c ORDER BY d) AS path FROM r UNION ALL SELECT c, 0, 0, '' FROM v),
n AS (SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved FROM p GROUP BY path),
k AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
e AS (SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM (SELECT c, arg_max(path, d) AS path FROM p GROUP BY c) GROUP BY path),
s AS (
  SELECT n.path, sum(m.saved) AS saved_tokens, count(*) FILTER (k.path IS NULL) AS n_leaves
  FROM n JOIN n AS m ON starts_with(m.path, n.path) LEFT JOIN k ON k.path = m.path GROUP BY n.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
  n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN e USING (path)
LEFT JOIN n AS u ON n.depth > 0 AND u.path = left(n.path, length(n.path) - 64)
"""


@query(OP13_SQL)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))
