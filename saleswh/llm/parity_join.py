"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Each shingle is XORed into one of P words of 64
bits that its hash picks, so two sets differ in at most as many words as their
symmetric difference has shingles. A Jaccard similarity of at least t bounds the
symmetric difference of sizes a and b by (1 - t) / (1 + t) * (a + b). Sizes are
cut into bands; for pairs whose smaller set lies in a band this bound is at most D, and with
P > D words some words must be equal (pigeonhole). A set enters its own band and those lower ones in which
a partner may lie. Words that no shingle fell into say nothing and are never used: there are so many more than D words
that of those that agree some are filled (see slack). The few sets whose words are empty beyond that are also
found by an exact prefix index: of any two linked sets the shingles with the smallest hashes, a fifth and one, have one in common.

Equal words are only a hint. Sets that share one are linked in rounds, so that a group of thousands of
near copies never turns into all its pairs:

1. each set against one other, the first set of most of the groups of equal words it is in;
2. in each group of sets with an equal word, the pairs that connect its components at the smallest distances: fewer than it has sets;
3. every pair of such a group that still lies in two components and was not tried.

Before each round groups inside one component leave, and so do sets that share fewer words with other
components than they would with any one partner there.

In rounds 2 and 3 pairs are compared in blocks by their bit sketches, in which every
shingle flips one bit: a Hamming distance over the bound excludes a pair. Near copies share most of their words, so
each set names the first few groups it is in, the largest first, and a group passes over a pair that also meets in one
named before it: the first group that two sets share always keeps them. What
is left is verified on the full sets. Every pair that shares a word ends up in one component or is
compared, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.blocks import by_group, in_blocks
from saleswh.llm.components import components
from saleswh.llm.registry import query, table
from saleswh.llm.shingles import mix, shingle_sets
from saleswh.llm.staging import settle

#: Documents link from this percentage of common shingles on.
PERCENT = 80
#: Sets compared with each other in one block.
BLOCK = 2000
#: Groups that a set names, so that later ones pass over pairs found there.
NAMED = 8


def bands(largest: int) -> list[tuple[int, int]]:
    """Size bands (lowest, beyond): single sizes first, then steps of 8/5."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, edges[-1] * 8 // 5))
    return list(zip(edges, edges[1:]))


def most_different(a, b, percent: int):
    """Largest symmetric difference of linked sets of sizes a and b."""
    return (100 - percent) * (a + b) // (100 + percent)


def slack(n: int, most: int) -> int:
    """Words beyond ``most`` such that n shingles leave fewer of all words empty than that, four deviations off."""
    extra = 6 if most else 0
    while most:
        count = most + 1 + extra
        miss = np.exp(-n / count)
        empty, spread = count * miss, np.sqrt(count * miss * max(1 - (1 + n / count) * miss, 0))
        if extra >= empty + 4 * spread:
            break
        extra += 1
    return extra


@cache
def word_count(low: int, beyond: int, percent: int) -> tuple[int, int]:
    """Words of the sketches in a band, and how many of them linked sets can differ in."""
    small = beyond - 1
    most = most_different(small, small * 100 // percent, percent)
    return most + 1 + slack(low, most), most


def words_of(hashes: np.ndarray, low: int, beyond: int, percent: int) -> tuple[np.ndarray, int]:
    """Keys by which a set is found in one band, and how many of them any partner shares.

    The keys are those of its filled sketch words and, when too few are filled to promise one, of its prefix.
    A partner that can promise one shares a filled word; two sets that cannot share a key of their prefixes.
    """
    count, most = word_count(low, beyond, percent)
    place = mix(hashes ^ np.uint64(low))
    part = ((place >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    spread = mix(place + np.uint64(1))
    words = np.zeros(count, np.uint64)
    np.bitwise_xor.at(words, part, spread)
    used = np.zeros(count, bool)
    used[part] = True
    keys = mix(mix(words[used] + np.uint64(low)) + np.flatnonzero(used).astype(np.uint64))
    # count - most words agree at least; the empty ones among them do not show
    shared = count - most - int(count - used.sum())
    if shared > 0:
        return keys, shared
    prefix = np.sort(spread)[: len(spread) + (-percent * len(spread)) // 100 + 1]
    return np.concatenate([keys, mix(mix(prefix + np.uint64(low)) + np.uint64(count))]), 1


def _roles(n: int, percent: int) -> list[tuple[int, int]]:
    """Bands in which a set of n shingles is looked up."""
    return [(low, beyond) for low, beyond in bands(n) if (beyond - 1) * 100 >= percent * n] if n else []


def bit_sketch(hashes: np.ndarray) -> np.ndarray:
    """One bit flipped by each shingle, in words of 64: as many bits as the next power of two, up to 4096."""
    bits = min(max(64, 1 << int(len(hashes) - 1).bit_length()), 4096) if len(hashes) else 64
    out = np.zeros(bits // 64, np.uint64)
    bit = hashes & np.uint64(bits - 1)
    np.bitwise_xor.at(out, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The same sketch with fewer words."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def _set_id(hashes: np.ndarray) -> int:
    both = np.array([hashes.sum(dtype=np.uint64), np.bitwise_xor.reduce(hashes) + np.uint64(len(hashes))], np.uint64)
    return int(mix(both[:1] + mix(both[1:]))[0].astype(np.int64))


def _sets_of(batches: Iterator[pa.RecordBatch], with_sketch: bool) -> Iterator[pa.RecordBatch]:
    """doc, n, set_id, and as parts the bit sketch or the whole set."""
    for batch in batches:
        ids, sizes, lists = [], [], []
        for s in shingle_sets(batch.column("text").to_pylist()):
            ids.append(_set_id(s) if len(s) else None)
            sizes.append(len(s))
            lists.append((bit_sketch(s) if with_sketch else s).view(np.int64))
        values = pa.array(np.concatenate(lists) if lists else [], pa.int64())
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
             pa.ListArray.from_arrays(offsets, values)],
            ["doc", "n", "set_id", "parts"],
        )


def _index(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """word, set_id, shared: each set once a task; shared is the fewest words that any partner has in common."""
    seen: set[int] = set()
    for batch in batches:
        keys, owners, least = [], [], []
        for s in shingle_sets(batch.column("text").to_pylist()):
            if not len(s) or (set_id := _set_id(s)) in seen:
                continue
            seen.add(set_id)
            found = [words_of(s, low, beyond, percent) for low, beyond in _roles(len(s), percent)]
            shared = min(x for _, x in found)
            for words, _ in found:
                keys.append(words.view(np.int64))
                owners.append(np.full(len(words), set_id, np.int64))
                least.append(np.full(len(words), shared, np.int32))
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (keys, owners, least)], ["word", "set_id", "shared"]
            )


def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1)


def _met_before(earlier: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j name a group in common; 0 names none."""
    out = np.zeros(len(i), bool)
    step = 1 << 16
    for at in range(0, len(i), step):
        x, y = earlier[i[at : at + step]], earlier[j[at : at + step]]
        for k in range(earlier.shape[1]):
            named = x[:, k, None]
            out[at : at + step] |= ((named == y) & (named != 0)).any(axis=1)
    return out


def _forest(i: np.ndarray, j: np.ndarray, far: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Places of the pairs i, j that connect the labels at the smallest distances: a least spanning forest.

    In each turn every label takes the first of its pairs in the order of distance, and labels so connected become one.
    """
    at = np.argsort(far, kind="stable")
    kept = []
    while True:
        u, v = label[i[at]], label[j[at]]
        apart = u != v
        at, u, v = at[apart], u[apart], v[apart]
        if not len(at):
            return np.concatenate(kept) if kept else at
        nth = np.arange(len(at))
        first = np.full(len(label), len(at))
        np.minimum.at(first, u, nth)
        np.minimum.at(first, v, nth)
        has = np.flatnonzero(first < len(at))
        kept.append(at[np.unique(first[has])])
        to = np.arange(len(label))
        to[has] = u[first[has]] + v[first[has]] - has
        # the only circles are two labels that took the same pair
        root = (to[to] == np.arange(len(to))) & (np.arange(len(to)) < to)
        to[root] = np.flatnonzero(root)
        while (to[to] != to).any():
            to = to[to]
        label = to[label]


def _near(table: pa.Table, percent: int, closest: bool) -> Iterator[pa.RecordBatch]:
    """a, b: pairs of a block in two components whose bit sketches do not exclude a link, without those that met before.

    closest: only pairs that connect the components of the block at the smallest distances. If a pair met before, others connect
    the two as closely there.
    """
    ids, comps, sizes, side = (table.column(c).to_numpy() for c in ("set_id", "component", "n", "side"))
    two = side.any()
    bits = _same_length(table.column("parts").combine_chunks())
    earlier = table.column("earlier").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    label = np.unique(comps, return_inverse=True)[1]
    step = max(1, 200_000 // max(bits.size, 1))
    held, n_held = [], 0
    found_a, found_b = [], []

    def connect() -> None:
        i, j, far = (np.concatenate(x) for x in zip(*held))
        at = _forest(i, j, far, label)
        held[:] = [(i[at], j[at], far[at])]

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        new = ~_met_before(earlier, i, j)
        i, j = ids[i[new]], ids[j[new]]
        found_a.append(np.minimum(i, j))
        found_b.append(np.maximum(i, j))

    for at in range(0, len(ids), step):
        here = slice(at, at + step)
        small, large = np.minimum(sizes[here, None], sizes), np.maximum(sizes[here, None], sizes)
        fits = (comps[here, None] != comps) & (small * 100 >= percent * large) & (ids[here, None] < ids)
        if two:
            fits &= side[here, None] != side
        if not fits.any():
            continue
        far = _far(bits[here, None], bits)
        fits &= far <= most_different(small, large, percent)
        i, j = np.nonzero(fits)
        if not closest:
            keep(i + at, j)
        elif len(i):
            held.append((i + at, j, far[i, j]))
            n_held += len(i)
            if n_held > 500_000:
                connect()
                n_held = len(held[0][0])
    if held:
        connect()
        keep(*held[0][:2])
    if found_a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], ["a", "b"])


def _same_length(lists: pa.ListArray) -> np.ndarray:
    """Bit sketches as rows of one matrix, folded to the length of the shortest."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy().view(np.uint64)
    lengths = np.diff(offsets)
    words = lengths.min()
    out = np.empty((len(lengths), words), np.uint64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        picked = values[offsets[rows][:, None] + np.arange(n)]
        out[rows] = np.bitwise_xor.reduce(picked.reshape(len(rows), n // words, words), axis=1)
    return out


def _not_excluded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs a, b (sizes n_a, n_b, bit sketches bits_a, bits_b) that _near would keep."""
    for batch in batches:
        n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        keep = np.minimum(n, m) * 100 >= percent * np.maximum(n, m)
        most = most_different(n, m, percent)
        for i in np.flatnonzero(keep):
            x, y = (np.asarray(batch.column(c)[int(i)].values).view(np.uint64) for c in ("bits_a", "bits_b"))
            words = min(len(x), len(y))
            keep[i] = _far(folded(x, words), folded(y, words)) <= most[i]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _named(rows: DataFrame) -> DataFrame:
    """Rows (word, set_id, component, size) with earlier: the set's first NAMED groups that come before this one, filled up with 0.

    Groups come in one order for all sets, by size, then word. A word 0 is never named.
    """
    own = Window.partitionBy("set_id")
    nth = F.row_number().over(own.orderBy(F.desc("size"), "word"))
    rows = rows.withColumn("nth", nth)
    first = F.when(F.col("nth") <= NAMED, F.struct("nth", "word"))
    # in the order of nth; every row takes those before it
    rows = rows.withColumn("first", F.transform(F.sort_array(F.collect_list(first).over(own)), lambda x: x["word"]))
    places = F.array(*[F.lit(k) for k in range(NAMED)])
    named = F.transform(places, lambda k: F.when(k < F.col("nth") - 1, F.get("first", k)).otherwise(F.lit(0).cast("long")))
    earlier = F.transform(named, lambda x: F.coalesce(x, F.lit(0).cast("long")))
    return rows.select("word", "set_id", "component", earlier.alias("earlier"))


def _candidates(hits: DataFrame, sets: DataFrame, percent: int, closest: bool) -> DataFrame:
    """Pairs a, b of two components to verify, from open groups; groups with the same members are compared once."""
    sizes = hits.groupBy("word").agg(
        F.count("*").alias("size"), F.min("set_id").alias("a"), F.max("set_id").alias("b"),
        F.sum(F.xxhash64("set_id").cast("decimal(20,0)")).alias("sum"),
    )
    once = settle(sizes.groupBy("sum", "size").agg(F.min("word").alias("word"), F.first("a").alias("a"), F.first("b").alias("b")), "groups")
    twos = once.filter("size = 2").select("a", "b")
    twos = twos.join(sets.toDF("a", "n_a", "bits_a"), "a").join(sets.toDF("b", "n_b", "bits_b"), "b")
    rows = hits.select("word", "set_id", "component").join(once.filter("size > 2").select("word", "size"), "word")
    rows = rows.transform(_named).join(sets, "set_id")
    near = in_blocks(rows, "word", "set_id", BLOCK).mapInArrow(
        by_group(["word", "block"], partial(_near, percent=percent, closest=closest)), "a long, b long"
    )
    return near.unionAll(twos.mapInArrow(partial(_not_excluded, percent=percent), "a long, b long")).distinct()


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs a, b whose sets hash_a and hash_b are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("hash_a"), batch.column("hash_b")):
            x, y = np.asarray(x.values), np.asarray(y.values)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def sets_of(members: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """set_id, parts: the full set of each member, from one document that has it. Texts are shuffled once."""
    owners = nodes.join(members, "set_id").groupBy("set_id").agg(F.min("doc").alias("owner")).select("owner").distinct()
    read = texts.join(owners, F.col("doc").eqNullSafe(F.col("owner")), "left_semi")
    kind = read.schema["doc"].dataType.simpleString()
    sets = read.mapInArrow(
        partial(_sets_of, with_sketch=False), f"doc {kind}, n long, set_id long, parts array<long>"
    )
    return settle(sets.filter("set_id is not null").select("set_id", "parts"), "sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b that link, decided on their full sets."""
    both = pairs.join(sets.toDF("a", "hash_a"), "a").join(sets.toDF("b", "hash_b"), "b")
    return settle(both.mapInArrow(partial(_linked, percent=percent), "a long, b long"), "links")


def _undecided(placed: DataFrame) -> DataFrame:
    """Rows (word, set_id, shared, component) that may still hide a link between two components.

    A group inside one component is settled. A set has at least ``shared`` words in common with any partner, and with
    one in another component all these are in open groups; a set in fewer of them leaves.
    """
    over = placed.groupBy("word").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    placed = settle(placed.join(over.select("word"), "word", "left_semi"), "over")
    enough = placed.groupBy("set_id").agg(F.count("*").alias("n"), F.min("shared").alias("least")).filter("n >= least")
    return settle(placed.join(enough.select("set_id"), "set_id", "left_semi"), "undecided")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Words are runs without white space, lower-cased from A to Z. Sets are compared by 64-bit hashes of their
    shingles. component_id is the smallest key that links lead to, the document's own if there are none;
    documents without words (or text) link with nothing. A null key takes part but is named by a component only when
    no other key is in it. Other columns of docs are not read.
    """
    texts = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    nodes = settle(
        texts.mapInArrow(partial(_sets_of, with_sketch=True), f"doc {kind}, n long, set_id long, parts array<long>"),
        "nodes",
    )
    index = texts.select("text").mapInArrow(partial(_index, percent=percent), "word long, set_id long, shared int")
    same = Window.partitionBy("word")
    lead, last = F.min("set_id").over(same), F.max("set_id").over(same)
    hits = index.withColumns({"lead": lead, "last": last}).filter("lead < last")
    hits = settle(hits.select("word", "set_id", "shared").distinct(), "hits")
    # every set is its own component so far
    alone = hits.withColumn("component", F.col("set_id"))
    hits = settle(_undecided(alone).select("word", "set_id", "shared", F.min("set_id").over(same).alias("lead")), "hits")
    full = sets_of(hits.select("set_id").distinct(), nodes, texts)

    # round 1: one partner each, the first set of most of its groups
    often = hits.filter("lead < set_id").groupBy("set_id", "lead").agg(F.count("*").alias("times"))
    starts = settle(often.groupBy("set_id").agg(F.max_by("lead", F.struct("times", "lead")).alias("lead")), "starts")
    links = verified(starts.select(F.col("lead").alias("a"), F.col("set_id").alias("b")), full, percent)

    sets = nodes.filter("set_id is not null").groupBy("set_id").agg(F.first("n").alias("n"), F.first("parts").alias("parts"))
    sets = settle(sets.join(hits.select("set_id").distinct(), "set_id", "left_semi"), "sketches")
    tested = starts.toDF("b", "a").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for closest in (True, False):
        reached = components(links)
        placed = hits.join(reached.withColumnRenamed("node", "set_id"), "set_id", "left").select(
            "word", "set_id", "shared", F.coalesce("component", "set_id").alias("component")
        )
        hits = _undecided(placed)
        near = settle(_candidates(hits, sets, percent, closest).join(tested, ["a", "b"], "left_anti"), "near")
        links = settle(links.unionAll(verified(near, full, percent)), "links")
        tested = tested.unionAll(near)
        hits = hits.drop("component")
    reached = components(links)
    placed = nodes.join(reached.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "doc", "n", F.coalesce("component", "set_id").alias("component")
    )
    named = placed.filter("component is not null").groupBy("component").agg(F.min("doc").alias("component_id"))
    return placed.join(named, "component", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
    )


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""


@query(OP8_SQL)
def op8_parity_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"))
