"""Removal of repeated byte strings with suffix arrays ordered by deep-shallow sorting.

Every string of ``length`` bytes is keyed by its minimizer, the smallest hash of the K-byte strings
in it. Equal strings have equal keys wherever they stand. Neighbouring strings mostly share a key, so
a document falls into runs, and a run travels as one piece of text to the bucket of its key: each string
meets all its copies in one task, though no task holds more than its share of the corpus.

In a bucket, keys of one document only are dropped. Of the pieces left, equal ones are merged; the suffixes at the
remaining window starts are sorted to find windows that different pieces share:

* shallow: multikey quicksort with eight bytes as one character, level by level on what is still tied,
  to a depth of SHALLOW bytes;
* deep: groups that are still tied and not equal throughout are ordered by blind tries, which look at
  one byte per branch on the way down and compare a suffix with a single leaf.

Suffixes with a common prefix of ``length`` bytes are one string. Its smallest document keeps it.

Before the shuffle each chunk of documents merges equal pieces: all but the one of the smallest document are known to
be copies and travel without their text, so a passage that a third of all documents share has one full piece per chunk.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.blocks import by_group
from saleswh.llm.registry import query, table
from saleswh.llm.shingles import mix
from saleswh.llm.staging import settle

LENGTH = 50
#: Bytes of the strings a minimizer is picked from, 8 to 16. Fewer make longer runs, but more chance matches.
K = 16
#: Bytes ordered by sorting; each level of eight is cheap next to the tries, which then see few suffixes.
SHALLOW = 40
CHUNK = 6 << 20
#: Compression of the pieces of a chunk that go to one bucket.
LEVEL = 3
#: Bytes of text per bucket.
BUCKET = 16 << 20
#: Bytes of pieces of a bucket that are sorted at a time.
SLICE = 4 << 20
_LAST = np.iinfo(np.int64).max


def _eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number that sorts like them; text is padded by eight."""
    out = text
    for width, kind in ((1, np.uint16), (2, np.uint32), (4, np.uint64)):
        wide = out[:-width].astype(kind)
        wide <<= kind(8 * width)
        wide |= out[width:]
        out = wide
    return out[: len(text) - 8]


def window_keys(text: np.ndarray, length: int, step: int = 1 << 19) -> np.ndarray:
    """The minimizer hash of the window of ``length`` bytes at each position, computed in slices."""
    if len(text) > step + length:
        slices = (text[at : at + step + length - 1] for at in range(0, len(text) - length + 1, step))
        return np.concatenate([window_keys(x, length, len(text)) for x in slices])
    eights = _eights(np.concatenate([text, np.zeros(8, np.uint8)]))
    hashes = mix(mix(eights[: len(text) - K + 1]) + eights[K - 8 : len(text) - 7] * np.uint64(0xD6E8FEB86659FD93))
    span, width = length - K + 1, 1
    while width * 2 <= span:
        hashes = np.minimum(hashes[:-width], hashes[width:])
        width *= 2
    rest = span - width
    return np.minimum(hashes[: len(hashes) - rest], hashes[rest:])


def _runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array, and per run: key, text number, start in the array, windows."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    if len(joined) < length:
        none = np.zeros(0, np.int64)
        return joined, none.astype(np.uint64), none, none, none
    keys = window_keys(joined, length)
    # windows that would reach into the next text; every text has one window at least
    inside = np.ones(len(joined), bool)
    for end in (begins + sizes).tolist():
        inside[end - length + 1 : end] = False
    inside = inside[: len(keys)]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    bounds = np.flatnonzero(new | ~inside)
    ends = np.append(bounds, len(keys))[np.searchsorted(bounds, starts, side="right")]
    owner = np.searchsorted(begins, starts, side="right") - 1
    return joined, keys[starts], owner, starts, ends - starts


def _gathered(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes text[start : start + size] of all pieces, one behind the other."""
    if not len(starts):
        return text[:0]
    ends = np.cumsum(sizes)
    steps = np.ones(ends[-1], np.int64)
    steps[0] = starts[0]
    steps[ends[:-1]] = starts[1:] - starts[:-1] - sizes[:-1] + 1
    return text[np.cumsum(steps, out=steps)]


def _merged(text: np.ndarray, keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each set of equal pieces, and for each piece the number of its set."""
    _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
    root = np.arange(len(keys))
    raw = text.tobytes()
    seen: dict[bytes, int] = {}
    some = np.flatnonzero(count[number] > 1)
    for i, a, n in zip(some.tolist(), starts[some].tolist(), sizes[some].tolist()):
        root[i] = seen.setdefault(raw[a : a + n], i)
    new = root == np.arange(len(root))
    return np.flatnonzero(new), (np.cumsum(new) - 1)[root]


def _cut(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """bucket, block: the runs of a chunk of documents that go to one bucket."""
    for batch in batches:
        held, size = [], 0
        rows = zip(batch.column("doc").to_pylist(), batch.column("mark").to_pylist(), batch.column("text"))
        for doc, mark, text in rows:
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            if len(raw) >= length:
                held.append((_LAST if doc is None else doc, mark, raw))
                size += len(raw)
            if size > CHUNK:
                yield from _chunk(held, length, buckets)
                held, size = [], 0
        yield from _chunk(held, length, buckets)


def _chunk(held: list[tuple[int, int, bytes]], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    import zstandard

    if not held:
        return
    # by document, so that the first of equal pieces is the one to keep
    held.sort(key=lambda x: x[:2])
    text, keys, owner, starts, windows = _runs([x[2] for x in held], length)
    docs, marks = (np.array([x[i] for x in held], np.int64) for i in (0, 1))
    begins = np.cumsum([0, *(len(x[2]) for x in held)])
    sizes = windows + length - 1
    first, back = _merged(text, keys, starts, sizes)
    copy = docs[owner] > docs[owner[first]][back]
    # pieces of the smallest document itself all stay: one with text is enough for others, but its own are judged too
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    # 32 bits of a key do inside a bucket; pieces with text come first, by key
    short = (keys >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((short, copy, bucket))
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1)).tolist()
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    numbers, blocks = [], []
    for a, b in zip(edges[:-1], edges[1:]):
        o = order[a:b]
        full = o[: b - a - int(copy[o].sum())]
        # only the documents of the block are named
        named, local = np.unique(owner[o], return_inverse=True)
        columns = [
            np.array([len(o), len(full), len(named)], np.int64), _planes(docs[named]), marks[named], _planes(local.astype(np.int32)),
            _planes((starts[o] - begins[owner[o]]).astype(np.int32)), _planes(windows[o].astype(np.int32)),
            short[full], _gathered(text, starts[full], sizes[full]),
        ]
        numbers.append(int(bucket[o[0]]))
        blocks.append(pack(b"".join(c.tobytes() for c in columns)))
        if len(blocks) == 4096:
            yield _batch(numbers, blocks)
            numbers, blocks = [], []
    if blocks:
        yield _batch(numbers, blocks)


def _batch(numbers: list[int], blocks: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], ["bucket", "block"])


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The bytes of numbers, first all lowest ones, then all next ones: small numbers compress well in this order."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T)


def _numbers(planes: np.ndarray, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).ravel()


def shallow_sort(words: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by len(words) characters of eight bytes, and the number of each one's tie group.

    words[d][s] is character d of the suffix at s.
    """
    order = np.argsort(words[0][starts])
    group = np.cumsum(np.diff(words[0][starts[order]], prepend=words[0][starts[order[:1]]]) != 0)
    for word in words[1:]:
        sizes = np.bincount(group)
        tied = np.flatnonzero(sizes[group] > 1)
        here = word[starts[order]]
        sub = np.lexsort((here[tied], group[tied]))
        order[tied] = order[tied][sub]
        here = word[starts[order]]
        new = np.zeros(len(order), bool)
        new[1:] = (group[1:] != group[:-1]) | (here[1:] != here[:-1])
        group = np.cumsum(new)
    return order, group


class BlindTrie:
    """Orders suffixes that agree up to ``depth``; suffixes equal up to ``end`` share a leaf."""

    def __init__(self, text: bytes, depth: int, end: int):
        self.text, self.depth, self.end, self.root = text, depth, end, None

    def add(self, start: int) -> None:
        """A leaf is the list of its suffixes; a branch is (depth, {byte: child})."""
        text = self.text
        if self.root is None:
            self.root = [start]
            return
        node = self.root
        while isinstance(node, tuple):
            at, children = node
            node = children.get(text[start + at]) or next(iter(children.values()))
        other = node[0]
        a, b = text[start + self.depth : start + self.end], text[other + self.depth : other + self.end]
        if a == b:
            node.append(start)
            return
        common = self.depth + next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < common:
            parent, edge = node, text[start + node[0]]
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == common:
            node[1][text[start + common]] = [start]
            return
        branch = (common, {text[other + common]: node, text[start + common]: [start]})
        if parent is None:
            self.root = branch
        else:
            parent[1][edge] = branch

    def leaves(self) -> Iterator[list[int]]:
        """Suffixes in order, equal ones together."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            elif node:
                yield node


def equal_windows(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start a number that is the same for equal strings of ``length`` bytes, in their sorted order."""
    padded = np.concatenate([text, np.zeros(length + 16, np.uint8)])
    eights = _eights(padded)
    order, group = shallow_sort([eights[d : len(text) + d] for d in range(0, min(SHALLOW, length - 7), 8)], starts)
    depth = min(SHALLOW, length - length % 8) if length >= 8 else 0
    # tied neighbours that agree in the rest as well need no trie
    rest = [*range(depth, length - 7, 8), length - 8]
    sorted_starts = starts[order]
    agree = np.zeros(len(order), bool)
    agree[1:] = group[1:] == group[:-1]
    for d in rest:
        word = eights[sorted_starts + d]
        agree[1:] &= word[1:] == word[:-1]
    new = ~agree
    out = np.empty(len(order), np.int64)
    # groups with a disagreement inside, and more than one member
    sizes = np.bincount(group)
    broken = np.bincount(group, weights=new).astype(np.int64) > 1
    raw = padded.tobytes()
    firsts = np.cumsum(sizes) - sizes
    number = np.cumsum(new)
    # of neighbours that agree throughout, the first stands for all
    heads = np.flatnonzero(new & broken[group])
    cuts = np.flatnonzero(np.diff(group[heads], prepend=-1, append=-1)).tolist()
    members = sorted_starts[heads].tolist()
    places = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        trie = BlindTrie(raw, depth, length)
        for s in members[a:b]:
            trie.add(s)
        place = {s: k for k, leaf in enumerate(trie.leaves()) for s in leaf}
        places += [place[s] for s in members[a:b]]
    # a group has at least as many numbers as leaves
    tied = np.flatnonzero(broken[group])
    if len(tied):
        run = np.searchsorted(heads, tied, side="right") - 1
        number[tied] = number[firsts[group[tied]]] + np.array(places)[run]
    out[order] = number
    return out


class _Block:
    """The pieces of a block; those with text come first, in order of their keys."""

    def __init__(self, data: bytes):
        n, full, named = np.frombuffer(data, np.int64, 3).tolist()
        at, raw = 24, np.frombuffer(data, np.uint8)
        docs = _numbers(raw[at : at + 8 * named], np.int64)
        marks = raw[at + 8 * named : at + 16 * named].view(np.int64)
        at += 16 * named
        local, self.start, self.windows = (_numbers(raw[at + 4 * n * i : at + 4 * n * (i + 1)], np.int32) for i in range(3))
        at += 12 * n
        self.full, self.doc, self.mark = full, docs[local], marks[local]
        self.keys = np.frombuffer(data, np.uint32, full, at)
        self.text = raw[at + 4 * full :]

    def rows(self, some: np.ndarray | slice) -> np.ndarray:
        """doc, mark, start, windows of pieces."""
        return np.column_stack([self.doc[some], self.mark[some], self.start[some], self.windows[some]])


def _spans(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(4)], ["doc", "mark", "start", "end"])


def _shared(keys: np.ndarray, docs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that more than one document has, sorted, and the bytes of their pieces."""
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if not len(edge):
        return keys, sizes
    several = np.maximum.reduceat(docs, edge) != np.minimum.reduceat(docs, edge)
    return keys[edge][several], np.add.reduceat(sizes[order].astype(np.int64), edge)[several]


def _repeated(table: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """doc, mark, start, end: bytes of a bucket's runs that a smaller document has in a string of ``length``.

    Blocks are unpacked twice: for the keys, since those of one document only are settled, and for the pieces of the others. These
    are sorted by ranges of keys, SLICE bytes of pieces (or one key) at a time.
    """
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    blocks = [b.as_buffer() for b in table.column("block")]
    heads = []
    for packed in blocks:
        block = _Block(unpack(packed))
        heads.append((block.keys.copy(), block.doc[: block.full].copy(), block.windows[: block.full] + np.int32(length - 1)))
        copies = block.rows(slice(block.full, None))
        copies[:, 3] += copies[:, 2] + length - 1
        if len(copies):
            yield _spans(copies)
    shared, sizes = _shared(*(np.concatenate(x) for x in zip(*heads)))
    del heads
    if not len(shared):
        return
    text = np.empty(sizes.sum(), np.uint8)
    keys, rows, filled = [], [], 0
    for packed in blocks:
        block = _Block(unpack(packed))
        some = np.flatnonzero(shared[np.minimum(np.searchsorted(shared, block.keys), len(shared) - 1)] == block.keys)
        keys.append(block.keys[some])
        rows.append(block.rows(some))
        ends = np.cumsum(block.windows[: block.full] + np.int64(length - 1))
        wide = block.windows[some] + np.int64(length - 1)
        piece = _gathered(block.text, ends[some] - wide, wide)
        text[filled : filled + len(piece)] = piece
        filled += len(piece)
    del block
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    wide = rows[:, 3] + length - 1
    places = np.cumsum(wide) - wide
    order = np.lexsort((rows[:, 0], keys))
    part = (np.cumsum(sizes) - sizes) // SLICE
    limits = shared[np.flatnonzero(np.diff(part, prepend=-1))]
    cuts = np.append(np.searchsorted(keys[order], limits), len(keys)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        o = order[a:b]
        yield _spans(_covered(keys[o], rows[o], _gathered(text, places[o], wide[o]), length))


def _covered(keys: np.ndarray, rows: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """doc, mark, start, end: spans of pieces' windows that a smaller document has.

    keys, rows (doc, mark, start, windows) and text are those of all pieces of some keys, in order of key and document.
    """
    sizes = rows[:, 3] + length - 1
    places = np.cumsum(sizes) - sizes
    # equal pieces are one, with the smallest document of them
    first, back = _merged(text, keys, places, sizes)
    windows = rows[first, 3]
    ends = np.cumsum(windows)
    starts = np.repeat(places[first] - (ends - windows), windows) + np.arange(ends[-1])
    least = np.repeat(rows[first, 0], windows)
    # a piece that alone has its key shares no window with another one
    _, number, pieces = np.unique(keys[first], return_inverse=True, return_counts=True)
    alike = np.flatnonzero(np.repeat(pieces[number] > 1, windows))
    if len(alike):
        string = equal_windows(text, starts[alike], length)
        smallest = np.full(string.max() + 1, _LAST)
        np.minimum.at(smallest, string, least[alike])
        least[alike] = smallest[string]
    # windows of a row that a smaller document has; neighbours join into spans
    rows_ends = np.cumsum(rows[:, 3])
    offset = np.arange(rows_ends[-1]) - np.repeat(rows_ends - rows[:, 3], rows[:, 3])
    gone = least[np.repeat((ends - windows)[back], rows[:, 3]) + offset] < np.repeat(rows[:, 0], rows[:, 3])
    begin = np.flatnonzero(gone & (np.append(True, ~gone[:-1]) | (offset == 0)))
    last = np.flatnonzero(gone & np.append((~gone[1:]) | (offset[1:] == 0), True))
    row = np.searchsorted(rows_ends, begin, side="right")
    return np.column_stack([
        rows[row, 0], rows[row, 1], rows[row, 2] + offset[begin], rows[row, 2] + offset[last] + length
    ])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text, starts, ends in zip(batch.column("text"), batch.column("starts"), batch.column("ends")):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            edge = np.zeros(len(raw) + 1, np.int32)
            if starts.is_valid:
                np.add.at(edge, np.asarray(starts.values), 1)
                np.add.at(edge, np.asarray(ends.values), -1)
            gone = np.cumsum(edge[:-1]) > 0
            out[0].append(len(raw))
            out[1].append(int(gone.sum()))
            out[2].append(int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0)
            out[3].append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
        digests = [hashlib.sha256(k).hexdigest() for k in out[3]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, mark, start, end of the removed bytes; rows: doc (whole number), mark, text. Spans may overlap."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(1, math.ceil(total / BUCKET)), 1 << 30)
    blocks = rows.mapInArrow(partial(_cut, length=length, buckets=buckets), "bucket int, block binary")
    dealt = blocks.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    return settle(
        dealt.mapInArrow(by_group(["bucket"], partial(_repeated, length=length)), "doc long, mark long, start long, end long"),
        "spans",
    )


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte inside a string of ``length`` bytes that also starts in a document with a smaller key. The key is a whole
    number; null counts as larger than all others, and rows of one key never remove each other's bytes. Null texts are empty;
    texts shorter than ``length`` stay whole. length is at least K + 8 bytes. Other columns are not read. No rows give no rows.
    """
    if length < K + 8:
        raise ValueError(f"length must be {K + 8} at least")
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc"), F.col(f"`{text}`").alias("text")).withColumn(
        "mark", F.xxhash64("text")
    )
    spans = repeated_spans(rows, length).groupBy("doc", "mark").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    ).withColumnsRenamed({"doc": "d", "mark": "m"})
    joined = rows.join(spans, (F.coalesce("doc", F.lit(int(_LAST))) == F.col("d")) & (F.col("mark") == F.col("m")), "left")
    return joined.select("doc", "text", "starts", "ends").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


@query()
def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))
