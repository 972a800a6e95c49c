"""Byte-level BPE encoding and decoding of whole texts.

Distinct words are encoded by Spark higher-order functions: a word becomes an array of its bytes, and a fold
merges the neighbours with the lowest rank until no pair is left. Ranks are a literal: an array of
small maps, picked by the CRC-32 of the merged bytes, so that a look-up does not walk through 50,000 entries.

Counts over all documents pick which words the fold is given: all those with at least 2^k occurrences, with k
as small as ``FREQUENT`` words allow. Their codes are broadcast (a bound by this parameter), and
one Arrow pass applies them to the texts. Words outside this dictionary, a few per cent of all, are merged in that
pass, since shuffling them by word and back by document would move more data than the texts hold
and the fold needs some 85 microseconds a word (see README). Long words take a heap, so time does not grow with the square of
their length.

Decoding looks up the bytes of every ID and concatenates them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table
from saleswh.llm.staging import collect_garbage, settle
from saleswh.storage import stage

#: Most words whose codes are broadcast, and most bytes of one of them.
FREQUENT = 1 << 16
FREQUENT_BYTES = 64
#: Words that a task remembers besides.
REMEMBERED = 400_000
_MAPS = 4096
_NONE = 1 << 30
#: Characters with the property White_Space.
_WHITE = "".join(f"\\u{c:04X}" for c in [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def plain_pattern(pattern: str) -> str:
    """The splitting pattern with its white-space classes written out, so that every engine means the same."""
    return (
        pattern.replace(r"[^\s", "[^" + _WHITE).replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]")
    )


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file; the file is read by the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _rank_literal(ranks: dict[bytes, int]) -> Column:
    maps: list[dict[str, int]] = [{} for _ in range(_MAPS)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % _MAPS][token.hex().upper()] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def folded_codes(word: Column, ranks: dict[bytes, int]) -> Column:
    """IDs of a word (not empty): the fold over its bytes. The plan names the rank literal once."""
    return _let(_rank_literal(ranks), lambda maps: _folded(word, maps))


def _folded(word: Column, maps: Column) -> Column:
    none = F.lit(_NONE)

    def rank(token: Column) -> Column:
        return F.try_element_at(F.element_at(maps, (F.crc32(token) % _MAPS + 1).cast("int")), F.hex(token))

    def pair(a: Column, b: Column) -> Column:
        return F.coalesce(rank(F.concat(a, b)), none)

    def merge_at(acc: Column, p: Column) -> Column:
        parts, near = acc["parts"], acc["near"]
        empty = F.array().cast("array<int>")

        def merged(token: Column) -> Column:
            before = F.concat(
                F.slice(near, F.lit(1), p - 2), F.array(pair(F.element_at(parts, F.greatest(p - 1, F.lit(1))), token))
            )
            after = F.concat(
                F.array(pair(token, F.element_at(parts, F.least(p + 2, F.size(parts))))), F.slice(near, p + 2, F.size(near))
            )
            return F.struct(
                F.concat(F.slice(parts, F.lit(1), p - 1), F.array(token), F.slice(parts, p + 2, F.size(parts))).alias("parts"),
                F.concat(F.when(p > 1, before).otherwise(empty), F.when(p + 2 <= F.size(parts), after).otherwise(empty)).alias("near"),
            )

        return _let(F.concat(F.element_at(parts, p), F.element_at(parts, p + 1)), merged)

    def step(acc: Column, _: Column) -> Column:
        def lowest(least: Column) -> Column:
            at = F.array_position(acc["near"], least).cast("int")
            return F.when(least < none, _let(at, lambda p: merge_at(acc, p))).otherwise(acc)

        return F.when(F.size(acc["near"]) > 0, _let(F.array_min(acc["near"]), lowest)).otherwise(acc)

    raw = word.cast("binary")
    size = F.octet_length(word)
    parts = F.transform(F.sequence(F.lit(1), size), lambda i: raw.substr(i, F.lit(1)))
    start = _let(parts, lambda p: F.struct(
        p.alias("parts"),
        F.transform(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda x, i: pair(F.element_at(p, i + 1), x)).alias("near"),
    ))
    steps = F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1)))
    folded = F.transform(F.aggregate(steps, start, step, lambda acc: acc["parts"]), rank)
    # a word that is a token is not split, whatever the merges would give
    return _let(rank(raw), lambda r: F.when(r.isNotNull(), F.array(r)).otherwise(folded))


def frequent_codes(texts: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = FREQUENT) -> dict[str, tuple[int, ...]]:
    """Codes of at most ``most`` words: those with the most occurrences, counted over all texts."""
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(plain_pattern(pattern)), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    short = (F.octet_length("word") <= FREQUENT_BYTES) & (F.col("word") != "")
    counts = settle(counts.filter((F.col("n") > 1) & short).withColumn("level", F.floor(F.log2("n"))), "words")
    left, least = most, 64
    for level in sorted(counts.groupBy("level").count().collect(), reverse=True):
        left -= level["count"]
        if left < 0:
            break
        least = level["level"]
    spark = texts.sparkSession
    chosen = counts.filter(F.col("level") >= least).select("word").repartition(spark.sparkContext.defaultParallelism)
    # the ranks make a plan of megabytes: without a shuffle it is planned and described once; Arrow's form is small beside rows
    found = stage(chosen, "chosen").select("word", folded_codes(F.col("word"), ranks).alias("ids")).toArrow()
    collect_garbage(spark)
    return {word.as_py(): tuple(ids.as_py()) for word, ids in zip(found["word"], found["ids"])}


def merged_codes(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """IDs of one word: the lowest-ranked neighbours merge first, of equal ranks the leftmost."""
    if word in ranks:
        return (ranks[word],)
    if len(word) <= FREQUENT_BYTES:
        parts = [word[i : i + 1] for i in range(len(word))]
        near = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while near and (least := min(near)) < _NONE:
            i = near.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i:
                near[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
            if i < len(near):
                near[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        return tuple(ranks[p] for p in parts)
    return _heap_codes(word, ranks)


def _heap_codes(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same by a heap of pairs over a linked list of [start, end) pieces."""
    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if end[i] != mid or mid >= n or end[mid] != stop:
            continue
        end[i], end[mid] = stop, -1
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        if (j := before[i]) >= 0 and (r := ranks.get(word[j:stop])) is not None:
            heapq.heappush(heap, (r, j, i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return tuple(out)


class Codec:
    """Encodes and decodes in one task: the broadcast dictionary, and what the task has met besides."""

    def __init__(self, ranks: dict[bytes, int], frequent: dict[str, tuple[int, ...]], pattern: str):
        import regex

        self.ranks, self.frequent = ranks, frequent
        self.split = regex.compile(plain_pattern(pattern)).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known = dict(frequent)

    def encode(self, text: str) -> list[int]:
        known, out = self.known, []
        if len(known) > len(self.frequent) + REMEMBERED:
            known = self.known = dict(self.frequent)
        for word in self.split(text):
            codes = known.get(word)
            if codes is None:
                codes = known[word] = merged_codes(word.encode(), self.ranks)
            out += codes
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _coded(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(*shared.value)
            sizes, id_digests, digests, lists = [], [], [], []
            for text in batch.column("text"):
                ids = codec.encode(text.as_py() or "")
                sizes.append(len(ids))
                id_digests.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                digests.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(ids)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(id_digests, pa.string()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_decode(
    docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
    most: int = FREQUENT, with_ids: bool = False,
) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for.

    Whole texts are encoded, null as empty; special tokens are ordinary text. Other columns are not read. No rows give no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ranks = read_ranks(vocabulary)
    frequent = frequent_codes(rows.select("text"), ranks, pattern, most)
    shared = rows.sparkSession.sparkContext.broadcast((ranks, frequent, pattern))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_coded(shared, with_ids), schema)


def decode(coded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """coded with ``decoded`` (binary): the bytes of all IDs, by column functions and a literal of all tokens."""
    tokens = {rank: token.hex() for token, rank in read_ranks(vocabulary).items()}
    pieces = F.from_json(F.lit(json.dumps([tokens.get(i) for i in range(max(tokens) + 1)])), "array<string>")
    return coded.withColumn("decoded", F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(pieces, i + 1)), "")))


@query()
def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
