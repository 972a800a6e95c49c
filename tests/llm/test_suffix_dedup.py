import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswh.llm import suffix_dedup as S


def brute(rows, length):
    seen = {}
    for key, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            k = float("inf") if key is None else key
            seen[w] = min(seen.get(w, k), k)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        k = float("inf") if key is None else key
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] < k:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(30, 160))) for _ in range(12)]
    rows = [(None, passages[0] * 2), (3, None), (5, ""), (7, "x" * 300), (8, "y" + "x" * 120), (9, passages[1]), (9, passages[1]), (9, passages[2] * 2)]
    for i in range(10, 70):
        parts = [rng.choice(passages) if rng.random() < 0.6 else str(rng.random()) * 3 for _ in range(rng.randint(1, 5))]
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,chunk,bucket,piece", [(1, 1 << 20, 1 << 20, 1 << 20), (2, 300, 2000, 700), (3, 1, 500, 1)])
def test_like_brute_force(spark, monkeypatch, seed, chunk, bucket, piece):
    monkeypatch.setattr(S, "SLICE", piece)
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "BUCKET", bucket)
    rows = corpus(seed)
    docs = spark.createDataFrame([(k, t, "m") for k, t in rows], "doc_id long, text string, mark string").repartition(3)
    got = sorted((tuple(r) for r in S.suffix_dedup(docs).collect()), key=repr)
    assert got == brute(rows, S.LENGTH)


def test_named_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in S.op9_suffix_dedup(spark, sf).collect()), key=repr)
    assert got == brute(rows, 50)


def test_windows_in_sorted_order():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    text[1000:1500] = text[:500]
    text[2000:2100] = 97
    starts = rng.permutation(3900)
    number = S.equal_windows(text, starts, 50)
    strings = [text[s : s + 50].tobytes() for s in starts]
    by_number = [strings[i] for i in np.argsort(number, kind="stable")]
    assert by_number == sorted(strings)
    assert len(set(zip(number.tolist(), strings))) == len(set(strings)) == len(set(number.tolist()))


def test_no_rows(spark):
    assert S.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_do_not_grow_with_the_buckets():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    held = [(i, rng.getrandbits(63), " ".join(rng.choices(words, k=rng.randint(20, 400))).encode()) for i in range(1500)]

    def size(buckets):
        return sum(len(b) for part in S._chunk(list(held), S.LENGTH, buckets) for b in part.column("block").to_pylist())

    few, many, very_many = size(42), size(2_500), size(25_000)
    assert many < 1.5 * few
    # a block names its own documents, so the most is a block for each piece
    assert very_many < 2.5 * few


def test_very_long_text_beside_its_copy(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, long), (2, "x" + long[1000:300_000] + "y"), (3, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in S.suffix_dedup(docs).collect()}
    assert got == {1: (0, 0), 2: (299_000, 1), 3: (400_000, 1)}
