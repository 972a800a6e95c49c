import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswh.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [
    None, "", " ", "\n\n \t x", "it's we'll DON'T", "naïve 東京 🙂🙂", "a  b \x1c\x85c  ", "<|endoftext|>",
    "ab" * 700 + "z" * 900, "tok " * 500, "x1y22 333\r\n...!?", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa " * 3,
]


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return ids, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("most", [0, 4, 1 << 16])
def test_like_the_library(spark, most):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS + TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in bpe.encode_decode(docs, PATH, PATTERN, most=most, with_ids=True).collect()}
    for i, t, _ in rows:
        ids, digest = expected(t)
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].ids_sha256 == digest, repr(t)
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_fold_and_decode_by_columns(spark):
    words = [w for t in TEXTS for w in bpe.Codec(RANKS, {}, PATTERN).split(t or "") if len(w) < 100]
    df = spark.createDataFrame([(w,) for w in set(words)], "word string")
    coded = df.select("word", bpe.folded_codes(F.col("word"), RANKS).alias("ids"))
    for r in bpe.decode(coded, PATH).collect():
        assert r.ids == LIBRARY.encode_ordinary(r.word) and bytes(r.decoded) == r.word.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_any_text(text):
    codec = bpe.Codec(RANKS, {}, PATTERN)
    ids = codec.encode(text.encode("utf-8", "ignore").decode())
    assert ids == LIBRARY.encode_ordinary(text.encode("utf-8", "ignore").decode())


@settings(max_examples=50, deadline=None)
@given(st.text("abcé", min_size=65, max_size=400))
def test_heap_equals_scan(word):
    raw = word.encode()
    assert bpe._heap_codes(raw, RANKS) == tuple(LIBRARY.encode_ordinary(word))


def test_no_rows(spark):
    assert bpe.encode_decode(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).count() == 0


def test_ranks_are_planned_once(spark, monkeypatch):
    """The statement that names all ranks has no shuffle, after which it would be planned and described anew."""
    from pyspark.sql.classic.dataframe import DataFrame

    plans, to_arrow = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), to_arrow(df))[1])
    texts = spark.createDataFrame([(t,) for t in TEXTS + TEXTS], "text string")
    found = bpe.frequent_codes(texts, RANKS, PATTERN)
    assert len(plans) == 1 and "Exchange" not in plans[0] and "AdaptiveSparkPlan" not in plans[0]
    assert found and all(codes == tuple(LIBRARY.encode_ordinary(word)) for word, codes in found.items())
