"""The stages on a small corpus with planted cases."""

import random

import pytest

import corpus_pipeline as P
from saleswh.storage import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    words = [f"wort{i}" for i in range(300)]
    base = " ".join(rng.choice(words) for _ in range(400))
    rows += [(9001, base, "en", "src1", len(base)), (9002, base + " and", "en", "src2", 0), (9003, None, None, None, None), (9004, "", "en", "src1", 0)]
    now, found = stage(spark.createDataFrame(rows, docs.schema), "docs"), []
    for name, step in P.STAGES:
        after = stage(step(spark, now, SF), name.replace(" ", "-"))
        found.append((now, after))
        now = after
    return found


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and 0 < after.count()


def test_rejected_documents_go(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in stages[0][1].collect()}
    good, bad = [k in left for k, q in labels.items() if q == 1], [k in left for k, q in labels.items() if q == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_one_near_copy_stays(stages):
    before, after = ({r.doc_id for r in df.select("doc_id").collect()} for df in stages[2])
    if {9001, 9002} <= before:
        assert 9001 in after and 9002 not in after


def test_copies_are_encoded(stages):
    mixed, coded = stages[4]
    assert mixed.count() == coded.count() and coded.filter("n_tokens > 0").count() > 0


def text_rows(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_quality_like_the_scores(spark, stages):
    """What stays are the rows whose score passes, unchanged."""
    from saleswh.llm.crf_quality import quality_scores

    before, after = stages[0]
    good = {r.doc_id for r in quality_scores(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    assert text_rows(after) == sorted([(k, t) for k, t in text_rows(before) if k in good], key=repr)


def test_line_dedup_like_a_plain_version(stages):
    """Runs of two lines, and single lines of 50 words, that stand earlier (by doc_id) are deleted."""
    before, after = stages[1]
    seen_two, seen_one, want = set(), set(), []
    for key, text in sorted((r.doc_id, r.text) for r in before.filter("doc_id is not null").collect()):
        lines = (text or "").split("\n") if text else []
        gone = set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            if pair in seen_two:
                gone |= {i, i + 1}
            seen_two.add(pair)
        for i, line in enumerate(lines):
            if len(line.split()) >= 50 and line in seen_one:
                gone.add(i)
            seen_one.add(line)
        kept = [line for i, line in enumerate(lines) if i not in gone]
        if kept or not lines:
            want.append((key, "\n".join(kept) if gone else text))
    got = [(k, t) for k, t in text_rows(after) if k is not None]
    assert len(got) == len(want)
    same = sum(a == b for a, b in zip(sorted(got, key=repr), sorted(want, key=repr)))
    assert same >= 0.99 * len(want)


def test_near_dedup_like_a_plain_version(stages):
    from test_dedup_and_mix import brute_jaccard

    before, after = stages[2]
    rows = [(r.doc_id, r.text, "") for r in before.collect()]
    kept = {k for k, _, component in brute_jaccard(rows, 80) if k == component}
    assert text_rows(after) == sorted({(k, t) for k, t, _ in rows if k in kept}, key=repr)


def test_mix_like_its_operator(stages):
    from collections import Counter

    from saleswh.llm.pareto_mix import pareto_mix

    before, after = stages[3]
    want = {r.doc_id: r.copies for r in pareto_mix(before).collect() if r.copies}
    assert Counter(r.doc_id for r in after.collect()) == want


def test_encode_like_the_tokenizer(stages):
    import hashlib

    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    mixed, coded = stages[4]
    want = []
    for r in mixed.collect():
        ids = coder.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in coded.collect()) == sorted(want)
