"""The threshold table against a plain version."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from saleswh.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if re.search(Q.HAS_WORD, s)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    n, rep = len(words), len(covered)
    c = {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(s) for s in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": rep, "n_lines": len(lines),
        "n_stop_words": sum(w.lower().strip(Q.MARKS) in Q.STOP_WORDS for w in words),
        "n_letter_words": sum(any(x.isalpha() for x in w) for w in words),
        "n_capital_words": sum(len(w) > 1 and any(x.isupper() for x in w) and not any(x.islower() for x in w) for w in words),
        "n_bullet_lines": sum(s.lstrip(" \t")[:1] in tuple("-*•‣") for s in lines),
        "n_ellipsis_lines": sum(s.rstrip(" \t\r").endswith(("...", "…")) for s in lines),
    }
    failed = [
        r.name for r in Q.RULES
        if (r.low is not None and c[r.part] < r.low * c[r.whole]) or (r.high is not None and c[r.part] > r.high * c[r.whole])
    ]
    base = n < 20 or 100 * rep > 30 * n
    return (*[c[k] for k in Q.BASE_COUNTS], base, not base and not failed, ",".join(failed))


def check(spark, texts):
    df = spark.createDataFrame(
        [(i, t, 1, "x", 2) for i, t in enumerate(texts)], "doc_id long, text string, n_words int, counts string, failed int"
    )
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (*[r[k] for k in Q.BASE_COUNTS], r.base_failed, r.kept, r.failed) == plain(t), (i, (t or "")[:80])
    return got


def test_like_the_plain_version(spark):
    rng = random.Random(5)
    few = "the of and a is".split()
    many = few + "Wort naïve ERSTE ## a*b … ... - • ß É 12 (the) \x00 日本 𝒳".split()
    texts = []
    for vocabulary, n in [(few[:1], 30), (few[:2], 60), (few, 200), (many, 40), (many, 400)]:
        for _ in range(40):
            words = rng.choices(vocabulary, k=rng.randrange(n))
            texts.append("".join(w + rng.choice([" ", " ", "\n", "\t", "  ", "\n\n", " \r\n", "\x0b", "\xa0"]) for w in words))
    passage = " ".join(f"w{i}" for i in range(25))
    texts += [f"{passage} x {passage}", f"{passage}\n{passage}\n{passage}", passage, " " + passage, "a b c d e f g h a b c d e f g h"]
    check(spark, texts)


def test_odd_texts(spark):
    long = " ".join(f"the {i}" for i in range(60_000)) + " the 1 the 2 the 3 the 4 the 5"
    got = check(spark, [None, "", " \n\t", "word", "\n".join(["- the one and the other"] * 30), long, "x" * 300_000, "!" * 50])
    assert got[0].base_failed and not got[0].kept and got[0].mean_word_length is None
    # the last ten words repeat the run that starts at "the 1", and "the" before "the 1" is no part of it
    assert got[5].n_repeat_words == 20


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Windows that share a hash count as equal only when their words are."""
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    passage = " ".join(f"w{i}" for i in range(12))
    check(spark, [f"{passage} and {passage}", " ".join(f"w{i}" for i in range(40)), "a b " * 20])


@pytest.mark.parametrize("key", ["doc_id", "a.b"])
def test_keys_and_repeats(spark, key):
    text = "this is the good old text of a page that has some more words than it would need to pass"
    rows = [(1, text), (1, text), (None, text), (None, None)]
    df = spark.createDataFrame(rows, f"`{key}` long, text string")
    got = sorted((r.doc_id is None, r.kept) for r in Q.quality_rules(df, key=key).collect())
    assert got == [(False, True)] * 2 + [(True, False), (True, True)]
    assert Q.quality_rules(df.filter("false"), key=key).count() == 0


def test_one_projection_without_user_functions(spark):
    df = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, lang string")
    plan = Q.quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
