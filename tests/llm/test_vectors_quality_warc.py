"""Vector links, line classifier and WARC records."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswh.llm import crf_quality as Q
from saleswh.llm import warc
from saleswh.llm.cap_filters import LEAST, filter_plan, filters_of, plan_codes, vector_links


def test_vector_links(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + rng.standard_normal(16) * rng.choice([0.05, 0.3])).tolist()) for i in range(900)]
    rows += [(2000, rows[5][1]), (2001, [x * 8 for x in rows[5][1]])]
    good = len(rows)
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [nan] * 16), (3004, [inf] + [1.0] * 15), (3005, [None] + [1.0] * 15), (3006, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v, 1, 1) for k, v in rows], "vec_id long, embedding array<double>, n int, filter int")
    got = {r.vec_id: r for r in vector_links(df).collect()}
    e = np.array([v for _, v in rows[:good]])
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    linked = (e @ e.T >= 0.9) & ~np.eye(good, dtype=bool)
    found = np.array([got[k].n_links for k, _ in rows[:good]])
    assert (found <= linked.sum(axis=1)).all() and found.sum() >= 0.99 * linked.sum()
    assert got[2000].component_id == got[5].component_id == got[2001].component_id and not got[2001].kept
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(3000, 3007))


def pairs(rng, n, dims, cosine=LEAST):
    """n unit vectors, and partners at the given cosine."""
    x, z = rng.standard_normal((2, n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * z


@pytest.mark.parametrize("dims, rows", [(2, 10**6), (8, 10**6), (16, 10**5), (32, 10**6), (64, 10**4), (64, 10**6), (64, 10**8)])
def test_pairs_meet_at_any_row_count(dims, rows):
    plan = filter_plan(rows, dims)
    codes = plan_codes(dims, plan)
    n = 1000 if rows < 10**8 else 100
    missed = [not len(np.intersect1d(filters_of(a, plan, codes), filters_of(b, plan, codes))) for a, b in zip(*pairs(np.random.default_rng(3), n, dims))]
    assert np.mean(missed) <= 0.005


@pytest.mark.parametrize("rows", [1000, 8000])
def test_links_by_brute_force(spark, rows):
    """Links of a query subset against all rows; vectors of other dimensions stay apart."""
    rng = np.random.default_rng(rows)
    a, b = pairs(rng, rows // 2, 24, 0.901)
    all_rows = np.concatenate([a, b])
    odd = [(rows + i, v) for i, v in enumerate([[1.0, 0.0], [1.0, 0.1], [2.0], [3.0], [-1.0], [1.0, 0.0, 0.0], [1.0, 0.0, 0.1]])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(all_rows)] + odd, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vector_links(df).collect()}
    want = (all_rows[:500] @ all_rows.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i] for i in range(500)])
    assert (found <= want).all() and found.sum() >= 0.995 * want.sum()
    assert [got[rows + i] for i in range(7)] == [1, 1, 1, 1, 0, 1, 1]


def test_no_vectors(spark):
    assert vector_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = Q.quality_scores(docs.withColumns({"score": F.lit(1), "quality": F.lit(1)}), labels).join(labels, "doc_id")
    rows = [r for r in scored.collect() if r.held_out]
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95


def test_scores_of_odd_input(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)] + [(None, 1, 0), (5000, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = [(i, "a good line.\nanother one" if i % 2 else "B!! A!! D!!\n$$$ ###") for i in range(1, 60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "word " * 200_000), (None, "a good line.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[100] == score[101] and score[1] > 0.7 > 0.3 > score[2]
    none = Q.quality_scores(docs, labels.filter("quality = 7")).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.quality_scores(docs.filter("false"), labels).count() == 0


def test_forward_backward_like_enumeration():
    rng = np.random.default_rng(2)
    score, trans = rng.standard_normal((1, 5)), rng.standard_normal((2, 2))
    good, pairs, total = Q.forward_backward(score, np.ones((1, 5), bool), trans)
    weights, labels = [], []
    for k in range(32):
        y = [(k >> i) & 1 for i in range(5)]
        weights.append(np.exp(sum(s * v for s, v in zip(score[0], y)) + sum(trans[a, b] for a, b in zip(y, y[1:]))))
        labels.append(y)
    p = np.array(weights) / sum(weights)
    assert np.allclose(good[0], p @ np.array(labels)) and np.isclose(total[0], np.log(sum(weights)))
    assert np.isclose(pairs.sum(), 4)


@pytest.fixture
def pages(spark):
    html = (
        "<html><head><title> A &amp; B\n</title><script>var x = '<p>';</script></head><body><!-- no -->"
        '<p>One&nbsp;two &#233;&#x1F642;</p><div>3 &lt; 4 &amp;lt; &#0; &#xD800;</div><a class="x" href="/to?a=1">go</a></body></html>'
    )
    rows = [(1, "http://a.example/", html), (2, None, None), (3, "http://b.example/", "no tags"), (3, "http://b.example/", "no tags")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_derivatives(pages):
    source = warc.responses(pages)
    got = {(r.page_id, r.record_type): r for r in warc.derivatives(source.withColumn("head", F.lit("x"))).collect()}
    plain, meta = got[1, "conversion"], got[1, "metadata"]
    assert plain.block == "A & B\nOne two é🙂\n3 < 4 &lt; &#0; &#xD800;\ngo"
    assert "title: A &amp; B\r\n" in meta.block and "outlink: /to?a=1\r\n" in meta.block
    assert "http-header: Content-Type: text/html; charset=utf-8\r\n" in meta.block
    ids = {r.page_id: r.record_id for r in source.collect()}
    assert all(r.refers_to == ids[k[0]] for k, r in got.items())
    assert plain.block_digest == "sha256:" + hashlib.sha256(plain.block.encode()).hexdigest()
    assert got[2, "conversion"].block == "" and got[2, "conversion"].content_length == 0


def test_round_trip(spark, pages, tmp_path):
    records = warc.derivatives(warc.responses(pages))
    warc.write_warc(records, str(tmp_path / "w"))
    back = [(r.head["WARC-Record-ID"], r.head["WARC-Refers-To"], r.head["WARC-Source-Payload-Digest"], r.block) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()]
    want = [(r.record_id, r.refers_to, r.source_payload_digest, r.block) for r in records.collect()]
    assert sorted(back) == sorted(want)


def test_no_pages(pages):
    assert warc.derivatives(warc.responses(pages.filter("false"))).count() == 0


def test_references_like_the_standard(spark):
    """Every named reference, numbers, and what only looks like one; nothing is decoded twice."""
    import html
    from html.entities import html5

    texts = ["&" + n for n in html5 if n.endswith(";")] + ["b&#38;lt;", "&amp;amp;lt;", "&eacute;&mdash;&copy;&hellip;", "a & b &; &&lt;&", "&#233;&#xE9;&#XE9;&#x1F642;"]
    raw = ["&#0;", "&#xD800;", "&#1114112;", "&#99999999;", "&nosuch;", "&lt", "&#;", "&#x;"]
    df = spark.createDataFrame(list(enumerate(texts + raw)), "i int, t string")
    got = {r.i: r.d for r in df.select("i", warc.decoded(F.col("t")).alias("d")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == html.unescape(t), t
    assert [got[len(texts) + i] for i in range(len(raw))] == raw


def test_outlinks_in_three_forms(spark):
    html = """<a href='/one'>1</a><a class=x href=/two>2</a><A HREF = "/th'ree">3</A><a data-href="/no">x</a><a title="t" href="">e</a>"""
    source = warc.responses(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))
    (block,) = [r.block for r in warc.derivatives(source).collect() if r.record_type == "metadata"]
    assert [x[9:] for x in block.split("\r\n") if x.startswith("outlink: ")] == ["/one", "/two", "/th'ree", ""]


def test_clashing_names_and_long_pages(spark):
    page = "<p>" + "word &amp; more " * 100_000
    df = spark.createDataFrame([(1, "u", page, "x", "y", 3)], "page_id long, url string, html string, block string, head string, body int")
    got = {r.record_type: r for r in warc.derivatives(warc.responses(df).withColumns({"head": F.lit(1), "digest": F.lit("d")})).collect()}
    assert got["conversion"].block == ("word & more " * 100_000).strip()


def test_text_is_stripped_once(spark):
    """What decoding and the records name several times is worked out once; white space at line ends goes in every mix."""
    bits = [" ", "\n", "\t", "x", "&amp;"]
    texts = ["".join(t) for n in range(5) for t in itertools.product(bits, repeat=n)] + ["<p>a \u00a0<br/> \r b</p> \n\n c<script>x</script>"]
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    found = warc.derivatives(warc.responses(pages))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("</(?:script|style") == 1
    got = {r.page_id: r.block for r in found.collect() if r.record_type == "conversion"}
    for i, t in enumerate(texts[:-1]):
        words = re.sub(r"[ \t]+", " ", t.replace("&amp;", "&"))
        assert got[i] == re.sub(r"(?: ?\n)+ ?", "\n", words).strip("\n").strip(" "), t
    assert got[len(texts) - 1] == "a\nb\nc"
