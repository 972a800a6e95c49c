"""Exact dedup, line runs, Jaccard join and mixing: nulls, ties, repeats, empty tables, clashing names."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswh.llm.exact_dedup import exact_dedup
from saleswh.llm import line_runs as LR
from saleswh.llm.line_runs import dedup_lines
from saleswh.llm.pareto_mix import pareto_mix
from saleswh.llm import parity_join as PJ
from saleswh.llm.parity_join import bands, jaccard_join, most_different, word_count, words_of
from saleswh.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, source string, digest string, n long, row string"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, s, "x", 1, "y") for k, t, s in rows], SCHEMA)


@pytest.mark.parametrize("heavy", [2, 1000])
def test_exact_dedup(spark, heavy):
    rows = [(i, "hot  text" if i % 2 else "hot\ttext", "a") for i in range(40)]
    rows += [(50, None, "a"), (51, "", "a"), (52, "one", "a"), (52, "one", "a"), (None, "one", "a"), (None, "alone", None)]
    got = [tuple(r)[:4] for r in exact_dedup(docs(spark, rows), heavy=heavy, counters=64).collect()]
    assert sorted(r[0] for r in got if r[0] is not None and r[0] < 50) == list(range(40))
    assert all(r[1:] == (0, 40, r[0] == 0) for r in got if r[0] is not None and r[0] < 50)
    rest = sorted((r for r in got if r[0] is None or r[0] >= 50), key=repr)
    assert rest == sorted([
        (50, 50, 2, True), (51, 50, 2, False), (52, 52, 3, True), (52, 52, 3, False), (None, 52, 3, False), (None, None, 1, True),
    ], key=repr)


def brute_lines(rows, m, words):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, single, out = set(), set(), {}
    for i in order:
        lines = (rows[i][1] or "").split("\n")
        at = [k for k, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        body = [lines[k].strip(" \t\n\v\f\r") for k in at]
        gone = set()
        for p in range(len(body)):
            if (w := tuple(body[p : p + m])) and len(w) == m:
                if w in seen:
                    gone |= set(range(p, p + m))
                seen.add(w)
            if body[p] in single and len(body[p].split()) >= words:
                gone.add(p)
            single.add(body[p])
        drop = {at[p] for p in gone}
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in drop), len(body), len(gone), sum(p - 1 not in gone for p in gone))
    return [out[i] for i in range(len(rows))]


@pytest.mark.parametrize("seed,m", [(1, 2), (2, 3), (3, 1), (4, 4)])
def test_line_runs(spark, seed, m):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(9)] + ["", "  ", " line 1 ", "long " * 60]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14))), "s") for i in range(40)]
    rows += [(100, "", "s"), (None, "line 1\nline 2\nline 3\nline 4", "s"), (101, "\n\n", "s")]
    got = {r.row.doc_id: (r.kept_text, r.n_lines, r.n_removed, r.n_runs) for r in dedup_lines(docs(spark, rows), min_lines=m).collect()}
    for (key, _, _), want in zip(rows, brute_lines(rows, m, 50)):
        assert got[key] == want, key


def test_line_runs_of_null_and_repeated_rows(spark):
    rows = [(1, None, "s"), (2, "a\nb", "s"), (2, "a\nb", "s"), (3, "a\nb", "s")]
    got = sorted((r.row.doc_id, r.kept_text, r.n_removed) for r in dedup_lines(docs(spark, rows)).collect() if r.row.text)
    assert got == [(2, "a\nb", 0), (2, "a\nb", 0), (3, "", 2)]


def brute_jaccard(rows, percent):
    sets = []
    for _, text, _ in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, (key, _, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), float("inf")), float("inf") if key is None else key)
    return sorted((k, len(s), None if best[find(i)] == float("inf") else best[find(i)]) for i, ((k, _, _), s) in enumerate(zip(rows, sets)) if k is not None)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 6, 12, 40, 150, 600]))] for _ in range(12)]
    rows = [(1000, None, "s"), (1001, " \n", "s"), (1002, "One two", "s"), (1003, "oNE  TWO", "s"), (1004, "É a b c d e", "s"), (1005, "é a b c d e", "s")]
    for i in range(150):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, max(1, len(text) // 25))):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text), "s"))
    rows += [(7, rows[-1][1], "s"), (None, rows[-1][1], "s")]
    got = jaccard_join(docs(spark, rows).withColumns({"word": F.lit(1), "set_id": F.lit(2)})).filter("doc_id is not null")
    assert sorted(tuple(r) for r in got.collect()) == brute_jaccard(rows, 80)


def test_pairs_are_named_once_not_by_every_word(spark, monkeypatch, tmp_path):
    """Near copies that share many words: the rows made by comparing groups do not grow with the number of shared words."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(220)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randint(1, 9)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(text), "s"))
    plain = PJ.by_group

    def counting(keys, each):
        run = plain(keys, each)

        def counted(batches):
            for nth, batch in enumerate(run(batches)):
                (tmp_path / f"{uuid.uuid4().hex}-{nth}").write_text(" ".join(f"{a}_{b}" for a, b in zip(*batch.to_pydict().values())))
                yield batch

        return counted

    monkeypatch.setattr(PJ, "by_group", counting)
    got = jaccard_join(docs(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute_jaccard(rows, 80)
    made = [pair for path in tmp_path.iterdir() for pair in path.read_text().split()]
    assert made and len(made) <= 2 * len(set(made))


def forest_by_hand(pairs, label):
    """Kruskal's way: distances of the pairs that connect two parts, nearest first, and the parts."""
    label, used = list(label), []
    for far, i, j in sorted(pairs):
        if label[i] != label[j]:
            used.append(far)
            label = [label[j] if x == label[i] else x for x in label]
    return used, label


@pytest.mark.parametrize("seed", range(6))
def test_forest_connects_labels_at_least_distances(seed):
    rng = np.random.default_rng(seed)
    n = 40
    label = rng.integers(0, n if seed % 2 else 12, n)
    pairs = [(int(rng.integers(0, 6)), i, j) for i in range(n) for j in range(i) if rng.random() < (0.03, 0.1, 0.5)[seed % 3]]
    far, i, j = (np.array([p[k] for p in pairs]) for k in range(3))
    at = PJ._forest(i, j, far, np.unique(label, return_inverse=True)[1])
    want, parts = forest_by_hand(pairs, label)
    assert sorted(far[at].tolist()) == want
    _, found = forest_by_hand([pairs[k] for k in at], label)
    same = lambda x: [[a == b for b in x] for a in x]
    assert same(found) == same(parts)


@pytest.mark.parametrize("block", [2000, 20])
def test_jaccard_join_of_chains(spark, monkeypatch, block):
    """Long chains of links, their ends far apart, beside texts just below the bound, also in groups of many blocks."""
    monkeypatch.setattr(PJ, "BLOCK", block)
    rng = random.Random(8)
    rows = []
    for chain in range(3):
        text = [f"c{chain}w{i}" for i in range(80)]
        for _ in range(30):
            rows.append((len(rows), " ".join(text), "s"))
            for _ in range(rng.choice([1, 1, 2, 3])):
                text[rng.randrange(len(text))] = f"y{rng.randrange(10**9)}"
    rng.shuffle(rows)
    assert sorted(tuple(r) for r in jaccard_join(docs(spark, rows)).collect()) == brute_jaccard(rows, 80)


def test_bands_cover_all_partners():
    for n in range(1, 3000, 7):
        for m in range((n * 4 + 4) // 5, n + 1):
            low, beyond = next((a, b) for a, b in bands(n) if a <= m < b)
            assert (beyond - 1) * 100 >= 80 * n
            assert most_different(m, n, 80) <= most_different(beyond - 1, (beyond - 1) * 100 // 80, 80)


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(["a", "b", "é", None])) for i in range(3000)]
    rows += [(i, "v", "tiny") for i in range(4000, 4003)] + [(5000, None, "void")]
    first = pareto_mix(docs(spark, rows)).collect()
    again = pareto_mix(docs(spark, rows[::-1])).collect()
    assert sorted(first, key=repr) == sorted(again, key=repr) and len(first) == len(rows)
    source = {k: s for k, _, s in rows}
    taken, target, size = {}, {}, {}
    for r in first:
        s = source[r.doc_id]
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s], size[s] = r.target, r.source_size
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6 and size["void"] == 0
    assert target["tiny"] == 9 and taken["tiny"] == 9
    assert all(abs(taken[s] - target[s]) <= 300 for s in target)


def test_no_rows(spark):
    none = docs(spark, [])
    for found in (exact_dedup(none), dedup_lines(none), jaccard_join(none), pareto_mix(none)):
        assert found.count() == 0


def test_added_shingle_beside_few_words(spark):
    """A set that fills too few words to promise one, beside a partner with one shingle more."""
    rng = random.Random(4)
    while True:
        words = [f"w{rng.randrange(10**9)}" for _ in range(11)]
        pair = [" ".join(words[:-1]), " ".join(words)]
        (a, shared), (b, _) = (words_of(x, 6, 9, 80) for x in shingle_sets(pair))
        count, most = word_count(6, 9, 80)
        if len(a) != count - most and shared == 1 and len(set(a.tolist()) & set(b.tolist())) < 4:
            break
    assert shared <= len(set(a.tolist()) & set(b.tolist()))
    got = {r.doc_id: r.component_id for r in jaccard_join(docs(spark, [(i, x, "a") for i, x in enumerate(pair)])).collect()}
    assert got == {0: 0, 1: 0}


def linked_pairs(rng, n, times):
    """Sets of n shingles and partners at the least similarity that links."""
    for _ in range(times):
        more = int(rng.integers(0, n // 4 + 1))
        b_size = n + more
        gone = max(g for g in range(n) if g == 0 or 100 * (n - g) >= 80 * (n + b_size - (n - g)))
        pool = rng.integers(0, 2**63, n + b_size).astype(np.uint64)
        yield np.sort(pool[:n]), np.sort(np.concatenate([pool[gone:n], pool[n : n + b_size - (n - gone)]]))


@pytest.mark.parametrize("cut", [0, 3])
def test_linked_sets_meet(monkeypatch, cut):
    """Every linked pair shares as many keys as both sets promise, also when words are too few (cut) and prefixes must do."""
    if cut:
        plain = PJ.slack
        monkeypatch.setattr(PJ, "slack", lambda n, most: plain(n, most) // cut)
        word_count.cache_clear()
    rng = np.random.default_rng(6)
    short = 0
    for n in (1, 2, 5, 6, 8, 11, 17, 30, 64, 150, 228, 364, 600, 1000, 3000):
        for a, b in linked_pairs(rng, n, 60 if n < 500 else 8):
            low, beyond = next(band for band in bands(n) if band[0] <= n < band[1])
            (x, promised_a), (y, promised_b) = (words_of(s, low, beyond, 80) for s in (a, b))
            met = len(np.intersect1d(x, y))
            assert met >= max(promised_a, promised_b) >= 1
            short += promised_a == promised_b == 1
    word_count.cache_clear()
    assert not cut or short > 50


def test_empty_words_have_no_key():
    """Sets without a common shingle share no key, at the lower ends of the bands too."""
    rng = np.random.default_rng(7)
    for n in (6, 20, 142, 228, 364, 583, 933):
        low, beyond = next(band for band in bands(n) if band[0] <= n < band[1])
        keys = [words_of(np.sort(rng.integers(0, 2**63, n).astype(np.uint64)), low, beyond, 80)[0] for _ in range(30)]
        assert len(np.unique(np.concatenate(keys))) == sum(len(np.unique(k)) for k in keys)


def test_mix_of_repeated_keys_reruns_alike(spark):
    """Rows that share a key and so a draw, in other sizes: the same rows are taken whatever their order."""
    rng = random.Random(8)
    rows = [(rng.randrange(60), "w " * rng.randrange(1, 90), "one") for _ in range(2000)]
    found = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: len(r[1]))):
        got = pareto_mix(docs(spark, order).repartition(5), seed=3).select("doc_id", "size", "taken").collect()
        found.append(sorted(map(tuple, got)))
    assert found[0] == found[1] == found[2]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "a b", "s"), (2, "a  b", "s")], "`a.b` long, `c.d` string, `e.f` string")
    assert [r.kept for r in exact_dedup(df, "a.b", "c.d").orderBy("doc_id").collect()] == [True, False]
    assert sorted(r.size for r in pareto_mix(df, "a.b", "c.d", "e.f").collect()) == [2, 2]


def test_line_runs_of_long_blank_stretches(spark):
    wide = "a" + " " * 200_000 + "b"
    rows = [(1, f"{wide}\n\t x \x0b\r\nonce"), (2, f"  {wide}\nx\nother"), (3, " " * 200_000 + "\n" * 20_000)]
    got = {r.row.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_lines, got[1].n_removed) == (3, 0)
    assert (got[2].n_lines, got[2].n_removed, got[2].n_runs, got[2].kept_text) == (3, 2, 1, "other")
    assert (got[3].n_lines, got[3].n_removed, got[3].kept_text) == (0, 0, rows[2][1])


@pytest.mark.parametrize("m", [2, 3, 5])
def test_line_runs_write_each_table_once_and_none_after_the_last_round(spark, monkeypatch, m):
    written = []
    monkeypatch.setattr(LR, "settle", lambda df, label, f=LR.settle: written.append(label) or f(df, label))
    rows = [(1, "a\nb\nc\nd\ne\nf", "s"), (2, "x\na\nb\nc\nd\ne\ny", "s")]
    got = {r.row.doc_id: r.kept_text for r in dedup_lines(docs(spark, rows), min_lines=m).collect()}
    assert got == {1: rows[0][1], 2: "x\ny"}
    assert written == ["lines", "tied"] + ["tied"] * {2: 0, 3: 1, 5: 2}[m]


def test_line_runs_split_a_long_text_once(spark):
    n = 20_000
    body = "\n".join(f"line {i // 2} {i % 2}" for i in range(n))
    keep = "\n".join(f"other {i}" for i in range(n))
    found = dedup_lines(docs(spark, [(1, body, "s"), (2, f"{keep}\n{body}\n\nend", "s")]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at(split(" not in plan  # would split the whole text again for every line that stays
    got = {r.row.doc_id: r for r in found.collect()}
    assert (got[2].kept_text, got[2].n_lines, got[2].n_removed, got[2].n_runs) == (f"{keep}\n\nend", 2 * n + 1, n, 1)
    assert (got[1].kept_text, got[1].n_removed) == (body, 0)


def test_long_lines_and_line_ends(spark):
    """Against the plain expressions: a count of all words, and a trim of both ends."""
    rng = random.Random(5)
    lines = ["", " ", "\t\r", "\u00a0", " \u00a0 ", "\U0001f600 ", "a", " a", "a\x0b", "\x0cé é\r", "w " * 49, "w " * 50, "w\t \x0b" * 49 + "é", "x" * 99, "x" * 98 + " y"]
    lines += ["".join(rng.choice("ab \t\x0b\x0c\ré\u2003") for _ in range(rng.randint(0, 140))) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in lines], "raw string").withColumn("line", F.trim("raw", F.lit(LR._SPACE)))
    assert df.filter(LR._trimmed(F.col("raw")) != F.col("line")).count() == 0
    words = F.regexp_count("line", F.lit(LR.WORDS))
    for least in (-1, 0, 1, 2, 3, 20, 49, 50, 51):
        held = LR._has_words(F.col("line"), least)
        assert df.filter("line <> ''").filter(held.isNull() | (held != (words >= least))).count() == 0, least
    held = LR._has_words(F.col("line"), 60_000)
    many = spark.createDataFrame([("w " * 59_999 + "w",), ("w " * 59_998 + "w" * 9,)], "line string")
    assert [r[0] for r in many.select(held).collect()] == [True, False]
