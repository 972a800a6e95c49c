import random
import re

import pytest
from pyspark.sql import functions as F

from saleswh.llm import quotes
from saleswh.llm.quotes import reply_order

SCHEMA = "conv_id long, turn long, role string, text string"

CHAT = [
    (1, 0, "a", "Hello all.\nShall we meet on Monday?"),
    (1, 1, "b", "> Shall we meet on Monday?\nMonday is fine."),
    (1, 2, "c", "> Hello   ALL.\n> Shall we meet on Monday?\nI can't."),
    (1, 3, "a", "> > Shall we meet on Monday?\n> Monday is fine.\nGood.\n"),
    (1, 4, "d", ">nobody said this\nHm."),
    (2, 0, "a", "Shall we meet on Monday?"),
    (2, 1, "b", None),
    (2, 1, "b", "twice"),
    (None, 5, "x", "> lost"),
]


@pytest.fixture(scope="module")
def threads(spark):
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    return {(r.conv_id, r.turn, r.clean_text): r for r in reply_order(rows.withColumn("row", F.lit(1))).collect()}


def test_replies_follow_quotes(threads):
    got = {(k[0], k[1]): r.reply_to for k, r in threads.items()}
    assert got == {(1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 1, (1, 4): 3, (2, 0): None, (2, 1): 0, (None, 5): None}


def test_later_replies_open_branches(threads):
    got = {(k[0], k[1]): r.branch for k, r in threads.items()}
    assert got == {(1, 0): 0, (1, 1): 0, (1, 2): 2, (1, 3): 0, (1, 4): 0, (2, 0): 0, (2, 1): 0, (None, 5): None}


def test_quotes_are_gone_and_counted(threads):
    got = {(k[0], k[1], k[2]): (r.n_quotes, r.n_linked) for k, r in threads.items()}
    assert got[1, 1, "Monday is fine."] == (1, 1)
    assert got[1, 3, "Good."] == (2, 2)
    assert got[1, 4, "Hm."] == (1, 0)
    assert got[2, 1, ""] == (0, 0) and got[2, 1, "twice"] == (0, 0)
    assert got[None, 5, ""] == (1, 0)


def test_long_branches_and_many_turns(spark):
    n = 2300
    rows = [(7, t, "u", f"> line {t - 2}\nline {t}" if t > 1 and t % 5 == 0 else f"line {t}") for t in range(n)]
    got = {r.turn: r for r in reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    parent = {t: (t - 2 if t > 1 and t % 5 == 0 else t - 1) for t in range(1, n)}
    branch = {0: 0}
    taken = set()
    for t in range(1, n):
        first = parent[t] not in taken
        taken.add(parent[t])
        branch[t] = branch[parent[t]] if first else t
    assert {t: r.branch for t, r in got.items()} == branch


def test_no_rows(spark):
    assert reply_order(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def _parsed(text):
    """(level, passage, body) of each line."""
    out, passage, last = [], 0, None
    for line in (text or "").replace("\r", "").split("\n"):
        mark = re.match(r"(?:[ \t]*>)+ ?", line)
        level = mark.group().count(">") if mark else 0
        passage += level != last
        last = level
        out.append((level, passage, line[mark.end():] if mark else line))
    return out


def _units(text, quoted):
    """(level, passage, normalised text) of passages and lines."""
    whole = {}
    for level, passage, body in _parsed(text):
        if (level > 0) == quoted:
            whole.setdefault((level, passage), []).append(body)
    both = {(k, x) for k, bodies in whole.items() for x in ["\n".join(bodies), *bodies]}
    normal = {(*k, re.sub(r"[ \t-\r]+", " ", x.lower()).strip(" ")) for k, x in both}
    return {u for u in normal if u[2]}


def brute(rows):
    reply, branch, n_linked = {}, {}, {}
    for conv in {r[0] for r in rows if r[0] is not None}:
        own, asked = {}, {}
        for c, turn, _, text in rows:
            if c == conv and turn is not None:
                own.setdefault(turn, set()).update(u[2] for u in _units(text, False))
                asked.setdefault(turn, set()).update(_units(text, True))
        turns, taken = sorted(own), set()
        for k, turn in enumerate(turns):
            links = [(level, passage, unit, max((t for t in turns[:k] if unit in own[t]), default=None))
                     for level, passage, unit in asked[turn]]
            links = [x for x in links if x[3] is not None]
            n_linked[conv, turn] = len({x[1] for x in links})
            chars = {}
            for level, _, unit, of in links:
                if level == 1:
                    chars[of] = chars.get(of, 0) + len(unit)
            to = max(chars, key=lambda of: (chars[of], of)) if chars else turns[k - 1] if k else None
            reply[conv, turn] = to
            branch[conv, turn] = turn if to is None or to in taken else branch[conv, to]
            taken.add(to)
    out = []
    for conv, turn, role, text in rows:
        lines = _parsed(text)
        kept = [b for level, _, b in lines if level == 0] if any(x[0] for x in lines) else (text or "").split("\n")
        while len(kept) > 1 and not kept[0].strip():
            del kept[0]
        while len(kept) > 1 and not kept[-1].strip():
            del kept[-1]
        n_quotes = len({p for level, p, b in lines if level > 0 and b.strip(" ")})
        at = (conv, turn)
        out.append((conv, turn, role, "\n".join(kept), n_quotes, n_linked.get(at, 0), reply.get(at), branch.get(at)))
    return out


@pytest.mark.parametrize("seed,span", [(1, 1000), (2, 3)])
def test_like_brute_force(spark, monkeypatch, seed, span):
    monkeypatch.setattr(quotes, "SPAN", span)
    rng = random.Random(seed)
    said = ["ok", "OK", "yes  please", "see you", "no", "b c", "", " "]
    rows = [(None, 1, "a", "> ok"), (5, None, "a", "ok"), (5, 1, None, None)]
    for conv in range(25):
        for turn in range(rng.randint(0, 14)):
            lines = [
                rng.choice(["", "", "> ", ">", "> > ", " >>"]) + rng.choice(said) for _ in range(rng.randint(0, 6))
            ]
            rows += [(conv, turn * rng.choice([1, 1, 2]), rng.choice("ab"), "\n".join(lines))] * rng.choice([1, 1, 1, 2])
    got = [tuple(r) for r in reply_order(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_a_quote_has_one_link(spark):
    n = 600
    quoted = [(1, t, 1, 1, "ok", 2) for t in range(n)]
    asked = spark.createDataFrame(quoted, "conv long, turn long, level int, passage int, unit string, chars int")
    own = spark.createDataFrame([(1, t, "ok") for t in range(n)], "conv long, of long, unit string")
    got = {r.turn: r.of for r in quotes._links(asked, own).collect()}
    assert got == {t: t - 1 for t in range(1, n)}


def test_very_long_texts(spark):
    gap = "a" + "\n" * 20_000 + "b"
    turns = "\n".join(f"> q{i}\nown {i}" for i in range(8000))
    rows = [(1, 0, "a", gap), (1, 1, "b", turns), (1, 2, "a", "\n \n" + gap + "\n\n")]
    got = {r.turn: r for r in reply_order(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0].clean_text == got[2].clean_text == gap
    assert got[1].n_quotes == 8000 and got[1].clean_text.count("\n") == 7999
