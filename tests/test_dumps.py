r"""Database dumps: blocks over splits, escapes, what is no row."""

import random

import pytest
from conftest import rows

from saleswh.schemas import make_schema
from saleswh.sources import read_copy_text, read_dump

AB = make_schema(a="integer", b="string")


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def escaped(text):
    return text.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n").replace("\r", "\\r")


def test_escapes(spark, tmp_path):
    raw = [
        ("1", r"a\bb\x41"), ("2", r"\\N"), ("3", r"\N"), ("4", r"\101\60x\8\q\."), ("5", r"\303\251\xC3\xA9\x9z"),
        ("6", r"\f\n\r\t\v"), ("7", ""), ("8", "\\"), ("9", "日本 é"), ("10", r"\\\\t\\\t"), ("11", r"\n\\N"), ("12", r"\501"),
    ]
    (tmp_path / "t.txt").write_text("\n".join("\t".join(r) for r in raw) + "\n", encoding="utf-8")
    got = {r.a: r.b for r in read_copy_text(spark, str(tmp_path / "t.txt"), AB).collect()}
    assert got == {
        1: "a\bbA", 2: "\\N", 3: None, 4: "A0x8q.", 5: "éé\tz", 6: "\f\n\r\t\v", 7: "", 8: "\\", 9: "日本 é", 10: "\\\\t\\\t", 11: "\n\\N", 12: "A",
    }


def test_nothing_behind_the_end_marker(spark, tmp_path, small_splits):
    lines = [f"{i}\tx{i}" for i in range(30)] + ["\\."] + [f"{i}\tbehind" for i in range(30)] + ["COPY t (a, b) FROM stdin;", "99\ty", "\\."]
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n")
    assert rows(read_copy_text(spark, str(tmp_path / "t.txt"), AB)) == sorted([(i, f"x{i}") for i in range(30)], key=repr)


def test_wrong_width_and_missing_column(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1\tx\n2\n")
    with pytest.raises(Exception, match="wrong number of fields: 2"):
        read_copy_text(spark, str(tmp_path / "t.txt"), AB).collect()
    (tmp_path / "d.sql").write_text("COPY t (a, c) FROM stdin;\n1\tx\n\\.\n")
    with pytest.raises(Exception, match="no column b among a, c"):
        read_dump(spark, str(tmp_path / "d.sql"), "t", AB).collect()


@pytest.mark.parametrize("seed", range(3))
def test_tables_of_a_dump(spark, tmp_path, small_splits, seed):
    """Random blocks over many splits, values that look like headers or markers, columns in any order, CRLF."""
    rng = random.Random(seed)
    lines, want = ["SET x = 1;", "9\tbefore all blocks"], {"t": [], "u": []}
    strange = ["COPY u (a, b) FROM stdin;", "COPY public.t (a, b) FROM stdin;", "\\.", ".", "", "tab\tand\nline", "é" * 20]
    for _ in range(12):
        name = rng.choice("tu")
        columns = rng.choice([["a", "b"], ["b", "a"], ["b", "z", "a"]])
        lines.append(f"COPY {rng.choice(['public.', 'PUBLIC.', ''])}{name} ({', '.join(columns)}) FROM stdin;")
        for _ in range(rng.randrange(12)):
            row = {"a": str(rng.randrange(99)), "b": rng.choice(strange), "z": "zzz"}
            lines.append("\t".join(escaped(row[c]) for c in columns))
            want[name].append((int(row["a"]), row["b"]))
        lines += ["\\.", *rng.choice([[], ["", "-- between blocks", "7\tnothing"]])]
    text = ("\r\n" if seed == 2 else "\n").join(lines) + "\n"
    (tmp_path / "d.sql").write_bytes(text.encode())
    for name in "tu":
        got = read_dump(spark, str(tmp_path / "d.sql"), name, AB)
        assert rows(got) == sorted(want[name], key=repr)
    assert read_dump(spark, str(tmp_path / "d.sql"), "v", AB).count() == 0


def test_whole_line_like_a_header_inside_a_block(spark, tmp_path):
    odd = "COPY t (a) FROM stdin;"
    (tmp_path / "d.sql").write_text(f"COPY s (x) FROM stdin;\n{odd}\n{odd}\n\\.\n{odd}\n5\n\\.\n")
    one = make_schema(a="integer")
    assert rows(read_dump(spark, str(tmp_path / "d.sql"), "t", one)) == [(5,)]
    assert rows(read_dump(spark, str(tmp_path / "d.sql"), "s", make_schema(x="string"))) == [(odd,), (odd,)]


def test_files_apart_or_joined(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1").write_text("COPY t (a, b) FROM stdin;\n1\tx\n")
    (tmp_path / "d" / "2").write_text("2\ty\n\\.\n3\tz\n")
    assert rows(read_dump(spark, str(tmp_path / "d"), "t", AB)) == [(1, "x")]
    assert rows(read_dump(spark, str(tmp_path / "d"), "t", AB, joined=True)) == [(1, "x"), (2, "y")]
