"""Quoted line breaks read in many tasks: against Spark's own reader of whole files, for any place of the split borders."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dxweave.sources import quoted, readers


def one_task(spark, paths, header=True):
    """Spark's reader that takes every file whole."""
    options = {"header": header, "multiLine": True, "escape": '"', "lineSep": "\n"}
    return spark.read.options(**options).csv(paths)


class SmallSplits:
    """Files are cut into splits of ``size`` bytes."""

    def __init__(self, spark, size):
        self.conf, self.size = spark.conf, str(size)

    def __enter__(self):
        self.conf.set("spark.sql.files.maxPartitionBytes", self.size)
        self.conf.set("spark.sql.files.openCostInBytes", "0")

    def __exit__(self, *_):
        self.conf.unset("spark.sql.files.maxPartitionBytes")
        self.conf.unset("spark.sql.files.openCostInBytes")


def content(rng, rows, ends="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ends)
    writer.writerow(["uuid", "diag\nnosis", "x"])
    for i in range(rows):
        cells = ["".join(rng.choices(["a", "b", ",", '"', "\n", "\n\n", "é", "\r\n", " "], [9, 3, 2, 2, 2, 1, 1, 1, 1], k=rng.randrange(9))) for _ in range(2)]
        writer.writerow([f"r{i}", *cells])
    return out.getvalue()


@pytest.mark.parametrize("size, most", [(7, 12), (64, 60), (1000, 60)])
def test_any_split_gives_the_same_records(spark, tmp_path, size, most):
    rng = random.Random(size)
    for name, rows in (("b", most), ("a", 5), ("c", 1)):
        (tmp_path / f"{name}.csv").write_bytes(("﻿" if name == "b" else "").encode() + content(rng, rows).encode())
    paths = [str(tmp_path / f"{n}.csv") for n in "abc"]
    expected = [tuple(r) for p in paths for r in one_task(spark, p).collect()]
    with SmallSplits(spark, size):
        names = one_task(spark, paths).columns
        got = quoted.read_quoted(spark, paths, names, True, "row").orderBy("row").collect()
    assert [r.row for r in got] == list(range(most + 6))
    assert [tuple(r)[1:] for r in got] == expected


def test_python_reads_the_same(spark, tmp_path):
    text = content(random.Random(4), 80)
    (tmp_path / "t.csv").write_bytes(text.encode())
    rows = list(csv.reader(io.StringIO(text, newline="")))
    with SmallSplits(spark, 40):
        got = quoted.read_quoted(spark, str(tmp_path / "t.csv"), ["u", "v", "w"], False, "row").orderBy("row").collect()
    assert [tuple(x or "" for x in tuple(r)[1:]) for r in got] == [tuple(r) for r in rows]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from('a",\n '), max_size=6), min_size=1, max_size=5))
def test_state_after_a_line(cells):
    """Of well-formed text: inside quotes exactly where the number of quotes so far is odd."""
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(cells)
    state, seen = False, 0
    for line in out.getvalue().split("\n"):
        state, seen = quoted.open_after(line, state), seen + line.count('"')
        assert state == bool(seen % 2)
    assert not state


def test_stray_quotes_do_not_open_a_field():
    assert not quoted.open_after('5" pipe, 6" pipe', False)
    assert not quoted.open_after('a,"b"c"d,e', False) and not quoted.open_after('x" ,y', True)
    assert quoted.open_after('a,"b', False) and quoted.open_after('"b"",', False)
    assert not quoted.open_after('say ""hi"" ",b', True)


def test_edges(spark, tmp_path):
    texts = {
        "empty": "", "header": "a,b\n", "no end": "a,b\n1,2", "blank lines": "\n\na,b\n\n1,2\n\n", "carriage": 'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n',
        "stray": 'a,b\n5" pipe,x\n"q""q","m\nn"\n', "never closed": 'a,b\n1,"open\nmore\n\n', "one record": 'a,b\n1,"' + "line\n" * 500 + '"\n2,x\n',
        "short": "a,b\n1\n1,2,3\n",
    }
    expected = {
        "empty": [], "header": [], "no end": [("1", "2")], "blank lines": [("1", "2")], "carriage": [("1", "x\r\ny"), ("2", "z")],
        "stray": [('5" pipe', "x"), ('q"q', "m\nn")], "never closed": [("1", "open\nmore\n")], "one record": [("1", "line\n" * 500), ("2", "x")],
        "short": [("1", None), ("1", "2")],
    }
    for size in (16, 100_000):
        with SmallSplits(spark, size):
            for name, text in texts.items():
                path = tmp_path / f"{name} {size}.csv"
                path.write_bytes(text.encode())
                got = quoted.read_quoted(spark, str(path), ["a", "b"], True, "row").orderBy("row").collect()
                assert [tuple(r)[1:] for r in got] == expected[name], (name, size)
                assert [r.row for r in got] == list(range(len(got)))


def test_many_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text(content(random.Random(1), 3000))
    with SmallSplits(spark, 4000):
        df = readers.read_table(spark, str(tmp_path / "t.csv"), multi_line=True, ordinal="row")
        assert df.filter(F.col("uuid") == "r2999").first().row == 2999
        assert df.rdd.getNumPartitions() > 8 and df.count() == 3000
        plain = readers.read_table(spark, str(tmp_path / "t.csv"), multi_line=True)
        assert plain.columns == ["uuid", "diag\nnosis", "x"] and plain.count() == 3000
