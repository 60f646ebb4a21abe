"""The keyed table and the reply log."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from dxweave.operators import cascade as C
from dxweave.operators.dedup import one_per_key
from dxweave.operators.replies import ReplyLog
from dxweave.session import children, remove
from dxweave.sources import readers, writers
from dxweave.sources.keyed import KeyedTable, Part


def frame(spark, rows):
    return spark.createDataFrame(rows, "term string, code string")


def test_batches_add_what_is_new(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["term"], rows_per_bucket=4)
    assert table.rows(spark) is None and table.lookup(frame(spark, [("a", "")])) is None
    rng, known = random.Random(6), {}
    for batch in range(9):
        rows = [(f"t{rng.randrange(60)}", f"{batch}-{i}") for i in range(rng.choice([1, 3, 12]))] + [(None, "x")]
        asked = frame(spark, [(f"t{i}", "") for i in range(0, 70, 7)] + [(None, "")])
        before = table.lookup(asked, batch)
        assert {tuple(r) for r in before.collect()} == {(f"t{i}", known[f"t{i}"]) for i in range(0, 70, 7) if f"t{i}" in known} if before else not known
        table.append(frame(spark, rows), batch)
        for term, code in sorted(r for r in rows if r[0]):
            known.setdefault(term, code)
        parts = table.parts(spark)
        assert parts[0].first == 0 or batch == 0
        assert sum(p.rows for p in parts) == len(known)
        assert all(p.rows <= 4 * p.buckets for p in parts if p.buckets == 1 or p.rows > 2 * p.buckets)
    assert {tuple(r) for r in table.rows(spark).collect()} == set(known.items())
    table.compact(spark, 100)
    sizes = [p.rows for p in table.parts(spark)]
    assert all(a > 2 * sum(sizes[i + 1 :]) for i, a in enumerate(sizes))
    assert {tuple(r) for r in table.rows(spark).collect()} == set(known.items())
    assert len([n for n in children(spark, table.path) if n.startswith("part_")]) == len(sizes)  # merged parts are gone


def test_a_batch_can_run_again(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["term"])
    table.append(frame(spark, [("a", "1")]), 0)
    table.append(frame(spark, [("b", "2"), ("a", "9")]), 1)
    table.append(frame(spark, [("c", "3"), ("a", "9")]), 1)  # the same batch once more
    assert {tuple(r) for r in table.rows(spark).collect()} == {("a", "1"), ("c", "3")}
    assert table.lookup(frame(spark, [("c", "")]), 1).count() == 0
    table.append(frame(spark, [("a", "5")]), 2)
    assert {tuple(r) for r in table.rows(spark).collect()} == {("a", "1"), ("c", "3")}


def test_unfinished_and_merged_parts(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["term"])
    for batch in range(3):
        table._write(frame(spark, [(f"t{batch}", "x")]), Part(batch, batch, 1, 1))
    table._write(frame(spark, [("t0", "x"), ("t1", "x")]), Part(0, 1, 1, 2))  # a merge that ended before its inputs were removed
    table._write(frame(spark, [("t9", "x")]), Part(0, 2, 1, 3))
    os.remove(tmp_path / "t" / "part_0_2_1_3" / "_SUCCESS")  # a merge that did not end
    assert [p.name for p in table.parts(spark)] == ["part_0_1_1_2", "part_2_2_1_1"]
    table.append(frame(spark, [("n", "x")]), 3)
    assert {r.term for r in table.rows(spark).collect()} == {"t0", "t1", "t2", "n"}
    assert "part_0_0_1_1" not in children(spark, table.path)


def test_a_lookup_reads_only_its_buckets(spark, tmp_path):
    small, large = (KeyedTable(str(tmp_path / n), ["term"], rows_per_bucket=8) for n in ("small", "large"))
    small.append(frame(spark, [(f"t{i}", "x") for i in range(64)]), 0)
    large.append(frame(spark, [(f"t{i}", "x") for i in range(4096)]), 0)
    asked = frame(spark, [("t1", ""), ("t2", ""), ("absent", "")])
    for table in (small, large):
        found = table.lookup(asked)
        assert {r.term for r in found.collect()} == {"t1", "t2"}
        read = {os.path.basename(os.path.dirname(f)) for f in found.inputFiles() if "part_" in f}
        assert 1 <= len(read) <= 3  # as many buckets as terms, whatever the size of the table
    assert large.parts(spark)[0].buckets == 512


def test_one_per_key(spark):
    rows = spark.createDataFrame([("a", "2", 1), ("a", "1", 2), ("b", None, 3)], "k string, v string, n int")
    assert {tuple(r) for r in one_per_key(rows, ["k"]).collect()} == {("a", "1", 2), ("b", None, 3)}
    assert {tuple(r) for r in one_per_key(rows, ["k"], "n").collect()} == {("a", "2", 1), ("b", None, 3)}
    assert one_per_key(rows.select("k"), ["k"]).count() == 2


def test_remove_and_children(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x"))
    assert "_SUCCESS" in children(spark, str(tmp_path / "x"))
    remove(spark, str(tmp_path / "x"))
    remove(spark, str(tmp_path / "x"))
    assert children(spark, str(tmp_path / "x")) == []


def test_log_index_covers_files_of_others(spark, tmp_path):
    path = str(tmp_path / "log")
    entries = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "0")], "key string, value string")
    writers.append_new(entries, path, "key")
    spark.createDataFrame([('{"key": "c", "value": "3"}',), ("broken",), ('{"value": "4"}',)], "value string").coalesce(1).write.mode("append").text(path)
    more = spark.createDataFrame([("a", "8"), ("c", "9"), ("d", "4"), ("d", "5")], entries.schema)
    for _ in range(2):  # the second time nothing is new
        writers.append_new(more, path, "key")
        assert {(r.key, r.value) for r in readers.read_log(spark, path, "key").collect()} == {("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")}
    assert spark.read.text(path).count() == 6


def test_an_append_reads_new_files_and_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(3):
        rows = spark.range(n * 100, n * 100 + 100).selectExpr("cast(id as string) key", "'x' value")
        writers.append_new(rows, path, "key")
    schema = spark.createDataFrame([], "key string").schema
    index = writers._index_log(spark, path, schema)
    assert index.rows(spark).count() == 300
    assert sum(p.rows for p in index.parts(spark)) == 300
    before = children(spark, f"{path}/_keys/files")
    writers._index_log(spark, path, schema)
    assert children(spark, f"{path}/_keys/files") == before  # no file is read twice


def asking(folder, fail_at=None):
    """A resolver that notes every question in a file of its own, and fails once it comes to ``fail_at``."""

    def resolve(questions):
        def run(batches):
            for frame in batches:
                for term in frame["term"]:
                    with open(f"{folder}/{term}", "a") as note:
                        note.write("x")
                    if term == fail_at:
                        raise ValueError("no answer")
                yield frame.assign(reply=[json.dumps({"match_found": True, "target_code": f"C-{t}"}) for t in frame["term"]])

        return questions.mapInPandas(run, "term string, reply string")

    return resolve


def calls(folder):
    return {name: os.path.getsize(f"{folder}/{name}") for name in os.listdir(folder)}


def test_a_failed_task_asks_nothing_else_again(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    log, terms = ReplyLog(str(tmp_path / "log"), per_task=1), [f"q{i}" for i in range(12)]
    questions = spark.createDataFrame([(t,) for t in terms + terms + [None]], "term string")
    with pytest.raises(Exception, match="no answer"):
        log.through(asking(notes, "q7"))(questions)
    answered = {n for n in calls(notes)} - {"q7"}
    replies = log.through(asking(notes))(questions)
    assert sorted(r.term for r in replies.collect()) == sorted(terms)
    again = calls(notes)
    assert again.pop("q7") == 2  # the question at which the task failed
    # A task that had begun when the job failed may have been ended before its reply was kept; no finished one is asked again.
    assert sum(again.values()) <= len(terms) - 1 + 3 and set(again) == set(terms) - {"q7"}
    more = spark.createDataFrame([("q1",), ("q99",)], "term string")
    assert {r.term for r in log.through(asking(notes))(more).collect()} == {"q1", "q99"}
    assert calls(notes) == again | {"q7": 2, "q99": 1} and answered


def test_replies_not_to_be_remembered(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    log = ReplyLog(str(tmp_path / "log"), remember="reply not like '%C-bad%'")
    questions = spark.createDataFrame([("good",), ("bad",)], "term string")
    for _ in range(2):
        assert {r.term for r in log.through(asking(notes))(questions).collect()} == {"good", "bad"}
    assert calls(notes) == {"good": 1, "bad": 2}


def test_repeated_replies_leave_one_code(spark, tmp_path):
    def table(*rows):
        return spark.createDataFrame(rows, "term string, reply string")

    split, verdict = '{"english_terms": ["a", "b"]}', '{"match_found": true, "target_code": "%s"}'
    found = spark.createDataFrame([("b", [{"code": "S", "title": "t", "chapter": "1"}])] * 2, "sub_term string, candidates array<struct<code:string,title:string,chapter:string>>")
    chosen = spark.createDataFrame([("t", "b", '{"best_match_code": "X"}')] * 2, "term string, sub_term string, reply string")
    resolvers = C.Resolvers(
        splits=C.recorded(table(("t", split), ("t", split), ("t", '{"zzz": 1}'))), candidates=C.recorded(found),
        verdicts=C.recorded(table(("a", verdict % "C2"), ("a", verdict % "C1"), ("u", verdict % "U"), ("u", verdict % "U"))), selections=C.recorded(chosen),
    )
    terms = spark.createDataFrame([("t",), ("u",), ("t",)], "term string")
    assert {tuple(r) for r in C.code_terms(terms, resolvers).collect()} == {("t", "C1|X", "search"), ("u", "U", "verdict")}
    ordered = C.recorded(spark.createDataFrame([("a", verdict % "C2", 1), ("a", verdict % "C1", 2)], "term string, reply string, line int"), "line")
    assert [r.reply for r in ordered(terms).collect()] == [verdict % "C2"]

    notes = tmp_path / "notes"
    notes.mkdir()
    logged = ReplyLog(str(tmp_path / "log")).through(asking(notes))
    for _ in range(2):
        coded = C.code_terms(terms, C.Resolvers(splits=resolvers.splits, candidates=resolvers.candidates, verdicts=logged))
        assert {tuple(r)[:2] for r in coded.collect()} == {("t", "C-t"), ("u", "C-u")}
    assert calls(notes) == {"t": 1, "u": 1}
