"""Steps whose cost a large table shows: what is derived once, aggregated by hash, dealt out."""

import itertools
import re

from pyspark.sql import functions as F

from dxweave.functions import text as X
from dxweave.operators import cascade as K
from dxweave.operators import inspection as I
from dxweave.operators import pairs as P
from dxweave.operators import repair as R
from dxweave.operators import schema as S
from dxweave.plans import bindings as B

COLUMNS = "record_id long, diagnosis1 string, diagnosis1_ICD11_Code string"
ROWS = [(1 << 20, "a|b", "K1|K2"), (-3, "a|a", "K2|K1"), (5, " a |、c", "None|K1"), (None, "a|b", "K1|K1"), (7, "a|b|a", "K2|K2|ERROR: x")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _cells(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.createDataFrame(ROWS, COLUMNS).write.parquet(path)
    df = spark.read.parquet(path)
    return S.pair_cells(df, S.code_pairs(df.columns)), path


def test_rule_changes_read_the_input_once(spark, tmp_path):
    cells, path = _cells(spark, tmp_path)
    rules = spark.createDataFrame([(0, "exact", "a", "K1", "K9", "ALL")], "rule_no int, mode string, keyword string, wrong_code string, correct_code string, scope string")
    changes = R.rule_changes(cells, rules)
    assert not [f for f in changes.inputFiles() if path in f]
    assert {(r.record_id, r.pos) for r in changes.collect()} == {(1 << 20, 0), (-3, 1), (None, 0)}


def test_first_places_are_aggregated_by_hash(spark, tmp_path):
    pairs = P.cell_pairs(P.annotate_cells(_cells(spark, tmp_path)[0]))
    counted = P._counted(P.usable_pairs(pairs), "norm", "code")
    # One pair of sort aggregates is left, between the chunks of a key.
    assert _plan(counted).count("SortAggregate(") <= 2 < _plan(counted).count("HashAggregate(") + 1
    plain = P.usable_pairs(pairs).groupBy("norm", "code").agg(F.count("*").alias("n"), F.min(P.place()).alias("first"))
    assert sorted(counted.collect(), key=str) == sorted(plain.collect(), key=str)
    assert counted.schema["first"].dataType.simpleString() == plain.schema["first"].dataType.simpleString()


def test_tasks_of_the_second_pass_grow_with_the_pairs(spark, tmp_path, monkeypatch):
    pairs = P.cell_pairs(P.annotate_cells(_cells(spark, tmp_path)[0]))
    monkeypatch.setattr(P, "PAIRS_PER_TASK", 1)
    few = P.running_recommendation(pairs)
    assert re.search(r"hashpartitioning\(norm#\d+, chunk#\d+L?, 11\), REPARTITION_BY_NUM", _plan(few))


def test_flags_are_stored_before_they_are_sorted(spark, tmp_path):
    cells, path = _cells(spark, tmp_path)
    flags = I.ordered_flags(I.all_flags(cells))
    assert {f.split("/flags-")[1][:1] != "" for f in flags.inputFiles()} == {True}


def test_legacy_cells_are_dealt_out(spark):
    cells = B.legacy_cells(spark, "/root/testdata/sf0.001")
    assert f"RoundRobinPartitioning({B.TEXT_TASKS})" in _plan(cells)


def test_what_needs_no_normalising_is_told_right(spark):
    """The shortcut gives what all steps give, for each pair of odd characters around a word."""
    odd = ["", "a", "N", "nan", "é", "妊", " ", "  ", "\t", "\x85", "\xa0", " ", "​", " ", "⁠", "　", "﻿", "￯", "(", "】", "、", "𝒳"]
    texts = ["".join(t) for t in itertools.product(odd, ["", "a", "nan"], odd)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("t", X.ws_trim(F.col("t")))
    visible = F.regexp_replace(F.when(F.lower("t") == "nan", F.lit("")).otherwise(F.col("t")), f"[{X.INVISIBLE}]", "")
    whole = F.rtrim(F.ltrim(F.regexp_replace(visible, X._UNEVEN_BLANKS, " "), F.lit(X.LEADING_NOISE)), F.lit(X.TRAILING_NOISE))
    assert df.filter(X.normalize_trimmed(F.col("t")) != whole).count() == 0
    cells = spark.createDataFrame([(a + "|" + b,) for a, b in zip(texts, texts[::-1], strict=True)] + [(t,) for t in texts], "t string")
    pieces = X.trimmed_nonempty(F.split(X.nullish_to_empty(F.col("t")), r"\|"))
    assert cells.filter(X.split_pipe(F.col("t")) != pieces).count() == 0


def test_recorded_replies_are_reduced_once(spark):
    replies = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "term string, reply string")
    found = replies.select(F.col("term").alias("sub_term"), F.array("reply").alias("candidates"))
    live = lambda questions: questions.withColumn("reply", F.lit("live"))
    stored = K.stored(K.Resolvers(splits=K.recorded(replies), candidates=K.recorded(found), verdicts=live))
    assert stored.verdicts is live and stored.selections is None
    questions = spark.createDataFrame([("a",)], "term string")
    served = K._asked(stored.splits, questions, "splits")
    assert sorted(map(tuple, served.collect())) == [("a", "1"), ("b", "3")]
    assert "Aggregate" not in _plan(served)
