"""The registered queries: wiring, plans, and a sample against the oracle."""

import os

import pytest

import __spark_entry__ as entry

FOLDER = entry.SMOKE_FOLDER
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="bench tables are not here")


def test_every_query_has_an_oracle():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLES)


@needs_data
def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["normalized_term", "code", "frequency"]
    assert df.count() > 0


@needs_data
@pytest.mark.parametrize(
    "name",
    ["term_code_stats", "multi_code_conflicts", "running_recommendation", "code_cascade", "candidate_topk",
     "apply_fix_rules", "context_rules", "global_replace_table", "code_prevalence", "merge_resume"],
)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in plan


@needs_data
@pytest.mark.parametrize("name", ["strip_html", "legacy_complications", "rule_set_version", "prefix_groups"])
def test_sample_equals_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in ("part", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    mine = entry.queries()[name](spark, FOLDER)
    theirs = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    expected = sorted(map(repr, theirs.fetchall()))
    assert sorted(repr(tuple(r)) for r in mine.select(*columns).collect()) == expected
