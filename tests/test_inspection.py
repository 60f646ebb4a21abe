import random

import pytest
from brute import inspect as brute_inspect
from pyspark.sql import functions as F

from dxweave.operators import inspection as I
from dxweave.operators import pairs as P
from dxweave.operators import schema as S

COLUMNS = "record_id long, diagnosis1 string, diagnosis1_ICD11_Code string, diagnosis2 string, diagnosis2_ICD11_Code string"


def wide(spark, rows):
    return spark.createDataFrame([(r, *c[0], *c[1]) for r, c in rows], COLUMNS)


def cells(spark, rows):
    df = wide(spark, rows)
    return S.pair_cells(df, S.code_pairs(df.columns))


def random_rows(seed, n):
    rng = random.Random(seed)
    terms = ["甲", "乙", "，乙（", "丙", "甲 ", "无", "--", ")"]
    codes = ["C1", "C2", "C3", "None", "ERROR: x", "nan"]
    rows = []
    for i in range(n):
        made = []
        for _ in range(2):
            k = rng.randrange(4)
            m = k if rng.random() < 0.8 else rng.randrange(4)
            made.append(("|".join(rng.choices(terms, k=k)), "|".join(rng.choices(codes, [4, 3, 2, 1, 1, 1], k=m)) or None))
        rows.append((i * 3, made))
    return rows


def as_tuples(df):
    return [
        (r.row_index, r.column, r.issue_type, r.term_value, r.code_value, r.recommended_code, r.recommended_code_frequency)
        for r in df.collect()
    ]


@pytest.mark.parametrize("chunk_records", [1, 7, 100, 1 << 16])
def test_flags_equal_brute_force_in_order(spark, chunk_records):
    rows = random_rows(chunk_records, 160)
    flags, _ = brute_inspect(rows, 2)
    got = as_tuples(I.ordered_flags(I.all_flags(cells(spark, rows), chunk_records=chunk_records)))
    assert got == flags
    assert {f[2] for f in flags} == {
        "NOISE_TERM", "MISSING_CODE", "MISSING_TERM", "TERM_CODE_LENGTH_MISMATCH",
        "ERROR_CODE", "EMPTY_OR_NONE_CODE", "TERM_MULTI_CODE",
    }


def test_one_term_holding_most_rows(spark):
    rng = random.Random(9)
    rows = [(i, [("甲", rng.choice(["C1", "C2", "ERROR: e"])), ("", None)]) for i in range(400)]
    flags, _ = brute_inspect(rows, 2)
    assert as_tuples(I.ordered_flags(I.all_flags(cells(spark, rows), chunk_records=16))) == flags


def test_running_recommendation_literal(spark):
    rows = [(i, [("t", c), ("", None)]) for i, c in enumerate(["C1", "C2", "ERROR: x", "C2", "ERROR: y"])]
    flags, _ = brute_inspect(rows, 2)
    got = as_tuples(I.ordered_flags(I.all_flags(cells(spark, rows))))
    assert [g[5:] for g in got if g[2] == "ERROR_CODE"] == [("C1", 1), ("C2", 2)]


def test_global_mode_sees_later_pairs(spark):
    rows = [(0, [("t", "ERROR: x"), ("", None)]), (1, [("t", "C9"), ("", None)])]
    got = as_tuples(I.ordered_flags(I.all_flags(cells(spark, rows), mode="global")))
    assert got[0][5:] == ("C9", 1)


def test_stats_reverse_and_invariants(spark):
    rows = random_rows(21, 200)
    flags, count = brute_inspect(rows, 2)
    annotated = P.annotate_cells(cells(spark, rows))
    pairs = P.cell_pairs(annotated)
    stats = {(r.normalized_term, r.code): r.frequency for r in P.term_code_stats(pairs).collect()}
    assert stats == {(t, c): n for t, cs in count.items() for c, n in cs.items()}
    assert sum(stats.values()) == P.usable_pairs(pairs).count()
    for parts in (1, 16):
        merged = {}
        report = P.reverse_report(pairs, parts).withColumn("counts", F.map_values("terms"))
        for r in report.collect():
            assert 0 <= r.part < parts and r.counts == sorted(r.counts, reverse=True)
            assert not set(merged.setdefault(r.code, {})) & set(r.terms)
            merged[r.code].update(r.terms)
        assert merged == {
            c: {t: stats[t, c] for t in count if (t, c) in stats} for c in {k[1] for k in stats}
        }
    order = [(r.code, r.n) for r in P.reverse_map(pairs).collect()]
    assert order == sorted(order, key=lambda p: (p[0], -p[1]))


def test_template_first_flag_wins_and_placeholder(spark, tmp_path):
    rows = [(i, [("t", c), ("", None)]) for i, c in enumerate(["ERROR: x", "C1", "ERROR: x", "None"])]
    template = I.inspect(cells(spark, rows)).template
    got = {(r.term_keyword, r.wrong_code, r.correct_code, r.note) for r in template.collect()}
    assert got == {("t", "ERROR: x", "", "ERROR_CODE"), ("t", "None", "C1", "EMPTY_OR_NONE_CODE")}
    clean = [(0, [("t", "C1"), ("", None)])]
    I.write_template(I.inspect(cells(spark, clean)).template, str(tmp_path / "t"))
    only = spark.read.option("header", True).csv(str(tmp_path / "t")).collect()
    assert len(only) == 1 and only[0].note == "请按需填写"


def test_flag_summary(spark):
    rows = random_rows(5, 50)
    flags, _ = brute_inspect(rows, 2)
    got = {r.issue_type: r.n_flags for r in I.flag_summary(I.all_flags(cells(spark, rows))).collect()}
    assert got == {k: sum(f[2] == k for f in flags) for k in {f[2] for f in flags}}


def test_column_discovery():
    columns = ["Diagnosis10", "diagnosis2", "diagnosis2_ICD11_Code", "孕期风险项", "孕期风险项_ICD11_Code", "手术适应症"]
    assert S.term_columns(columns) == ["diagnosis2", "Diagnosis10"]
    assert S.term_columns(columns, " 手术适应症, nope") == ["手术适应症"]
    assert S.term_columns(["手术适应症", "孕期风险项"]) == ["手术适应症"]
    assert S.code_pairs(columns) == [("diagnosis2", "diagnosis2_ICD11_Code")]
    assert S.code_pairs(columns[3:]) == [("孕期风险项", "孕期风险项_ICD11_Code")]
    for call in (lambda: S.term_columns(["a"]), lambda: S.term_columns(["a"], "b"), lambda: S.code_pairs(["a"])):
        with pytest.raises(ValueError):
            call()


def test_reverse_report_file(spark, tmp_path):
    import json

    from dxweave.sources.writers import write_reverse_report

    rows = [(i, [("甲|乙|乙", "C1|C1|C1"), ("丙", "C0")]) for i in range(2)]
    pairs = P.cell_pairs(P.annotate_cells(cells(spark, rows)))
    write_reverse_report(P.reverse_report(pairs, parts=1), str(tmp_path / "report"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert [(x["code"], list(x["terms"].items())) for x in sorted(lines, key=lambda x: x["code"])] == [
        ("C0", [("丙", 2)]), ("C1", [("乙", 4), ("甲", 2)]),
    ]
