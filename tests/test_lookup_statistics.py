from itertools import product

from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.operators import lookup as L
from dxweave.operators import statistics as T


def test_dictionary_lookup(spark):
    terms = spark.createDataFrame([("a",), ("X",)], "term string")
    book = spark.createDataFrame([("a", "1")], "term string, code string")
    got = {r.term: r.code for r in L.dictionary_lookup(terms, book).collect()}
    assert got == {"a": "1", "X": "ERROR: No mapping for 'X'"}


def test_risk_items(spark):
    listed = V.RISK_EXCLUDED_TOKENS[1]
    both = V.RISK_OVERRIDE_TOKEN
    book = spark.createDataFrame([(both, "DEF"), (listed, "THY"), ("贫血", "AN")], "term string, code string")
    rows = [
        (0, f"{listed}|贫血", "甲减", None, "AN"),
        (1, listed, "甲减", "", ""),
        (2, listed, "", "nan", "THY"),
        (3, both, "胎盘早剥", "", "JA8C.Z"),
        (4, both, "", "凶险性前置胎盘", "JA8A.2|JA8B.1"),
        (5, both, "胎盘早剥", "凶险性前置胎盘", "DEF"),
        (6, both, "", "", "DEF"),
        (7, both, "胎盘", "早剥", "JA8C.Z"),
        (8, None, "甲减", "", ""),
        (9, "z| 贫血 |z", None, None, "ERROR: No mapping for 'z'|AN|ERROR: No mapping for 'z'"),
    ]
    df = spark.createDataFrame(
        [r[:4] for r in rows], f"record_id long, `{V.RISK_COLUMN}` string, `{V.INDICATION_COLUMN}` string, `{V.COMPLICATION_COLUMN}` string"
    )
    out = L.code_risk_items(df, book)
    assert {r.record_id: r[V.RISK_COLUMN + V.CODE_SUFFIX] for r in out.collect()} == {r[0]: r[4] for r in rows}
    L.assert_same_height(df, out)
    alone = df.select("record_id", V.RISK_COLUMN)
    assert L.code_risk_items(alone, book).count() == len(rows)


def test_prevalence_in_all_switch_settings(spark):
    rows = [
        (0, "JA20.1|JA84.2|X", "JA84.2", "0"),
        (1, "JA84.2|ERROR: e", None, "1"),
        (2, None, "JA43.1/JB02.2|JA21", None),
        (3, None, None, "0"),
        (4, "None| ", "X", ""),
    ]
    df = spark.createDataFrame(rows, f"record_id long, a string, b string, `{V.PARITY_COLUMN}` string")
    groups = V.CODE_GROUPS
    for enable, keep, only in product([False, True], repeat=3):
        count = {}
        for _, a, b, parity in rows:
            codes = {c.strip() for cell in (a, b) if cell for c in cell.split("|") if c.strip() and "ERROR" not in c}
            labels = {(V.PARITY_RELABEL[1] if parity == "0" else V.PARITY_RELABEL[2]) if c == "JA84.2" else c for c in codes}
            group = {c: next((g for g, ms in groups.items() if c.startswith(ms)), None) for c in labels}
            items = set(filter(None, group.values())) if enable else set()
            if keep:
                items |= {c for c in labels if not (only and group[c])}
            for i in items:
                count[i] = count.get(i, 0) + 1
        out = T.prevalence(df, ["a", "b"], enable_groups=enable, keep_individual=keep, only_ungrouped=only)
        got = {r[0]: (r[1], r[2], r[3]) for r in T.ordered_prevalence(out).collect()}
        assert got == {k: (n, n, f"{n / 5 * 100:.4f}%") for k, n in count.items()}
    excluded = T.prevalence(df, ["a", "b"], exclude_null_words=True)
    assert "None" not in {r[0] for r in excluded.collect()}


def test_prefix_groups_agree_with_expression(spark):
    codes = spark.createDataFrame([(c,) for c in ["JA20.1", "JA43.1/JB02.2", "JA84.2", "KA20.1Z", ""]], "code string")
    rules = [(i, m, g) for i, (g, m) in enumerate((g, m) for g, ms in V.CODE_GROUPS.items() for m in ms)]
    table = spark.createDataFrame(rules, "rank int, prefix string, label string")
    joined = {r.code: r.label for r in T.prefix_groups(codes, table).collect()}
    direct = {r.code: r.g for r in codes.select("code", T.group_of(F.col("code"), V.CODE_GROUPS).alias("g")).collect()}
    assert joined == direct and direct["JA20.1"] == "妊娠期高血压疾病"


def test_prevalence_keeps_items_in_their_partitions(spark):
    df = spark.createDataFrame([(i, f"C{i}|C{i + 1}|C0") for i in range(40)], "record_id long, a string")
    out = T.prevalence(df, ["a"])
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r[0]: r[1:] for r in out.collect()}
    assert len(got) == 41 and got["C0"][:2] == (40, 40) and got["C1"][:2] == (2, 2) and got["C40"][:2] == (1, 1)
    assert T.prevalence(df.limit(0), ["a"]).count() == 0
