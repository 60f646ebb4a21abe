import random

from brute import noisy, norm, pieces
from pyspark.sql import functions as F

from dxweave.operators import inspection as I
from dxweave.operators import repair as R
from dxweave.operators import schema as S

COLUMNS = "record_id long, diagnosis1 string, diagnosis1_ICD11_Code string, diagnosis2 string, diagnosis2_ICD11_Code string"
RULES = "rule_no long, enabled string, term_match_mode string, term_keyword string, wrong_code string, correct_code string, column_scope string, note string"


def rules_of(spark, rows):
    return spark.createDataFrame([(i, *r, "n") for i, r in enumerate(rows)], RULES)


def brute_rule(rules, term, code, column):
    gone = code.lower() in ("", "none", "nan")
    for mode in ("exact", "contains"):
        for i, (enabled, m, keyword, wrong, correct, scope) in enumerate(rules):
            hit = norm(keyword) == norm(term) if mode == "exact" else norm(keyword) in norm(term)
            if enabled == "Y" and m == mode and correct and hit and scope in ("ALL", column) and (
                wrong == code or (wrong == "" and gone)
            ):
                return i, correct
    return None


def test_repair_equals_brute_force(spark):
    rng = random.Random(4)
    terms = ["轻度贫血", "贫血", "，贫血（", "甲减", "无", "疤痕子宫"]
    codes = ["A", "B", "None", "ERROR: e"]
    rows = []
    for i in range(150):
        row = [i]
        for _ in range(2):
            k = rng.randrange(4)
            m = rng.choice([k, k, k, 0, rng.randrange(4)])
            row += ["|".join(rng.choices(terms, k=k)), "|".join(rng.choices(codes, k=m))]
        rows.append(tuple(row))
    rules = [
        ("Y", "contains", "贫血", "A", "X1", "ALL"),
        ("Y", "exact", "贫血", "A", "X2", "diagnosis2"),
        ("Y", "exact", "贫血", "A", "X3", "diagnosis2"),
        ("N", "exact", "甲减", "A", "X4", "ALL"),
        ("Y", "exact", "甲减", "", "X5", "ALL"),
        ("Y", "contains", "子宫", "None", "X6", "diagnosis1"),
        ("Y", "contains", "度", "", "X7", "ALL"),
        ("Y", "exact", "疤痕子宫", "B", "", "ALL"),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    fixed, report = R.repair(df, rules_of(spark, rules))
    expected, changes = {}, set()
    for rid, *rest in rows:
        out = []
        for j in (0, 1):
            tc, cc = rest[2 * j], rest[2 * j + 1]
            ts, cs, column = pieces(tc), pieces(cc), f"diagnosis{j + 1}"
            slots = None
            if not cs:
                slots = [(t, "") for t in ts if not noisy(t)]
            elif len(ts) == len(cs):
                slots = list(zip(ts, cs))
            elif len([t for t in ts if not noisy(t)]) == len(cs):
                slots = list(zip([t for t in ts if not noisy(t)], cs))
            new = []
            hit = False
            for k, (t, c) in enumerate(slots or []):
                found = None if noisy(t) else brute_rule(rules, t, c, column)
                if found:
                    hit = True
                    changes.add((rid, column, k, t, c, found[1], found[0]))
                new.append(found[1] if found else (c or "None"))
            out += [tc, "|".join(new) if hit else cc]
        expected[rid] = tuple(out)
    assert {(r.record_id, r.column, r.pos, r.term, r.old_code, r.new_code, r.rule_no) for r in report.collect()} == changes
    assert {r[0]: tuple(r)[1:] for r in fixed.select(*df.columns).collect()} == expected
    assert len({c[6] for c in changes}) >= 4
    summary = {r.rule_no: r.modifications for r in R.change_summary(report).collect()}
    assert sum(summary.values()) == len(changes)


def test_noise_removal(spark):
    df = spark.createDataFrame(
        [(0, "a|无|b", "X|Y|Z", "c|无", "W"), (1, "无", None, "a|b|c", "X|Y")], COLUMNS
    )
    fixed, _ = R.repair(df, rules_of(spark, [("Y", "exact", "zz", "q", "p", "ALL")]), drop_noise=True)
    got = {r[0]: tuple(r)[1:] for r in fixed.select(*df.columns).collect()}
    assert got == {0: ("a|b", "X|Z", "c", "W"), 1: (None, None, "a|b|c", "X|Y")}


def test_inspect_repair_inspect_leaves_fewer_flags(spark):
    rows = [(i, "t", c, None, None) for i, c in enumerate(["C1", "C1", "C2", "ERROR: x", "None"])]
    df = spark.createDataFrame(rows, COLUMNS)
    cells = lambda d: S.pair_cells(d, S.code_pairs(d.columns))
    template = I.inspect(cells(df)).template.withColumn("rule_no", F.lit(0).cast("long"))
    fixed, _ = R.repair(df, template)
    assert I.all_flags(cells(df)).count() == 3
    assert I.all_flags(cells(fixed)).count() == 0


def test_global_replacement(spark):
    df = spark.createDataFrame([(0, None, "JB64.2/5B81.Z|5B81.Z", None, "5B81.Z"), (1, None, "A", None, None)], COLUMNS)
    columns = ["diagnosis1_ICD11_Code", "diagnosis2_ICD11_Code"]
    once = R.replace_code(df, columns, "5B81.Z", "N")
    got = {r.record_id: (r[columns[0]], r[columns[1]]) for r in once.collect()}
    assert got == {0: ("JB64.2/5B81.Z|N", "N"), 1: ("A", None)}
    assert R.replace_code(once, columns, "5B81.Z", "N").collect() == once.collect()
    mapping = spark.createDataFrame([("5B81.Z", "N"), ("A", "B")], "old_code string, new_code string")
    table = {r.record_id: (r[columns[0]], r[columns[1]]) for r in R.replace_codes(df, columns, mapping).collect()}
    assert table == {0: ("JB64.2/5B81.Z|N", "N"), 1: ("B", None)}


def test_replacing_leaves_other_cells_alone(spark):
    df = spark.createDataFrame([(0, None, " Brand#21 || Z", None, "Brand#2 | Z")], COLUMNS)
    columns = ["diagnosis1_ICD11_Code", "diagnosis2_ICD11_Code"]
    row = R.replace_code(df, columns, "Brand#2", "N").first()
    assert (row[columns[0]], row[columns[1]]) == (" Brand#21 || Z", "N|Z")


def test_several_rows_for_a_code(spark):
    df = spark.createDataFrame([(0, None, "A|B|A", None, "C")], COLUMNS)
    columns = ["diagnosis1_ICD11_Code", "diagnosis2_ICD11_Code"]
    rows = [("A", "A1", 2), ("A", "A2", 1), ("A", "A2", 1), ("B", "B1", 0)]
    lined = spark.createDataFrame(rows, "old_code string, new_code string, line int")
    assert R.replace_codes(df, columns, lined).first()[columns[0]] == "A1|B1|A1"
    assert R.replace_codes(df, columns, lined.drop("line")).first()[columns[0]] == "A1|B1|A1"


def test_equal_rules_count_once(spark):
    df = spark.createDataFrame([(i, "t|u", None, None, None) for i in range(3)], COLUMNS)
    cells = S.pair_cells(df, S.code_pairs(df.columns))
    rules = [(9 - i, "Y", "contains", "t", "", f"C{9 - i}", "ALL") for i in range(5)]
    table = spark.createDataFrame(rules, "rule_no long, enabled string, term_match_mode string, term_keyword string, "
                                  "wrong_code string, correct_code string, column_scope string")
    changes = R.rule_changes(cells, R.load_rules(table)).collect()
    assert [(r.term, r.new_code, r.rule_no) for r in changes] == [("t", "C5", 5)] * 3


def test_keywords_are_found_by_their_rarest_piece(spark):
    rng = random.Random(12)
    terms = ["".join(rng.choices("abcdé你", [6, 4, 3, 1, 1, 1], k=rng.randrange(0, 12))) for _ in range(300)]
    cut = [t[i : i + n] for t in terms[:80] for i, n in [(rng.randrange(len(t) + 1), rng.randrange(1, 9))] if t[i : i + n]]
    keywords = sorted({*cut, "a", "é", "zz", "zzz", "abz", "你é", *terms[:20]} - {""})
    norms = spark.createDataFrame([(t,) for t in terms + terms[:50]], "norm string")
    for chosen in (keywords, [k for k in keywords if len(k) > 4], ["zzzz"], []):
        asked = spark.createDataFrame([(k,) for k in chosen * 2], "keyword string")
        found = {tuple(r) for r in R.anchored(norms, asked).collect()}
        true = {(t, k) for t in terms for k in chosen if k in t}
        assert true <= found
        assert {(t, k) for t, k in found if k in t} == true
        # As many as hold the rarest piece, however many lengths the keywords have.
        cuts = {k: {k[i : i + min(3, len(k))] for i in range(len(k) - min(3, len(k)) + 1)} for k in chosen}
        assert len(found) == sum(min(sum(p in t for t in set(terms)) for p in cuts[k]) for k in chosen)


def test_samples(spark):
    df = spark.createDataFrame([(0, "胎盘血窦|贫血", "A|B", "贫血", "A"), (1, "甲", "A/B", None, None)], COLUMNS)
    cells = S.pair_cells(df, S.code_pairs(df.columns))
    found = lambda **k: {(r.record_id, r.column) for r in R.find_samples(cells, **k).collect()}
    assert found(code="A") == {(0, "diagnosis1"), (0, "diagnosis2")}
    assert found(keyword="血窦") == {(0, "diagnosis1")}
    assert found(code="A", keyword="贫") == {(0, "diagnosis1"), (0, "diagnosis2")}
    assert found(code="A", code_contains=True) == {(0, "diagnosis1"), (0, "diagnosis2"), (1, "diagnosis1")}
