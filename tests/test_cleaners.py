import pytest
"""Composite cleaners against literals worked out by reading."""

from dxweave.functions import cleaners as C


def test_diagnosis(apply):
    cells = [
        "1.胎膜早破伴宫颈不成熟，孕39+2周;其他 /",
        "贫血、贫血？",
        "高危妊娠监督、高龄初孕妇的监督",
        "其他",
        None,
        "2、早产儿(男,活产) 12",
    ]
    assert apply(C.clean_diagnosis, cells) == [
        "胎膜早破|宫颈不成熟", "贫血", "高龄初孕妇的监督", None, None, "早产儿(男,活产)",
    ]


def test_diagnosis_plain(apply):
    cells = ["1.胎膜早破伴宫颈不成熟，孕39+2周;其他 /", "贫血、12、贫血", "妊娠 ?"]
    assert apply(C.clean_diagnosis_plain, cells) == ["胎膜早破伴宫颈不成熟", "贫血", "妊娠 ?"]


def test_risk(apply):
    cells = ["血液系统疾病：贫血(黄色)其他(绿色)疤痕子宫(红色)疤痕子宫(红色)", "/", "a（红色）b", "x泌尿系统疾病：y(橙色)"]
    assert apply(C.clean_risk, cells) == ["贫血|疤痕子宫", None, "a（红色）b", "xy"]


def test_complication(apply):
    cells = [
        "1.贫血；2.子宫肌瘤0.5x0.5cm、妊娠合并甲减，其他",
        "其他 1、a b。",
        "12",
        "肌瘤1.2x3cm 2.痔疮",
    ]
    assert apply(C.clean_complication, cells) == [
        "贫血|子宫肌瘤0.5x0.5cm|甲减", "a|b", None, "肌瘤1.2x3cm|痔疮",
    ]


def test_indication(apply):
    cells = [
        "脐带绕颈1周+羊水少",
        "孕39+2周(LOA) 胎儿窘迫+羊水少",
        "发热查因：感染，其他",
        "低置胎盘(?)，3周",
        "孕1产0孕39+2周 左枕前，瘢痕子宫",
        "1.要求手术 臀位 （足先露）",
        "头盆不称 其他 羊水少",
        "无",
        "x孕1产0孕39+2周 左枕前",
    ]
    assert apply(C.clean_indication, cells) == [
        "脐带绕颈1周|羊水少",
        "孕39+2周(LOA)|胎儿窘迫+羊水少",
        "感染",
        "低置胎盘",
        "孕1产0孕39+2周 左枕前|瘢痕子宫",
        "臀位（足先露）",
        "头盆不称|羊水少",
        None,
        "x孕1产0孕39+2周|左枕前",
    ]


def test_indication_can_keep_text_before_cause(apply):
    keep = lambda c: C.clean_indication(c, keep_text_before_cause=True)
    assert apply(keep, ["发热查因:感染"]) == ["发热感染"]
    assert apply(C.clean_indication, ["a，发热查因：感染，b"]) == ["感染|b"]


def test_clean_table_dispatch(spark):
    from dxweave import vocab as V
    from dxweave.plans.cleaning import clean_table

    schema = f"uuid string, Diagnosis2 string, `{V.RISK_COLUMN}` string, `{V.COMPLICATION_COLUMN}` string, `{V.INDICATION_COLUMN}` string"
    row = ("7", "贫血伴甲减、无", "贫血(黄色)", "要求手术", "脐带绕颈1周+羊水少")
    df = spark.createDataFrame([row, ("8", "无", None, "珍贵儿", "其他 /")], schema)
    assert [tuple(r) for r in clean_table(df).collect()] == [
        ("7", "贫血|甲减", "贫血", None, "脐带绕颈1周+羊水少"), ("8", None, None, None, None),
    ]
    old = [tuple(r) for r in clean_table(df, "archived").collect()]
    assert old == [("7", "贫血伴甲减", "贫血", "要求手术", "脐带绕颈1周|羊水少"), ("8", None, None, None, None)]
    upper = clean_table(df, overrides={"uuid": lambda c: c})
    assert upper.columns == df.columns


def test_audit_loop_reaches_a_fixed_point(spark):
    from dxweave.plans.audit import audit

    rows = [(i, "t|u", c) for i, c in enumerate(["C1|A", "C1|A", "C2|B", "ERROR: x|A", "None|B"])]
    df = spark.createDataFrame(rows, "record_id long, diagnosis1 string, diagnosis1_ICD11_Code string")
    fixed, changes = audit(df)
    assert changes == [5, 0]
    assert {r.diagnosis1_ICD11_Code for r in fixed.collect()} == {"C1|A"}


def test_audit_tells_of_rules_that_undo_each_other(spark, monkeypatch):
    from dxweave.operators import repair
    from dxweave.plans.audit import audit

    monkeypatch.setattr(repair, "apply_changes", lambda df, *rest: df)
    df = spark.createDataFrame([(0, "t", "C1"), (1, "t", "C1"), (2, "t", "C2")], "record_id long, diagnosis1 string, diagnosis1_ICD11_Code string")
    with pytest.raises(ValueError, match="undo"):
        audit(df)
