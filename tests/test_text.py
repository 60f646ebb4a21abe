"""Scalar functions against literals and brute force."""

import random

from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X


def test_blank_and_digit_classes_cover_unicode(apply):
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    assert set(X.BLANKS) == {c for c in points if c.isspace()}
    import re

    assert {c for c in points if re.fullmatch(X.BLANK, c)} == set(X.BLANKS)
    digits = [c for c in points if c.isdigit()]
    other = [c for c in points[:: 97] if not c.isdigit()]
    missed = [c for c, ok in zip(digits, apply(X.is_digits, digits)) if not ok]
    # Only blocks newer than the JVM's Unicode tables may be missed.
    assert all(ord(c) > 0xFFFF for c in missed) and len(missed) < 60, missed
    assert not any(apply(X.is_digits, other))


def test_ws_trim_and_split_pipe(apply):
    assert apply(X.ws_trim, ["　a\x1f ", " b\n", ""]) == ["a", "b", ""]
    cells = ["a| b ||c", None, " NaN ", "", "|", "nan|x"]
    assert apply(X.split_pipe, cells) == [["a", "b", "c"], [], [], [], [], ["nan", "x"]]


def test_null_if_in_is_exact(apply):
    got = apply(lambda c: X.null_if_in(c, V.CELL_PLACEHOLDERS), ["无", " 无", None, "贫血"])
    assert got == [None, " 无", None, "贫血"]


def brute_depth_split(text, separators):
    out, depth, buffer = [], 0, ""
    for ch in text:
        if ch in separators and depth == 0:
            out.append(buffer)
            buffer = ""
        else:
            buffer += ch
            depth += ch in V.OPENING_BRACKETS
            depth = max(0, depth - (ch in V.CLOSING_BRACKETS))
    return [p.strip() for p in out + [buffer] if p.strip()]


def test_depth_split_literals(apply):
    cells = ["早产儿(男,活产),贫血", "a,b(c,d),e)f,g", "a,(b,c", "(a],b)", "", ",,", "[a,(b,c)d,e],f"]
    assert apply(X.depth_split, cells) == [
        ["早产儿(男,活产)", "贫血"],
        ["a", "b(c,d)", "e)f", "g"],
        ["a", "(b,c"],
        ["(a]", "b)"],
        [],
        [],
        ["[a,(b,c)d,e]", "f"],
    ]


def test_depth_split_matches_brute_force(apply):
    rng = random.Random(3)
    cells = ["".join(rng.choice("ab ,;()（[】}、\n") for _ in range(rng.randrange(40))) for _ in range(600)]
    for separators in (V.TERM_SEPARATORS, V.ARCHIVED_TERM_SEPARATORS):
        got = apply(lambda c: X.depth_split(c, separators), cells)
        assert got == [brute_depth_split(c, separators) for c in cells]


def test_depth_split_long_cell(apply):
    cell = "a,(b,c)," * 20000
    assert apply(lambda c: F.size(X.depth_split(c)), [cell]) == [40000]


def test_connector_split(apply):
    got = apply(
        lambda c: X.connector_split(c, V.OBSTETRIC),
        ["胎膜早破伴宫颈不成熟", "妊娠合并贫血", "伴发热", "甲 和 乙 丙", "1和2", "A并发B及C"],
    )
    assert got == [
        ["胎膜早破", "宫颈不成熟"],
        ["妊娠合并贫血"],
        ["伴发热"],
        ["甲", "乙丙"],
        ["1和2"],
        ["A", "B", "C"],
    ]


def test_small_deletions(apply):
    assert apply(X.drop_ordinal, ["1.a", "12、 b", "３. c", "1 d"]) == ["a", "b", "c", "1 d"]
    assert apply(X.drop_leading_words, ["其他 a", "其它b", "a其他"]) == ["a", "b", "a其他"]
    assert apply(X.drop_question_marks, ["a?？b"]) == ["ab"]
    assert apply(X.drop_empty_brackets, ["a（ )b()"]) == ["ab"]
    assert apply(lambda c: X.drop_phrases(c, V.REMOVABLE_PHRASES), ["要求手术 a"]) == ["a"]
    assert apply(X.trim_edges, [" ，a|;"]) == ["a"]
    assert apply(lambda c: X.remove_first(c, "x."), ["ax.bx.", "b"]) == ["abx.", "b"]


def test_non_disease(apply):
    terms = ["孕39+2周", "高危妊娠监督", "高龄初孕妇的监督", "高龄经产的\n监督", "早孕监督", "NONE", "贫血", "产1次x"]
    got = apply(lambda c: X.is_non_disease(c, V.OBSTETRIC), terms)
    assert got == [True, True, False, True, True, True, False, False]


def test_normalise_and_noise(apply):
    terms = ["，。HBV感染（", "贫血)", ")", "无", "---", "①", None, "nan", "a​ \n b", "_"]
    norm = apply(X.normalize_term, terms)
    assert norm == ["HBV感染", "贫血)", "", "无", "---", "①", "", "", "a b", "_"]
    reasons = apply(lambda c: X.noise_reason(X.normalize_term(c)), terms)
    assert reasons == [
        None, None, V.NOISE_EMPTY, V.NOISE_EXPLICIT, V.NOISE_PUNCTUATION, None,
        V.NOISE_EMPTY, V.NOISE_EMPTY, None, V.NOISE_PUNCTUATION,
    ]


def test_normalise_is_idempotent(apply):
    rng = random.Random(5)
    terms = ["".join(rng.choice("ab .,)（[】、​　") for _ in range(rng.randrange(12))) for _ in range(300)]
    once = apply(X.normalize_term, terms)
    assert apply(X.normalize_term, once) == once


def test_strip_html(apply):
    assert apply(X.strip_html, ["<em class='x'>A</em>b", "a<b\nc>d", "a<b\rc>d"]) == ["Ab", "a<b\nc>d", "ad"]


def test_extract_json(apply):
    replies = [
        'x ```json {"a": 1} ``` y',
        '```json {bad} ``` {"b": 2}',
        'say {"b": {"c": 2}} end',
        "none",
        None,
    ]
    assert apply(X.extract_json, replies) == ['{"a": 1}', None, '{"b": {"c": 2}}', None, None]


def test_reply_fields(apply):
    verdicts = [
        '{"match_found": true, "target_code": "X"}',
        '{"match_found": "true", "target_code": "X"}',
        '{"match_found": false, "target_code": "X"}',
        '{"match_found": true, "target_code": null}',
        "oops",
    ]
    assert apply(X.verdict_code, verdicts) == ["X", None, None, None, None]
    splits = ['{"english_terms": ["a", "b"]}', '{"english_terms": "a"}', '{"english_terms": 5}', '{"x": 1}',
              '{"english_terms": []}', '{"english_terms": null}']
    assert apply(X.split_terms, splits) == [["a", "b"], ["a"], ["5"], None, [], ["None"]]
    assert apply(X.selected_code, ['{"best_match_code": "Q"}', "{}", "x"]) == ["Q", None, None]
    assert apply(X.safe_int, [" 12 ", "x", None, "1.5"]) == [12, 0, 0, 0]


def test_percent_text_equals_exact_rounding(apply):
    rng = random.Random(7)
    values = [0.0, 100.0, 0.78125, 0.00005, 1 / 3, 0.00015, 2.34375, 33.33335, 1.00005]
    values += [p / 2_000_000 * 100 for p in range(1, 4000)]
    values += [rng.randrange(1, 10**7) / 10**7 * 100 for _ in range(4000)]
    got = apply(X.percent_text, values, "v double")
    assert got == [f"{v:.4f}%" for v in values]
    assert apply(X.percent_text, [1 / 128 * 100], "v double") == ["0.7812%"]


def test_names():
    import re

    for name in ("a b/c", "model:v1.2_x", "__", "/x/", "中文"):
        assert X.safe_name(name) == re.sub(r"[^A-Za-z0-9._-]+", "_", name)


def test_short_hash(apply):
    import hashlib

    assert apply(X.short_hash, ["规则"]) == [hashlib.md5("规则".encode()).hexdigest()[:8]]
