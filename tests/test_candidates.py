"""Candidate search: what goes by way of the driver, packed counters, and odd catalogues."""

import random
import re

import pytest

from dxweave.operators import candidates as K


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _searched(spark, asked, entities, **options):
    catalogue = spark.createDataFrame(entities, "code string, title string")
    return K.search(spark.createDataFrame([(q,) for q in asked], "sub_term string"), catalogue, **options)


def _expected(asked, entities, keep=5):
    """Rows of a code are one entity, as long as its titles together."""
    words, length = {}, {}
    for code, title in entities:
        if title and title.split():
            words.setdefault(code, set()).update(title.split())
            length[code] = length.get(code, 0) + len(set(title.split()))
    rows = set()
    for q in {q for q in asked if q is not None}:
        scored = [(-n, length[c], c is not None, c or "", c) for c, w in words.items() if (n := len(w & set(q.split())))]
        rows |= {(q, s[-1], -s[0], i + 1) for i, s in enumerate(sorted(scored, key=lambda s: s[:4])[:keep])}
    return rows


@pytest.mark.parametrize("packed", [True, False])
def test_nothing_that_grows_with_the_questions_goes_through_the_driver(spark, monkeypatch, packed):
    """Postings repeated for blocks of questions were broadcast, because the file they come from is small."""
    monkeypatch.setattr(K, "BLOCK", 2)
    if not packed:
        monkeypatch.setattr(K, "PACKED", -1)
    asked = [f"the of {i} {i % 7}" for i in range(200)]
    df = _searched(spark, asked, [(f"E{i}", f"the of {i} {i + 1}") for i in range(20)], hot=4)
    joins = re.findall(r"BroadcastHashJoin \[(.*?)\], \[", _plan(df))
    assert not [j for j in joins if "salt#" in j or packed and "key#" in j]


@pytest.mark.parametrize("packed", [True, False])
def test_odd_catalogues(spark, monkeypatch, packed):
    """Titles that repeat, codes that repeat, nulls, and titles without a word."""
    if not packed:
        monkeypatch.setattr(K, "PACKED", -1)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    titles = [" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(40)]
    entities = [(f"E{rng.randrange(300):03d}", rng.choice(titles)) for _ in range(220)]
    entities += entities[:60] + [(None, "w1 w2"), (None, "w3"), ("N", None), ("O", ""), ("P", " -- ")]
    asked = [" ".join(rng.choices(words, k=rng.randrange(1, 7))) for _ in range(60)] + ["nothing", "", None, "w1", "w1"]
    expected = _expected(asked, [(c, (t or "").replace("-", " ")) for c, t in entities])
    for keep, hot in ((5, 16), (1, 0)):
        wanted = {r for r in expected if r[3] <= keep}
        assert {tuple(r) for r in _searched(spark, asked, entities, hot=hot, keep=keep).collect()} == wanted, (keep, hot)


def test_full_counters_leave_their_neighbours_alone(spark):
    """Every title has all its words asked; several rows of counters; numbers of one and of many counters."""
    for most in (1, 8, 70):
        entities = [(f"E{i:03d}", " ".join(f"w{(i * 5 + j) % 90}" for j in range(1 + i % most))) for i in range(130)]
        asked = [" ".join(f"w{i}" for i in range(90)), "w0", "w89 w5"]
        assert {tuple(r) for r in _searched(spark, asked, entities, keep=40).collect()} == _expected(asked, entities, 40), most


def test_of_titles_with_the_same_words_the_first_codes_are_searched(spark):
    entities = [(f"E{i:03d}", t) for i in range(100) for t in (["b a", "a b a", "A, b", "a c"][i % 4],)]
    kept = K._entities(spark.createDataFrame(entities, "code string, title string"), 3).collect()
    assert sorted((r.code, r.words, r.length) for r in kept) == sorted(
        [(f"E{i:03d}", ["a", "b"], 2) for i in (0, 1, 2)] + [(f"E{i:03d}", ["a", "c"], 2) for i in (3, 7, 11)]
    )
    empty = _searched(spark, ["a b"], [("E", "")])
    assert empty.collect() == [] and empty.dtypes == [("sub_term", "string"), ("code", "string"), ("score", "bigint"), ("rank", "int")]
