"""Language identification: n-grams against brute force, held-out accuracy, odd rows."""

import random
from collections import Counter

import numpy as np
import pytest

from dxweave.llm import common, language_id

SYLLABLES = {
    "en": "th ing er and the ou wh ly sh on".split(), "de": "sch ein ung der ich ü ß ä tz pf".split(),
    "fr": "eau aux que ç è é ou ment oi tre".split(), "es": "ción os ado ñ ez ll rr que mente ja".split(), "xx": "qq ww zz kk".split(),
}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, lang, rng.randrange(3, 60)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), [9, 3, 3, 2, 1], k=1200))]
    rows += [(2000, None, "en"), (2001, "123 $$", "en"), (2002, "", None), (2003, sentence(rng, "de", 20), None), (None, sentence(rng, "fr", 9), "fr"), (2004, "Ω", "fr")]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, lang string, score string, fold string").repartition(3).cache()


@pytest.fixture(scope="module")
def model(docs):
    return language_id.train(docs.where("doc_id % 3 > 0"))


def brute_grams(text):
    """All n-grams of letters with word borders, as the module hashes them."""
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    out = Counter()
    for word in letters.split():
        bounded = [0, *map(ord, word), 0]
        for n in range(1, language_id.LONGEST + 1):
            for i in range(len(bounded) - n + 1):
                gram = bounded[i : i + n]
                if any(gram):
                    value = np.zeros(1, np.uint64)
                    for length, c in enumerate(gram, 1):
                        value = common.mix(value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(c) + np.uint64(length))
                    out[int(value[0] >> np.uint64(64 - language_id.BITS))] += 1
    return out


def test_grams(monkeypatch, odd_rows):
    # A border is one element between two words, so its pair with either side belongs to one word only.
    texts = ["Ab c", "  naïve-Ω, x", "", "a" * 50, "1 2", "İß ﬁ 你好", " x ", "a b c d e"]
    for block in (1 << 20, 4):
        monkeypatch.setattr(language_id, "BLOCK_BYTES", block)
        for text in [*texts, odd_rows[0][1]]:
            index, count = language_id._vector(text.encode())
            assert dict(zip(index.tolist(), count.tolist())) == dict(brute_grams(text)), (block, text)


def test_texts_do_not_touch_each_other(monkeypatch, model):
    rng = random.Random(3)
    texts = [sentence(rng, rng.choice(list(SYLLABLES)), rng.randrange(0, 30)).encode() for _ in range(60)] + [b"", b"12", b" "]
    alone = [language_id.predict_texts(model, [t]) for t in texts]
    for block in (1 << 20, 64):
        monkeypatch.setattr(language_id, "BLOCK_BYTES", block)
        languages, score = language_id.predict_texts(model, texts)
        assert languages == [a[0] for a, _ in alone]
        assert np.allclose(score, [b[0] for _, b in alone], atol=1e-6)


def test_two_steps(model):
    assert sorted(model.families) == ["germanic", "only xx", "romance"]
    assert sorted(model.first) == sorted(model.families)
    assert sorted(model.second) == [("de", "en"), ("es", "fr")]


def test_held_out_accuracy(docs, model):
    rows = language_id.predict(docs.where("doc_id % 3 = 0 and doc_id < 2000"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 400
    assert sum(r.lang == r.lang_pred for r in rows) >= 396
    assert all(0 <= r.score <= 1 for r in rows)
    right = [r.score for r in rows if r.lang == r.lang_pred]
    assert np.mean(right) > 0.9


def test_same_from_any_partitioning(docs, model):
    again = language_id.train(docs.where("doc_id % 3 > 0").repartition(5))
    for key, machine in {**model.first, **model.second}.items():
        other = (again.first | again.second)[key]
        assert np.array_equal(machine.weights, other.weights) and machine.slope == other.slope


def test_odd_rows(spark, docs, model, odd_docs, odd_rows, no_docs):
    rows = language_id.predict(odd_docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd_rows)
    for r in language_id.predict(docs.where("doc_id >= 2000"), model).collect():
        assert (r.lang_pred == "und") == (r.doc_id in (2000, 2001, 2002)) and (r.score == 0 or r.lang_pred != "und")
    assert language_id.predict(no_docs, model).count() == 0
    assert language_id.train(docs.where("lang is null")) is None
    assert {tuple(r) for r in language_id.predict(docs.where("doc_id in (0, 2000)"), None).collect()} == {(0, "und", 0.0), (2000, "und", 0.0)}
    one = language_id.train(docs.where("lang = 'en' and doc_id < 200"))
    assert {r.lang_pred for r in language_id.predict(docs.where("doc_id < 50"), one).collect()} == {"en"}
    two = language_id.train(docs.where("lang in ('en', 'de') and doc_id < 300"))  # one family, no first step
    assert not two.first and list(two.second) == [("de", "en")]
    assert {r.lang_pred for r in language_id.predict(docs.where("doc_id < 50"), two).collect()} == {"en", "de"}


def test_machine_is_the_best_one():
    """Against gradient descent on the regularised squared hinge loss of the same scaled rows."""
    rng = np.random.default_rng(2)
    rows = [(np.array([0, 1 + k % 2, 5 + int(rng.integers(50))], np.uint16), np.array([9.0, 1.0, 2.0])) for k in range(60)]
    y = np.array([1.0 if k % 2 and k < 40 else -1.0 for k in range(60)])  # not separable, classes of unequal size
    weights, bias = language_id.fit_machine(rows, y)
    margins = np.array([weights[i] @ c / c.sum() + bias for i, c in rows])
    x = np.zeros((60, 60))
    for k, (index, count) in enumerate(rows):
        x[k, index] = count / count.sum()
    x *= 1 / np.sqrt(x.mean(axis=0) + language_id.RARE)
    x = np.column_stack([x / np.sqrt((x**2).sum(axis=1).mean()), np.ones(60)])
    cost = language_id.COST * np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    w = np.zeros(61)
    for _ in range(20_000):
        w -= 2e-3 * (w - 2 * x.T @ (cost * y * np.maximum(0, 1 - y * (x @ w))))
    assert np.allclose(margins, x @ w, atol=0.02)
