"""The transducer with its hash table, and what filters do in every order."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dxweave.llm import filter_audit


def brute_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)), len(text)


def measured(texts):
    found = filter_audit.measure_texts([t.encode() for t in texts])
    return list(zip(*(found[k].tolist() for k in ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_chars"))))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \t\n\x0b\x0c\rabcABZ#$|é你🙂\x1c\x85\0"), max_size=60), min_size=1, max_size=6), st.integers(4, 40))
def test_transducer(texts, block):
    kept, filter_audit.BLOCK_BYTES = filter_audit.BLOCK_BYTES, block  # blocks end inside words and code points
    try:
        assert measured(texts) == [brute_measure(t) for t in texts]
    finally:
        filter_audit.BLOCK_BYTES = kept


def test_long_words_and_texts():
    rng = random.Random(1)
    texts = ["x" * 3_000_000, "ab " * 500_000, "", " ".join(rng.choices(["word", "Wordy", "w" * 40, "w" * 39 + "x"], k=100_000)), "a" * 2_000_000 + " " + "a" * 2_000_000]
    assert measured(texts) == [brute_measure(t) for t in texts]


def test_spans_with_one_hash_are_compared():
    raw = np.frombuffer(b"abcdefgh abcdefgi abcdefgh a b a" + bytes(8), np.uint8)
    begin, end = np.array([0, 9, 18, 27, 29, 31]), np.array([8, 17, 26, 28, 30, 32])
    same = np.full(6, 7, np.uint64)
    assert filter_audit.distinct_words(raw, begin, end, same, np.zeros(6, np.int64), 2).tolist() == [4, 0]
    assert filter_audit.distinct_words(raw, begin, end, same, np.array([0, 0, 1, 1, 1, 1]), 2).tolist() == [2, 3]


def brute_audit(rows, labels):
    texts = [(i, (t or ""), p or "") for i, t, p in rows]
    out = Counter()
    for i, t, p in texts:
        words, distinct, capitals, symbols, chars = brute_measure(t)
        fails = {
            "A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * chars, "D": symbols > 0,
            "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts),
        }
        good = any(j == i and q == 1 for j, q, _ in labels) and i is not None
        toxic = any(j == i and x == 1 for j, _, x in labels) and i is not None
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (p, "".join(order), step)
                out[(*key, "redundant")] += gone and fails[f]
                out[(*key, "unique_fails")] += fails[f] and sum(fails.values()) == 1
                if not gone and fails[f]:
                    gone = True
                    out[(*key, "removed")] += 1
                    out[(*key, "good_lost")] += good
                    out[(*key, "toxic_lost")] += toxic
                    out[(p, f, "shapley")] += 1
                out[(*key, "kept")] += not gone
    return out


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def check(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, source string, part string, digest string").repartition(3)
    marks = spark.createDataFrame([(*r, "clash") for r in labels], "doc_id long, quality int, toxic int, good string")
    found, expected = filter_audit.audit(docs, marks).collect(), brute_audit(rows, labels)
    assert len(found) == len({r.part for r in found}) * 600 == len({p or "" for _, _, p in rows}) * 600
    for r in found:
        assert tuple(r[c] for c in COUNTS) == tuple(expected[r.part, r.filter_order, r.step, c] for c in COUNTS)
        assert r.shapley == expected[r.part, r.filter_order[r.step - 1], "shapley"]
    return found


def test_every_order(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["UPPER", "a|b", "100%"]
    texts = [" ".join(rng.choices(vocabulary[: rng.choice([8, 60, 63])], k=rng.choice([10, 49, 50, 80]))) for _ in range(25)]
    rows = [(i, rng.choice(texts), rng.choice(["x", "y", None])) for i in range(100)]
    rows += [(3, texts[0], "x"), (3, texts[0], "x"), (None, texts[0], "x"), (None, texts[1], None), (200, None, "x"), (201, "", "y"), (202, None, "z"), (-5, texts[2], "")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 100, 2)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (4, None, None)]
    check(spark, rows, labels)


def test_rows_of_one_text_and_no_rows(spark):
    check(spark, [(i, "same Text", "x") for i in range(20)] + [(0, "same Text", "x"), (0, "same Text", "y")], [])
    assert filter_audit.audit(spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_measure_of_odd_rows(spark, odd_docs, odd_rows):
    rows = filter_audit.measure(odd_docs, part="label").collect()
    got = Counter((r.doc_id, r.part, r.n_words, r.n_distinct, r.n_capitals, r.n_symbols, r.n_chars) for r in rows)
    assert got == Counter((i, "clash", *brute_measure(t or "")) for i, t in odd_rows)
