"""Near copies, repeated passages, embeddings, language model and the pipeline against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import words

from dxweave.llm import components, embeddings, language_model, near_duplicates, substrings


def joined(links, nodes):
    """Smallest node that links reach, for every node."""
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 200), (200, 300), (7, 7)]
    links += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(nodes) and {r.node: r.component for r in got} == joined([x for x in links if x[0] != x[1]], nodes)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- near copies ----------------------------------------------------------------------------


def shingles(text):
    w = (text or "").encode().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def similarity(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1] / (len(a) + len(b) - row[-1])


def test_alignment_equals_plain_dynamic_program():
    rng = random.Random(3)
    for _ in range(400):
        a = [rng.randrange(30) for _ in range(rng.randrange(1, 40))]
        b = [x for x in a if rng.random() > 0.08]
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(30))
        true = similarity(a, b) if b else 0.0
        got = near_duplicates.aligned(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
        assert got <= true + 1e-12
        if true >= 0.8:
            assert abs(got - true) < 1e-12


@pytest.fixture(scope="module")
def copied():
    rng, rows = random.Random(9), []
    shared = words(rng, 60)  # a passage that many texts hold without being copies
    for family in range(25):
        base = words(rng, rng.randrange(40, 160), 3000).split()
        for copy in range(rng.randrange(1, 7)):
            text = list(base)
            for _ in range(rng.randrange(4) if copy else 0):
                text[rng.randrange(len(text))] = f"x{rng.randrange(99)}"
            rows.append(" ".join(text))
    rows += [words(rng, 60, 3000) + " " + shared for _ in range(20)]
    chain = words(rng, 100, 5000).split()  # each differs from the next a little, the ends a lot
    for i in range(6):
        rows.append(" ".join(chain[: 20 * i // 3] + chain[20 * i // 3 + 1 :]))
        chain = chain[:]
        chain[90 - 7 * i] = f"y{i}"
    rng.shuffle(rows)
    return list(enumerate(rows))


def brute_classes(rows):
    known = [(i, t) for i, t in rows if i is not None]
    sets = [(i, shingles(t), tuple((t or "").encode().split())) for i, t in known]
    links = []
    for k, (i, a, wa) in enumerate(sets):
        for j, b, wb in sets[:k]:
            if wa and wa == wb:
                links.append((i, j))
            elif a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(set(a) & set(b)) >= 0.3 * len(set(a)):
                if similarity(a, b) >= 0.8:
                    links.append((i, j))
    return joined(links, {i for i, _ in known})


def test_near_duplicates(spark, copied):
    got = near_duplicates.classes(spark.createDataFrame(copied, "doc_id long, text string").repartition(5)).collect()
    expected = brute_classes(copied)
    assert len(got) == len(copied) and {r.doc_id: r.class_id for r in got} == expected
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    assert 30 < len(set(expected.values())) < len(copied) - 20


def test_near_duplicates_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = near_duplicates.classes(odd_docs).collect()
    expected = brute_classes([(i, t) for i, t in odd_rows if i != 7])
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd_rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id not in (None, 7)} == {k: v for k, v in expected.items()}
    assert all(r.class_id is None and r.kept for r in got if r.doc_id is None)
    assert near_duplicates.classes(no_docs).count() == 0


@pytest.mark.parametrize("heads", [4, 40])
def test_near_duplicates_in_one_group(spark, heads):
    """Near copies that link to none of many heads with smaller ids; the first round links nothing."""
    rng = random.Random(heads)
    rows = [words(rng, 60, 3000) for _ in range(heads)]
    for size in (2, 3):
        base = words(rng, 120, 3000).split()
        rows += [" ".join([*base[: 7 + 9 * k], "new", *base[8 + 9 * k :]]) for k in range(size)]
    chain = words(rng, 100, 5000).split()  # the ends are linked by the last only
    steps = [" ".join(["old"] * k + chain[k:]) for k in (12, 6, 0)]
    rows += [steps[0], steps[2], steps[1]]
    rows = list(enumerate(rows))
    docs = near_duplicates.common.rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    schema = "doc_id long, digest binary, n_kmers long, entries array<long>" + ", bag binary" * hasattr(near_duplicates, "BAG")
    texts = docs.mapInArrow(near_duplicates._sketch, schema).selectExpr("*", "array(1L) as one").drop("entries").withColumnRenamed("one", "entries")
    links = [tuple(x) for x in near_duplicates._near(docs, texts, 0.8).collect()]
    expected = brute_classes(rows)
    assert joined(links, range(len(rows))) == expected and len(set(expected.values())) == heads + 3


def test_pairs_of_a_common_passage_grow_with_the_texts(spark, monkeypatch):
    """Texts of one group that share a passage only: most are never compared, and the near copies among them are found."""
    rng = random.Random(21)
    shared, tested = words(rng, 40, 3000), []
    rows = [f"{words(rng, 40, 9000)} {shared} {words(rng, 40, 9000)}" for _ in range(300)]
    rows += [t + " end" for t in rows[100:110]] + [t.replace(shared, shared[:-20] + "x y z") for t in rows[200:210]]
    rows = list(enumerate(rows))
    stored = near_duplicates.common.stored

    def counted(df, purpose):
        out = stored(df, purpose)
        tested.append(out.count() if purpose == "pairs" else 0)
        return out

    docs = near_duplicates.common.rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    texts = docs.mapInArrow(near_duplicates._sketch, near_duplicates.SKETCH).selectExpr("*", "array(1L) as one").drop("entries").withColumnRenamed("one", "entries")
    monkeypatch.setattr(near_duplicates.common, "stored", counted)
    links = [tuple(x) for x in near_duplicates._near(docs, texts, 0.8).collect()]
    assert joined(links, range(len(rows))) == brute_classes(rows)
    assert len({min(x) for x in links}) >= 20 and sum(tested) < 4 * len(rows)


def test_near_duplicates_that_were_no_heads(spark):
    """Two classes that had their heads: their other documents are left to compare."""
    placed = spark.createDataFrame([(9, i, 196, 2 - i % 2) for i in (1, 2, 3, 4)], "entry long, doc_id long, n_kmers long, component long")
    heads = spark.createDataFrame([(9, (1, 196, 1)), (9, (2, 196, 2))], "entry long, head struct<doc_id:long,n_kmers:long,component:long>")
    tried = spark.createDataFrame([(1, 2)], "a long, b long")
    left = near_duplicates._rest_pairs(near_duplicates._rest(placed, heads), tried, 0.8)
    assert [tuple(x) for x in left.collect()] == [(3, 4)]


def test_near_duplicates_of_a_repeated_id(spark):
    """An id with a copy and another text, which is a near copy of a third document."""
    rng = random.Random(8)
    copy, other = words(rng, 120, 3000), words(rng, 120, 3000)
    rows = [(1, copy), (7, copy), (7, other), (9, other + " end"), (12, words(rng, 120, 3000))]
    got = near_duplicates.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, c) for i, _ in rows for c in [brute_classes(rows)[i]])
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 7: 1, 9: 1, 12: 12}


# -- repeated passages ----------------------------------------------------------------------


def brute_report(rows, width):
    first = {}
    split = [(i if i is not None else math.inf, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, math.inf), i)
    out = []
    for (own, w), (i, _) in zip(split, rows):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < own:
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_substrings(spark, copied, odd_rows, monkeypatch, small):
    if small:  # many batches and slices, and a sketch in which most windows look repeated
        for name, value in (("BATCH_BYTES", 3000), ("SLICE_WINDOWS", 3000), ("WIDTH", 1 << 10)):
            monkeypatch.setattr(substrings, name, value)
    rows = [(i + 1000, t) for i, t in copied] + odd_rows
    docs = spark.createDataFrame([(*r, "clash", i) for i, r in enumerate(rows)], "doc_id long, text string, part string, row long").repartition(4)
    expected = brute_report(rows, 13)
    got = substrings.report(docs)
    assert Counter(tuple(r) for r in got.collect()) == Counter(e[:4] for e in expected)
    assert sum(e[2] for e in expected) > 1000
    rewritten = substrings.rewrite(docs)
    assert rewritten.columns == docs.columns
    texts = {r.row: (r.doc_id, r.text) for r in rewritten.collect()}
    assert texts == {n: (i, t if not gone else kept.decode()) for n, ((i, t), (_, _, gone, _, kept)) in enumerate(zip(rows, expected))}


def test_windows_hold_no_words_they_are_not_asked_for():
    rows = pa.table({"doc_id": [2, 1], "text": ["a b c d e", "c d e f"]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    known = substrings.common.WordHashes((11, 12))
    bare, full = (substrings._windows(sink.getvalue(), known, 1, 0, 3, keep=keep) for keep in (False, True))
    assert bare.parts == [] and [len(p) for p in full.parts] == [5, 4]
    assert bare.low.tolist() == full.low.tolist() and bare.several.sum() == 1
    assert [h.itemsize for h in known.hashes] == [8, 8]  # as numbers, not as objects


def test_no_substrings(no_docs, spark):
    assert substrings.report(no_docs).count() == 0
    none = spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_words, r.n_removed) for r in substrings.report(none).collect()} == {(None, 0, 0), (1, 0, 0)}


# -- embeddings -----------------------------------------------------------------------------


def brute_links(rows, cosine):
    def unit(v):
        v = np.array(v, float) / max(map(abs, v))
        return v / np.linalg.norm(v)

    usable = [(i, unit(v), k) for i, v, k in rows
              if i is not None and k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    count, links = Counter(), []
    for n, (i, a, k) in enumerate(usable):
        for j, b, m in usable[:n]:
            if k == m and len(a) == len(b) and float(a @ b) >= cosine:
                count[i] += 1
                count[j] += 1
                links.append((i, j))
    return count, joined(links, {r[0] for r in rows if r[0] is not None})


@pytest.mark.parametrize("block", [512, 7])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SMALL", 5 if block == 7 else 32)
    rng = np.random.default_rng(4)
    rows, ids = [], iter(range(10_000))
    for label in (0, 1, None):
        centres = rng.standard_normal((12, 32))
        for c in centres:
            for _ in range(rng.integers(1, 9)):
                rows.append((next(ids), (c + rng.standard_normal(32) * rng.choice([0.05, 0.2, 0.35])).tolist(), label))
        rows += [(next(ids), centres[0].tolist(), label) for _ in range(25)]
        rows += [(next(ids), (centres[1] + rng.standard_normal(32) * 0.1).tolist(), label) for _ in range(30)]
    odd = [None, [], [0.0] * 32, [None] * 32, [float("nan")] * 32, [float("inf")] * 32, [1.0, 2.0], [2.0, 4.0], [1e-200] * 32, [-0.0, 1.0], [0.0, 1.0], [1e200, 1e200]]
    rows += [(next(ids), v, 1) for v in odd] + [(None, [1.0] * 32, 1), (None, [1.0] * 32, 1)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, rep string")
    got = {r.vec_id: tuple(r)[1:] for r in embeddings.near_copies(frame).collect() if r.vec_id is not None}
    count, component = brute_links(rows, 0.93)
    assert {i: g[0] for i, g in got.items()} == {i: count[i] for i in component}
    assert {i: (g[1], g[2]) for i, g in got.items()} == {i: (c, c == i) for i, c in component.items()}
    assert embeddings.near_copies(frame).where("vec_id is null and n_links = 0 and component_id is null and kept").count() == 2
    assert embeddings.near_copies(frame.limit(0)).count() == 0


def test_repeated_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [0.0, 1.0], 0)]
    got = embeddings.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((4000, 64))
    b = a * 0.8 + rng.standard_normal(a.shape) * 0.6
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    codes, queries = embeddings.Codes(a), embeddings.Codes(b)
    estimate = np.einsum("ij,ij->i", queries.rotated, codes.signs) / codes.aligned
    error = estimate - (a * b).sum(axis=1)
    assert abs(error.mean()) < 0.01
    assert (error >= -codes.margin).mean() > 0.9999


# -- language model -------------------------------------------------------------------------


@pytest.mark.parametrize("frequent", [1 << 17, 5])
def test_language_model(spark, odd_docs, odd_rows, no_docs, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    train = [(i, t) for i, t in odd_rows if i is not None and i % 2 == 0]
    tokens = lambda t: language_model.tokens((t or "").encode())
    count = Counter(w for _, t in train for w in tokens(t))
    n, floor = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    got = defaultdict(list)
    for r in language_model.score(odd_docs, odd_docs.where("doc_id % 2 = 0")).collect():
        got[r.doc_id].append(r)
    for i, t in odd_rows:
        own = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / floor) for w in own)
        assert any(
            (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n) and abs(r.base_score - base) < 1e-6 * (1 - base)
            for r in got[i]
        ), i
        assert all(r.score < 0 for r in got[i])
    assert sum(map(len, got.values())) == len(odd_rows)
    assert language_model.score(no_docs, odd_docs).count() == 0
    unseen = language_model.score(odd_docs.where("doc_id = 6"), no_docs).first()
    assert (unseen.n_known, unseen.train_tokens) == (0, 0)


def test_filter_keeps_every_level(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"a{i}" for i in range(60)], [1 / (i + 1) for i in range(60)], k=80)) for _ in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    pairs = Counter()
    for t in texts:
        w = language_model.tokens(t.encode())
        pairs.update(zip([b"\n", *w[:-1]], w))
    hashes = language_model.common.WordHashes((5,))
    keys = np.concatenate([language_model._grams([[a, b]], hashes)[2][1:] for a, b in pairs])
    true = language_model.level(np.array(list(pairs.values())))
    got = language_model.build_filter(docs, 5000).levels(keys)
    assert (got >= true).all() and (got == true).mean() > 0.97  # a Bloom filter only errs upwards
    monkeypatch.setattr(language_model, "MAX_FILTER_BYTES", 600)
    small = language_model.build_filter(docs, 5000)
    assert small.lowest > 1 and small.bits.size <= 1024
    low = true < small.lowest
    assert (small.levels(keys)[~low] >= true[~low]).all() and (small.levels(keys)[low] == 0).mean() > 0.9


def test_scores_do_not_depend_on_the_place_of_the_filter(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(language_model, "SEGMENT_BYTES", 700)
    train = odd_docs.where("doc_id % 2 = 0 or doc_id = 10")
    whole = language_model.score(odd_docs, train).collect()
    monkeypatch.setattr(language_model, "MAX_FILTER_BYTES", 600)
    parts = language_model.score(odd_docs, train).collect()
    assert len(whole) > 40 and Counter(map(repr, parts)) == Counter(map(repr, whole))


@pytest.mark.parametrize("frequent", [1 << 17, 5])
def test_scores_are_probabilities(spark, monkeypatch, frequent):
    """All texts with at most two words of the vocabulary have no more than 1 together.

    Rounding to a level takes at most half of a pair's probability, and as much again after a rare word: three times in these texts.
    """
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    rng, vocabulary = random.Random(3), [f"w{i}" for i in range(25)]
    train = spark.createDataFrame([(i, f"{rng.choice(vocabulary[: 1 + i % 25])} {rng.choice(vocabulary)}") for i in range(3000)], "doc_id long, text string")
    texts = ["", *vocabulary, *(f"{a} {b}" for a in vocabulary for b in vocabulary)]
    scored = language_model.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), train)
    total = sum(10**r.score for r in scored.collect())
    assert 0.9 * (1 / 8 if frequent > 5 else 1 / 64) < total <= 1.001


def test_conditional_probabilities_add_up():
    count = np.array([5.0, 3.0, 0.0, 1.0])  # of the pairs that begin with a word seen nine times
    own, floor = np.array([20.0, 7.0, 4.0, 1.0]), 32 + 0.5 * 5
    every = language_model.conditional(count, np.full(4, 9.0), own, floor)
    unseen = language_model.conditional(np.zeros(1), np.full(1, 9.0), np.zeros(1), floor)
    assert abs(every.sum() + unseen.sum() - 1) < 1e-12
    assert np.allclose(language_model.conditional(count * 0, count * 0, own, floor), (own + 0.5) / floor)  # after an unseen word


def test_model_says_more_than_single_words(spark):
    rng = random.Random(1)
    follow = {f"w{i}": [f"w{(i * 7 + k) % 50}" for k in range(3)] for i in range(50)}

    def text():
        w = ["w1"]
        while len(w) < 60:
            w.append(rng.choice(follow[w[-1]]))
        return " ".join(w)

    docs = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    held = language_model.score(docs.where("doc_id >= 150"), docs.where("doc_id < 150")).collect()
    assert all(r.score > r.base_score + 20 for r in held)


# -- the pipeline ---------------------------------------------------------------------------


def test_pipeline(spark, tmp_path, copied, odd_rows):
    import corpus_pipeline
    from test_filters import brute_base

    rng = random.Random(12)
    rows = [(i, t) for i, t in copied] + [(2000 + k, t) for k, (_, t) in enumerate(odd_rows)]
    rows += [(3000 + i, " ".join(f"{w}$$$ |" for w in words(rng, 40).split())) for i in range(60)]
    rows += [(4000 + i, " ".join(w if rng.random() > 0.1 else "vile" for w in words(rng, 60, 3000).split())) for i in range(60)]
    labels = [(i, int(not 3000 <= i < 4000), int(4000 <= i < 5000)) for i, _ in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    full.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r.doc_id: r for r in docs.collect()})
        if name != "best-fit packing":
            assert docs.columns == full.columns
    good, mild, single, cut, packed = seen
    assert set(good) == {i for i, t in rows if not brute_base(t)[5] and not 3000 <= i < 4000}
    assert set(mild) == {i for i in good if not 4000 <= i < 5000}
    classes = brute_classes([(i, r.text) for i, r in mild.items() if len(r.text) < 100_000])
    assert set(single) == {i for i in mild if classes.get(i, i) == i}
    order = list(single)
    expected = brute_report([(i, single[i].text) for i in order], 13)
    assert {i: r.text for i, r in cut.items()} == {i: single[i].text if not e[2] else e[4].decode() for i, e in zip(order, expected)}
    assert all(r.n_chars == len(r.text) for r in cut.values())
    assert set(packed) == set(cut)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= len(packed)
