"""URL rules, quality rules and toxicity."""

import random
import re
from collections import Counter

import numpy as np

from llm_samples import words

from dxweave.llm import quality, toxicity, url_filters


def brute_url(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h))
            if best is None or rank > best[0]:
                best = (rank, h + p, verdict)
    return host, path, best and best[1], best[2] if best else default


def test_urls(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "http://", "https://COM/", "x://a.com", "http://a.com/?q=/en/", "ftp://wwW.Example.com/en/x#y", "http://Éxample.com/en/",
            "http://example.com/en/?a", "http://badexample.com/en/", "http://a.net/es/1", "http://net/fr/", "http://a.net/e", "http://user@x.com:80/en/", "http://..com/", "a://b://c.com/"]
    urls += ["http://" + ".".join(rng.choices(["www", "example", "com", "net", "a"], k=3)) + rng.choice(["", "/", "/en/", "/en", "/es/x", "/fr/?"]) for _ in range(200)]
    rows = [(i if i % 7 else None, u, "clash") for i, u in enumerate(urls)]
    got = url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"))
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, *brute_url(u, url_filters.RULES)) for i, u, _ in rows)
    assert url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), []).where("rule is not null").count() == 0
    assert url_filters.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_digests_that_collide():
    index = url_filters.RuleIndex([("block", f"h{i}.com", "/") for i in range(50)])
    same = np.full(50, 7, np.uint64)
    index.digests = same.tobytes()
    real, url_filters.xxhash.xxh64_intdigest = url_filters.xxhash.xxh64_intdigest, lambda b: 7
    try:
        names = [f"h{i}.com/".encode() for i in (3, 49, 70)]
        found = index.probe(index.mapped(), names)
    finally:
        url_filters.xxhash.xxh64_intdigest = real
    assert [index.name(f) if f >= 0 else None for f in found] == [b"h3.com/", b"h49.com/", None]


def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_base_rules(odd_docs, odd_rows, no_docs):
    rows = quality.judge(odd_docs, None).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == Counter((i, *brute_base(t)) for i, t in odd_rows)
    assert all(r.kept == (not r.base_failed) and r.probability is None for r in rows)
    assert quality.judge(no_docs, None).count() == 0
    kept = quality.keep(odd_docs, None)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in rows)


def labelled_docs(spark, rng, bad, n=400, label="quality"):
    rows, labels = [], []
    for i in range(n):
        wrong = i % 4 == 0
        rows.append((i, bad(rng) if wrong else words(rng, 60)))
        labels.append((i, int(not wrong) if label == "quality" else int(wrong)))
    labels += [(None, 1), (5000, 0), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, f"doc_id long, {label} int")


def test_quality_model(spark, no_docs):
    rng = random.Random(4)
    docs, labels = labelled_docs(spark, rng, lambda r: " ".join(f"w{r.randrange(400)}$$$ |" for _ in range(40)))
    model = quality.train(docs.where("doc_id < 300"), labels)
    held = quality.judge(docs.where("doc_id >= 300"), model).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in held)
    again = quality.train(docs.where("doc_id < 300").repartition(5), labels)
    assert np.array_equal(model.weights, again.weights)  # the same from any partitioning
    assert quality.train(docs, labels.where("quality = 1")) is None
    assert quality.train(no_docs, labels) is None
    assert quality.judge(docs.where("doc_id = 1").selectExpr("doc_id", "cast(null as string) text"), model).first().kept is False


def brute_segments(scores):
    """Ruzzo and Tompa's definition: cut out the best segment, then go on left and right of it."""
    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (found is None or total > found[0] + 1e-12):
                    found = (total, i, j + 1)
        if not found:
            return []
        return best(lo, found[1]) + [found[1:]] + best(found[2], hi)

    return best(0, len(scores))


def test_segments():
    rng = random.Random(6)
    for _ in range(200):
        scores = np.array([rng.choice([-3, -1.5, -0.4, -0.1, 0.7, 1.3, 2.9]) + rng.random() * 1e-3 for _ in range(rng.randrange(18))])
        got = toxicity.segments(scores)
        assert [(s, e) for s, e, _ in got] == brute_segments(scores)
        assert all(abs(scores[s:e].sum() - v) < 1e-9 for s, e, v in got)


def test_toxicity(spark, odd_docs, no_docs):
    rng = random.Random(8)

    def nasty(r):
        w = words(r, 60).split()
        for k in r.sample(range(60), 5):
            w[k] = r.choice(["Vile!", "nasty", "awful,", "rotten"])
        return " ".join(w)

    docs, labels = labelled_docs(spark, rng, nasty, label="toxic")
    model = toxicity.train(docs.where("doc_id < 300"), labels)
    held = toxicity.score(docs.where("doc_id >= 300"), model, passages=True).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert all((r.n_passages > 0) == (r.doc_id % 4 == 0) == bool(r.passages) and 0 <= r.score <= 1 for r in held)
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score < 0.7 for r in odd)
    assert toxicity.keep(docs, model).count() == 300
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.score(odd_docs, None).where("score <> 0").count() == 0


def test_parts(spark):
    import zlib

    rows = spark.range(200).selectExpr("id doc_id").union(spark.sql("select cast(null as long)"))
    got = {r.doc_id: r.p for r in rows.select("doc_id", toxicity.in_part("doc_id", 3).alias("p")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(200)} | {None: False}
