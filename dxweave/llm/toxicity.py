"""Operator 8: toxicity by maximum-scoring segments over token log-odds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common, labelled

#: Labelled rows of each class that counts and calibration are taken from: the documented bound of the sample.
SAMPLE_PER_CLASS = 8_000
#: Share of the sample that only calibrates.
CALIBRATION = 0.3
#: Tokens are counted in 2**BITS hashed places: the bound of the broadcast table (8 MB).
BITS = 20
#: Dirichlet prior of every place in use (Jeffreys), and the z-score from which a token's log-odds count.
PRIOR, SIGNIFICANT = 0.5, 3.0
#: A segment is a toxic passage if so many segments as good or fewer are expected by chance in a clean document.
MAX_EXPECTED = 0.05
#: A document is called toxic from this probability on.
PREDICT_AT = 0.7
#: Beyond this a document feature says no more.
MOST = 40.0
#: What a token without a toxic form costs a segment.
COST = 0.02

_EDGES = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))

SCHEMA = "doc_id long, score double, predicted int, n_passages int"
PASSAGES = ", passages array<struct<first: int, words: int, score: double, expected: double>>"


#: Beginnings of a word that count as tokens beside the word itself: inflected and compound forms share them.
STEMS = (5, 6, 7, 8)


class Tokens(common.WordHashes):
    """Words lower-cased and without ASCII punctuation at their ends, each with the places of its forms."""

    @staticmethod
    def column():
        return []  # a row of places for each word

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        plain = word.decode().lower().encode().strip(_EDGES)
        forms = [plain, *(b"%d-" % n + plain[:n] if len(plain) > n else plain for n in STEMS)]
        self.hashes[0].append([common.xxhash.xxh64_intdigest(f) >> (64 - BITS) for f in forms])
        return place


def _tokens(known: Tokens, parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of a piece: places of their forms by row, and the row of every token."""
    known.trim()
    places = known.places([w for p in parts for w in p])
    return np.array(known.hashes[0], np.int64).reshape(-1, 1 + len(STEMS)), places


def _token_scores(model: Model, known: Tokens, parts: list[list[bytes]]) -> np.ndarray:
    """A token counts as the most toxic of its forms, one without a toxic form costs a little."""
    forms, places = _tokens(known, parts)
    best = model.scores[forms].max(axis=1, initial=0.0)
    return np.where(best > 0, best, -COST)[places]


@dataclass
class Model:
    #: Log-odds of every place, 0 if in doubt or not toxic.
    scores: np.ndarray
    #: Extreme-value parameters: a clean document of n tokens has K * n * exp(-rate * S) segments of score S or more.
    rate: float = 1.0
    k: float = 0.1
    #: Weights of the two document features and an intercept.
    beta: np.ndarray | None = None

    def expected(self, score: np.ndarray | float, n: int) -> np.ndarray | float:
        return self.k * max(n, 1) * np.exp(-self.rate * score)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), in linear time.

    Only positive scores can begin or end a segment, so the scan steps over them and takes the sums between
    from a running total.  A candidate keeps the totals before and after it.  It is joined with the
    nearest earlier candidate that starts lower, if it also ends higher than that one.
    """
    hot = np.flatnonzero(scores > 0)
    if not len(hot):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple[int, int, float, float]] = []
    links: list[int] = []
    for h in hot.tolist():
        start, end, low, high = h, h + 1, float(total[h]), float(total[h + 1])
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = links[j]
            if j < 0 or kept[j][3] >= high:
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:], links[j:]
            j = len(kept) - 1
        kept.append((start, end, low, high))
        links.append(j)
    return [(s, e, b - a) for s, e, a, b in kept]


# ---- fitting -------------------------------------------------------------------------------


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Log-odds of each place with a Dirichlet prior; 0 if not clearly toxic."""
    total = PRIOR * max(int(((toxic + clean) > 0).sum()), 1)
    toxic_side, clean_side = (np.log((n + PRIOR) / (n.sum() + total - n)) for n in (toxic, clean))
    delta = toxic_side - clean_side
    z = delta / np.sqrt(1 / (toxic + PRIOR) + 1 / (clean + PRIOR))
    return np.where(z >= SIGNIFICANT, delta, 0.0)


def _rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * score)) = 1; 1 if scores have no such root."""
    use = share > 0
    scores, share = scores[use], share[use] / share[use].sum()
    if not (scores > 0).any() or (scores * share).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (share * np.exp(np.minimum(high * scores, 700))).sum() < 1:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        value = (share * np.exp(np.minimum(middle * scores, 700))).sum()
        low, high = (middle, high) if value < 1 else (low, middle)
    return (low + high) / 2


def _features(model: Model, found: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
    """Minus log of how many segments like the best are expected by chance, and the same summed over all that stand out."""
    if not found:
        return 0.0, 0.0
    unlikely = -np.log(np.maximum(model.expected(np.array([s for *_, s in found]), n), 1e-300))
    unlikely = np.maximum(unlikely, 0.0)
    return min(float(unlikely.max()), MOST), min(float(unlikely.sum()), MOST)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """Token log-odds and calibration from a bounded sample of labelled rows; None if a class is missing.

    Counts are of documents that hold a token, for tokens come in bursts.  They are made in tasks, summed
    by place and collected: at most ``2**BITS`` rows of three numbers.
    """
    spark = docs.sparkSession
    rows = common.stored(labelled.sample(docs, labels, label, SAMPLE_PER_CLASS, doc_id, text), "toxicity-sample")
    if rows.select("label").distinct().count() < 2:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        totals = np.zeros((2, 1 << BITS), np.int64)
        for batch, texts in common.pieces(batches):
            parts = [t.split() for t in texts]
            forms, places = _tokens(known, parts)
            at = 0
            for p, toxic in zip(parts, batch.column(2).to_pylist()):
                totals[toxic][np.unique(forms[places[at : at + len(p)]])] += 1
                at += len(p)
        used = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[1][used]), pa.array(totals[0][used])], names=["place", "toxic", "clean"])

    counted = (
        rows.where(F.col("fold") >= CALIBRATION)
        .mapInArrow(count, "place long, toxic long, clean long")
        .groupBy("place")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toArrow()
    )
    toxic, clean = np.zeros(1 << BITS), np.zeros(1 << BITS)
    toxic[counted["place"].to_numpy()], clean[counted["place"].to_numpy()] = counted["toxic"].to_numpy(), counted["clean"].to_numpy()
    model = Model(log_odds(toxic, clean).astype(np.float64))
    shared = spark.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch, texts in common.pieces(batches):
            parts = [t.split() for t in texts]
            scores, found, at = _token_scores(shared.value, known, parts), [], 0
            hot = []
            for p in parts:
                own = scores[at : at + len(p)]
                found.append([s for *_, s in segments(own)])
                hot.append(own[own > 0])
                at += len(p)
            columns = [
                pa.array(found, pa.list_(pa.float64())), pa.array(hot, pa.list_(pa.float64())),
                pa.array([len(p) for p in parts], pa.int64()), batch.column(2), batch.column(3),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["found", "hot", "n", "label", "weight"])

    held = rows.where(F.col("fold") < CALIBRATION)
    held = held.mapInArrow(best, "found array<double>, hot array<double>, n long, label int, weight double").collect()
    hot = np.array([h for r in held if r["label"] == 0 for h in r["hot"]])
    n_clean = sum(r["n"] for r in held if r["label"] == 0)
    model.rate = _rate(np.append(hot, -COST), np.append(np.ones(len(hot)), max(n_clean - len(hot), 1)))
    quiet = [(max(r["found"], default=0.0), r["n"]) for r in held if r["label"] == 0]
    if quiet:  # maximum likelihood of K for a known rate; documents without a positive token say little
        model.k = max(1e-6, len(quiet) / max(sum(n * np.exp(-model.rate * s) for s, n in quiet), 1e-9))
    x = np.array([_features(model, [(0, 0, s) for s in r["found"]], r["n"]) for r in held]).reshape(-1, 2)
    y = np.array([r["label"] for r in held], float)
    if len(set(y)) == 2:
        model.beta = labelled.logistic(x, y, np.array([r["weight"] for r in held]))
    return model


# ---- the operator --------------------------------------------------------------------------


def _judged(texts: list[bytes], known: Tokens, model: Model | None) -> tuple[np.ndarray, list[list[dict]]]:
    """Probability of every text, and its toxic passages."""
    parts = [t.split() for t in texts]
    if model is None or model.beta is None:
        return np.zeros(len(parts)), [[] for _ in parts]
    scores, at = _token_scores(model, known, parts), 0
    x, listed = np.zeros((len(parts), 2)), []
    for i, p in enumerate(parts):
        found = segments(scores[at : at + len(p)])
        at += len(p)
        x[i] = _features(model, found, len(p))
        likely = [(s, e, v, float(model.expected(v, len(p)))) for s, e, v in found]
        listed.append([{"first": s, "words": e - s, "score": v, "expected": x} for s, e, v, x in likely if x < MAX_EXPECTED])
    return labelled.sigmoid(x @ model.beta[:2] + model.beta[2]), listed


def score(
    docs: DataFrame,
    model: Model | None,
    predict_at: float = PREDICT_AT,
    doc_id: str = "doc_id",
    text: str = "text",
    passages: bool = False,
) -> DataFrame:
    """``doc_id, score, predicted, n_passages`` for every row; with ``passages`` also where they are.

    Every token has its log-odds as a score.  All maximal segments are found in linear time; a segment
    counts as a passage if fewer than ``MAX_EXPECTED`` of its score are expected in a clean text of that length.
    The best segment and all together give the document's probability.  One pass, no shuffle.

    Null and empty texts have no passage and get the probability of a text without any.  Without
    a model (no labels of both classes) every score is 0.  Null ids and repeated rows stay.  An empty
    table gives an empty result.  Other columns are not read.
    """
    rows = common.rows(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("first", pa.int32()), ("words", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch, texts in common.pieces(batches):
            probability, listed = _judged(texts, known, shared.value)
            columns = {
                "doc_id": batch.column(0),
                "score": pa.array(probability),
                "predicted": pa.array((probability >= predict_at).astype(np.int32)),
                "n_passages": pa.array([len(found) for found in listed], pa.int32()),
            }
            if passages:
                columns["passages"] = pa.array(listed, pa.list_(kind))
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, SCHEMA + (PASSAGES if passages else ""))


def keep(docs: DataFrame, model: Model | None, predict_at: float = PREDICT_AT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` does not call toxic, with all their columns; one pass."""
    common.known_to_workers(docs.sparkSession)
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch, texts in common.pieces(batches, place):
            yield batch.filter(pa.array(_judged(texts, known, shared.value)[0] < predict_at))

    return docs.mapInArrow(run, docs.schema)


def in_part(doc_id: str, modulus: int, remainder: int = 1):
    """Whether the crc32 of an id as text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
