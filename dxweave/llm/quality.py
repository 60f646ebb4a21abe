"""Operator 1: quality rules.  Fixed base rules, then a calibrated logistic regression on hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common, labelled

#: Labelled rows of each class that the model is fitted on: the documented bound of the sample.
SAMPLE_PER_CLASS = 8_000
#: Shards of the sample that are fitted apart and averaged, and the share of it that is kept for calibration.
SHARDS, CALIBRATION = 8, 0.2
#: Weights, of which words with word pairs and character n-grams have one half each.
BITS = 18
CHAR_GRAM = 4
#: All pairs of a word with itself are one n-gram.
SAME_WORD = np.uint64(0x5A5A5A5A5A5A5A5A)
EPOCHS, RATE = 4, 0.3
#: A document is kept if its calibrated probability of good quality is at least this.
KEEP_AT = 0.5

MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, probability double"
)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    intercept: float = 0.0

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return labelled.sigmoid(self.slope * margins + self.intercept)


# ---- features ------------------------------------------------------------------------------


class Features:
    """Hashed n-grams of the texts of a piece: document and weight number of every occurrence."""

    def __init__(self):
        self.hashes = common.WordHashes()

    def words(self, parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The document and the hash of every word."""
        self.hashes.trim()
        flat = [w for p in parts for w in p]
        places = self.hashes.places(flat)
        return np.repeat(np.arange(len(parts)), [len(p) for p in parts]), self.hashes.arrays()[0][places]

    @staticmethod
    def word_grams(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - BITS + 1)
        pairs = common.windows(hashes, 2)
        pairs[hashes[:-1] == hashes[1:]] = SAME_WORD
        same = doc[:-1] == doc[1:] if len(doc) else np.zeros(0, bool)
        grams = np.concatenate([common.mix(hashes), pairs[same]]) >> shift
        return np.concatenate([doc, doc[:-1][same]]), grams.astype(np.int64)

    @staticmethod
    def char_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in texts])
        raw = np.frombuffer(b"".join(texts), np.uint8)
        n = max(0, len(raw) - CHAR_GRAM + 1)
        gram = np.zeros(n, np.uint32)
        for j in range(CHAR_GRAM):
            gram |= raw[j : j + n].astype(np.uint32) << np.uint32(8 * j)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        whole = doc[:n] == doc[CHAR_GRAM - 1 :][:n]
        gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS + 1)
        return doc[:n][whole], gram[whole].astype(np.int64) + (1 << (BITS - 1))


def _means(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, n) / np.maximum(np.bincount(doc, minlength=n), 1)


# ---- fitting -------------------------------------------------------------------------------


def _fit_shard(table: pa.Table) -> pa.Table:
    """AdaGrad over the rows of a shard in the order of their ids."""
    table = table.sort_by("doc_id")
    texts = common.text_bytes(table.column("text").combine_chunks())
    y = table.column("label").to_numpy().astype(float)
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    features, rows = Features(), []
    for t in texts:
        doc, hashes = features.words([t.split()])
        columns = []
        for _, gram in (features.word_grams(doc, hashes), features.char_grams([t])):
            index, count = np.unique(gram, return_counts=True)
            columns.append((index, count / max(count.sum(), 1)))
        rows.append(tuple(np.concatenate(c) for c in zip(*columns)))
    weights, seen, bias, bias_seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-12), 0.0, 1e-12
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            index, value = rows[i]
            slope = float(balance[i] * (labelled.sigmoid(weights[index] @ value + bias) - y[i]))
            seen[index] += (slope * value) ** 2
            weights[index] -= RATE * slope * value / np.sqrt(seen[index])
            bias_seen += slope**2
            bias -= RATE * slope / bias_seen**0.5
    return pa.table({"weights": pa.array([weights.astype("<f4").tobytes()], pa.binary()), "bias": [bias]})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """The averaged and calibrated model, or None if a class has no labelled document.

    The sample is bounded by ``SAMPLE_PER_CLASS``; every shard of it is fitted in a task of its own.  Only
    the weights of the shards and a margin for each calibration row reach the driver.
    """
    spark = docs.sparkSession
    rows = common.stored(labelled.sample(docs, labels, label, SAMPLE_PER_CLASS, doc_id, text), "quality-sample")
    fitted = (
        rows.where(F.col("fold") >= CALIBRATION)
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)))
        .groupBy("shard")
        .applyInArrow(_fit_shard, "weights binary, bias double")
        .collect()
    )
    if not fitted or rows.select("label").distinct().count() < 2:
        return None
    weights = np.mean([np.frombuffer(r["weights"], "<f4") for r in fitted], axis=0, dtype=np.float64).astype(np.float32)
    model = Model(weights, float(np.mean([r["bias"] for r in fitted])))
    shared = spark.sparkContext.broadcast(model)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch, texts in common.pieces(batches):
            parts = [t.split() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_margins(shared.value, features, texts, *features.words(parts))), batch.column(2), batch.column(3)],
                names=["margin", "label", "weight"],
            )

    held = rows.where(F.col("fold") < CALIBRATION).mapInArrow(margins, "margin double, label int, weight double").toPandas()
    if held["label"].nunique() == 2:
        model.slope, model.intercept = labelled.logistic(
            held[["margin"]].to_numpy(), held["label"].to_numpy(float), held["weight"].to_numpy()
        )
    return model


def _margins(model: Model, features: Features, texts: list[bytes], doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.full(len(texts), model.bias)
    for own, gram in (features.word_grams(doc, hashes), features.char_grams(texts)):
        out += _means(own, model.weights[gram], len(texts))
    return out


# ---- base rules ----------------------------------------------------------------------------


def _duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``REPEAT_WINDOW`` words that occur twice or more."""
    seen: dict[tuple, int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    for i in range(len(words) - REPEAT_WINDOW + 1):
        first = seen.setdefault(tuple(words[i : i + REPEAT_WINDOW]), i)
        if first != i:
            for k in (first, i):
                covered[k] += 1
                covered[k + REPEAT_WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def _may_repeat(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Documents in which two windows have the same hash: all that repeat one, so the others need no count."""
    window = common.windows(hashes, REPEAT_WINDOW)
    own = doc[: len(window)]
    whole = own == doc[REPEAT_WINDOW - 1 :][: len(window)]
    own, window = own[whole], window[whole]
    order = np.lexsort((window, own))
    same = (window[order][1:] == window[order][:-1]) & (own[order][1:] == own[order][:-1])
    return np.bincount(own[order][1:][same], minlength=n) > 0


# ---- the operator --------------------------------------------------------------------------


@dataclass
class Verdicts:
    n_words: np.ndarray
    repeated: np.ndarray
    failed: np.ndarray
    probability: np.ndarray | None
    kept: np.ndarray


def _verdicts(texts: list[bytes], features: Features, model: Model | None, keep_at: float) -> Verdicts:
    parts = [t.split() for t in texts]
    doc, hashes = features.words(parts)
    n_words = np.array([len(p) for p in parts], np.int64)
    repeated = np.zeros(len(parts), np.int64)
    for i in np.flatnonzero(_may_repeat(doc, hashes, len(parts))):
        repeated[i] = _repeated_words(parts[i])
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
    probability = model.probability(_margins(model, features, texts, doc, hashes)) if model else None
    return Verdicts(n_words, repeated, failed, probability, ~failed & (probability >= keep_at if model else True))


def judge(
    docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts, base verdict, calibrated probability and final verdict for every row of ``docs``.

    Words are runs of bytes other than ASCII white space.  ``base_failed``: fewer than 20 words, or
    more than 30 percent of them in repeated windows of eight words.  ``kept`` is false for those, else whether the
    probability of good quality reaches ``keep_at``.  Without a model the probability is null and only
    base rules reject.  One pass, nothing is shuffled.

    Null and empty texts have no words and fail.  Null ids and repeated rows stay.  An empty table gives
    an empty result.  Other columns are not read.
    """
    rows = common.rows(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch, texts in common.pieces(batches):
            v = _verdicts(texts, features, shared.value, keep_at)
            columns = [
                batch.column(0),
                pa.array(v.n_words),
                pa.array([len(t.translate(None, _SPACE).decode()) for t in texts], pa.int64()),
                pa.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], pa.int64()),
                pa.array([_duplicate_lines(t) for t in texts], pa.int64()),
                pa.array(v.repeated),
                pa.array(v.failed),
                pa.array(v.kept),
                pa.nulls(len(texts), pa.float64()) if v.probability is None else pa.array(v.probability),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)


def keep(docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns; judged and filtered in one pass."""
    common.known_to_workers(docs.sparkSession)
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch, texts in common.pieces(batches, place):
            yield batch.filter(pa.array(_verdicts(texts, features, shared.value, keep_at).kept))

    return docs.mapInArrow(run, docs.schema)
