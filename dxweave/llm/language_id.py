"""Operator 12: language of a text in two steps: its family, then the language within the family.

One-versus-rest linear support vector machines tell the families apart.  Within a family every two languages
have a machine of their own, and the languages take votes.  All machines see the same hashed character n-grams of letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common, labelled

# Language codes by family.  A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "pl", "cs", "sk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
    "celtic": ("ga", "cy", "gd", "br"),
    "austronesian": ("id", "ms", "tl", "jv"),
}

#: Bounds of the sample that the machines are fitted on: documents of a language, languages (the most frequent), and
#: documents of all languages together that the machines for families see.
SAMPLE_PER_LANGUAGE, MOST_LANGUAGES, FAMILY_SAMPLE = 1_000, 64, 6_000
#: Share of the sample that calibrates a machine instead of fitting it.
CALIBRATION = 0.2
#: Hashed n-grams, and the longest n-gram in code points; word borders count as one.
BITS, LONGEST = 15, 4
BLOCK_BYTES = 1 << 20
COST, EPOCHS, RARE = 1.0, 20, 1e-5

UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double"
_NONE = 1 << BITS
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")


# ---- features ------------------------------------------------------------------------------


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    points = [chr(c) for c in range(0x110000)]
    lower = [p.lower() for p in points]
    return np.array([ord(x[0]) if p.isalpha() else 0 for p, x in zip(points, lower)], np.uint32)


def _cut(text: bytes) -> Iterator[bytes]:
    """Parts of at most ``BLOCK_BYTES`` that end with white space, where words allow; n-grams never reach across it."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        end = next((start + m.start() + 1 for m in reversed(list(_SPACE.finditer(text[start : start + BLOCK_BYTES])))), None)
        if end is None:
            found = _SPACE.search(text, start + BLOCK_BYTES)
            end = found.end() if found else len(text)
        yield text[start:end]
        start = end
    if start < len(text):
        yield text[start:]


@dataclass
class Grams:
    """n-grams of a block of texts: one row for each length, ``_NONE`` where none begins; texts in order."""

    doc: np.ndarray
    start: np.ndarray
    grams: np.ndarray

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Sum over the n-grams of each text of this block; ``weights`` has one entry more for ``_NONE``."""
        return np.add.reduceat(weights[self.grams].sum(axis=0), self.start)

    def only(self, docs: np.ndarray) -> Grams | None:
        """The texts whose document is marked in ``docs``."""
        here = docs[self.doc]
        if not here.any():
            return None
        sizes = np.diff(np.append(self.start, self.grams.shape[1]))
        kept = sizes[here]
        return Grams(self.doc[here], np.cumsum(kept) - kept, self.grams[:, np.repeat(here, sizes)])


def _grams(doc: list[int], texts: list[bytes]) -> Grams:
    points = np.frombuffer(("\n" + "\n".join([t.decode() for t in texts]) + "\n").encode("utf-32-le"), "<u4")
    sizes = np.array([len(t.decode()) for t in texts]) + 1
    letters = _letters()[points]
    first = np.zeros(len(points), bool)
    first[np.cumsum(sizes) - sizes] = True
    kept = (letters != 0) | first
    kept[1:] |= letters[:-1] != 0
    kept[-1] = True
    letters, first = letters[kept].astype(np.uint64), first[kept]
    n = len(letters) - 1  # the last border begins nothing
    padded = np.concatenate([letters, np.zeros(LONGEST, np.uint64)])
    grams = np.full((LONGEST, n), _NONE, np.int32)
    value, inner = np.zeros(n, np.uint64), np.ones(n, bool)
    for length in range(1, LONGEST + 1):
        last = padded[length - 1 : length - 1 + n]
        value = common.mix(value * np.uint64(0x9E3779B97F4A7C15) + last + np.uint64(length))
        # Borders stand at the ends only, and beside a letter.
        whole = inner & ((last != 0) | (padded[:n] != 0)) if length <= 2 else inner
        if length == 1:
            whole = last != 0
        grams[length - 1, whole] = (value[whole] >> np.uint64(64 - BITS)).astype(np.int32)
        if length > 1:
            inner = inner & (last != 0)
    return Grams(np.array(doc), np.flatnonzero(first[:n]), grams)


def blocks(texts: list[bytes]) -> Iterator[Grams]:
    """The n-grams of ``texts`` in blocks of bounded size; a long text is spread over several."""
    doc: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        for part in _cut(text):
            if parts and size + len(part) > BLOCK_BYTES:
                yield _grams(doc, parts)
                doc, parts, size = [], [], 0
            doc.append(i)
            parts.append(part)
            size += len(part)
    if parts:
        yield _grams(doc, parts)


def _vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a text and how often they occur."""
    counts = np.zeros(_NONE + 1, np.int64)
    for block in blocks([text]):
        counts += np.bincount(block.grams.ravel(), minlength=_NONE + 1)
    index = np.flatnonzero(counts[:_NONE])
    return index.astype(np.uint16), counts[index].astype(np.float32)


# ---- machines ------------------------------------------------------------------------------


@dataclass
class Machine:
    weights: np.ndarray  #: of the share of each n-gram; the last is 0
    bias: float
    slope: float
    intercept: float

    def probability(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        return labelled.sigmoid(self.slope * (sums / np.maximum(n, 1) + self.bias) + self.intercept)


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent.

    A row is the shares of its n-grams, each divided by the root of the n-gram's mean share, so that rare n-grams count too.
    Both classes weigh the same.
    """
    mean = np.full(_NONE, RARE)
    shares = [(index, count / count.sum()) for index, count in rows]
    for index, share in shares:
        mean[index] += share / len(shares)
    scale = 1 / np.sqrt(mean)
    shares = [(index, share * scale[index]) for index, share in shares]
    norm = np.sqrt(np.mean([share @ share for _, share in shares]))
    shares = [(index, share / norm) for index, share in shares]
    positive = (y > 0).mean()
    damp = 1 / (2 * COST * np.where(y > 0, 0.5 / positive, 0.5 / (1 - positive)))
    curve = np.array([share @ share for _, share in shares]) + 1 + damp
    weights, bias, alpha = np.zeros(_NONE), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            index, share = shares[i]
            slope = y[i] * (weights[index] @ share + bias) - 1 + damp[i] * alpha[i]
            new = max(alpha[i] - slope / curve[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights[index] += step * share
                bias += step
                alpha[i] = new
    return weights * scale / norm, bias


def _fit(table: pa.Table) -> pa.Table:
    """Fits and calibrates the machine whose rows these are; without both classes on the fitted side there is none."""
    table = table.sort_by([("doc_id", "ascending"), ("grams", "ascending"), ("counts", "ascending")])
    rows = [(np.frombuffer(a, np.uint16), np.frombuffer(b, "<f4").astype(float)) for a, b in zip(table["grams"].to_pylist(), table["counts"].to_pylist())]
    y = np.where(table["positive"].to_numpy(), 1.0, -1.0)
    held = table["fold"].to_numpy() < CALIBRATION
    if len(np.unique(y[~held])) < 2:
        held[:] = False
    fitted = np.flatnonzero(~held)
    weights, bias = fit_machine([rows[i] for i in fitted], y[fitted])
    slope, intercept = 2.0, 0.0
    if len(np.unique(y[held])) == 2:
        margins = np.array([weights[rows[i][0]] @ rows[i][1] / rows[i][1].sum() + bias for i in np.flatnonzero(held)])
        share = (y[held] > 0).mean()
        balance = np.where(y[held] > 0, 0.5 / share, 0.5 / (1 - share))
        slope, intercept = labelled.logistic(margins[:, None], (y[held] > 0).astype(float), balance, ridge=1e-2)
        if slope <= 0:
            slope, intercept = 2.0, 0.0
    return pa.table(
        {"machine": table["machine"][:1], "weights": pa.array([weights.astype("<f4").tobytes()], pa.binary()), "bias": [float(bias)], "slope": [float(slope)], "intercept": [float(intercept)]}
    )


@dataclass
class Model:
    families: dict[str, list[str]]  #: languages of each family
    first: dict[str, Machine] = field(default_factory=dict)  #: family against all others
    second: dict[tuple[str, str], Machine] = field(default_factory=dict)  #: first language against second


def _family_of(families: dict[str, tuple[str, ...]], language: str) -> str:
    return next((name for name, members in families.items() if language in members), f"only {language}")


def train(
    docs: DataFrame, families: dict[str, tuple[str, ...]] | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model | None:
    """Machines fitted on a bounded sample of ``docs`` with a language, or None if there is no such document.

    Rows are chosen by a hash of their id, up to about ``SAMPLE_PER_LANGUAGE`` of each of the ``MOST_LANGUAGES`` most frequent
    languages.  Their n-grams are counted over whole texts where the texts are; each machine is fitted in a task of its own
    on counts of at most 2^15 n-grams a row.  The driver gets 128 KB for each machine.  Rows without an id, a letter or
    a language are not used.
    """
    common.known_to_workers(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("doc_id is not null and lang is not null and text is not null")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], min(1.0, SAMPLE_PER_LANGUAGE / r["count"])).otherwise(share)
    chosen = rows.where(labelled.unit_hash(F.col("doc_id"), "language") < share)
    chosen = chosen.select("doc_id", "text", "lang", labelled.unit_hash(F.col("doc_id"), "fold").alias("fold"), labelled.unit_hash(F.col("doc_id"), "family").alias("pick"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.pieces(batches):
            found = [_vector(t) for t in texts]
            out = pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 2, 3, 4)), pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([b.astype("<f4").tobytes() for _, b in found], pa.binary())],
                names=["doc_id", "lang", "fold", "pick", "grams", "counts"],
            )
            yield out.filter(pa.array([len(a) > 0 for a, _ in found]))

    sample = common.stored(chosen.mapInArrow(vectors, "doc_id long, lang string, fold double, pick double, grams binary, counts binary"), "language-sample")
    found = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    if not found:
        return None
    model = Model({})
    for language in sorted(found):
        model.families.setdefault(_family_of(families or FAMILIES, language), []).append(language)
    # For each machine the documents it sees, and which of them are positive.
    few = F.col("pick") < min(1.0, FAMILY_SAMPLE / sum(found.values()))
    machines = [(name, few, F.col("lang").isin(members)) for name, members in model.families.items()] if len(model.families) > 1 else []
    for members in model.families.values():
        machines += [((a, b), F.col("lang").isin(a, b), F.col("lang") == a) for a, b in combinations(members, 2)]
    if not machines:
        return model
    roles = [F.when(sees, F.struct(F.lit(k).alias("machine"), positive.alias("positive"))) for k, (_, sees, positive) in enumerate(machines)]
    given = sample.select("doc_id", "fold", "grams", "counts", F.inline(F.array_compact(F.array(*roles))))
    fitted = given.groupBy("machine").applyInArrow(_fit, "machine int, weights binary, bias double, slope double, intercept double")
    for r in fitted.collect():
        machine = Machine(np.append(np.frombuffer(r["weights"], "<f4"), np.float32(0)), r["bias"], r["slope"], r["intercept"])
        key = machines[r["machine"]][0]
        (model.first if isinstance(key, str) else model.second)[key] = machine
    return model


# ---- prediction ----------------------------------------------------------------------------


def _sums(parts: list[Grams], weights: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    for part in parts:
        np.add.at(out, part.doc, part.sums(weights))
    return out


def predict_texts(model: Model | None, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    The score is the share of the family's probability among all families, times the mean probability of the language
    against the others of its family.
    """
    n = len(texts)
    parts = list(blocks(texts))
    counts = _sums(parts, np.append(np.ones(_NONE, np.float32), np.float32(0)), n)
    known = counts > 0
    languages, score = np.full(n, UNKNOWN, object), np.zeros(n)
    if model is None:
        return languages.tolist(), score
    names = list(model.families)
    if model.first:
        chances = np.stack([model.first[name].probability(_sums(parts, model.first[name].weights, n), counts) for name in names])
    else:
        chances = np.ones((1, n))
    best = chances.argmax(axis=0)
    score[known] = (chances.max(axis=0) / np.maximum(chances.sum(axis=0), 1e-300))[known]
    for f, name in enumerate(names):
        members = model.families[name]
        own = known & (best == f)
        languages[own] = members[0]
        if len(members) == 1 or not own.any():
            continue
        inside = [p for p in (part.only(own) for part in parts) if p is not None]
        votes, chance = np.zeros((len(members), n)), np.zeros((len(members), n))
        for i, j in combinations(range(len(members)), 2):
            machine = model.second.get((members[i], members[j]))
            p = machine.probability(_sums(inside, machine.weights, n), counts) if machine else np.full(n, 0.5)
            votes[i] += p >= 0.5
            votes[j] += p < 0.5
            chance[i] += p
            chance[j] += 1 - p
        winner = (votes + chance / len(members)).argmax(axis=0)  # the chances decide among equal votes
        languages[own] = np.array(members, object)[winner[own]]
        score[own] *= chance[winner[own], np.flatnonzero(own)] / (len(members) - 1)
    return languages.tolist(), np.clip(score, 0.0, 1.0)


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, from its text alone.

    A text without a letter, empty and null ones included, is ``und`` with score 0; so is every text without a model.
    Null ids and repeated rows stay.  An empty table gives an empty result.  Other columns are not read.  One
    pass, nothing is shuffled; the machines are broadcast, at most 128 KB for each pair of ``MOST_LANGUAGES`` languages.
    """
    rows = common.rows(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.pieces(batches):
            languages, score = predict_texts(shared.value, texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, SCHEMA)
