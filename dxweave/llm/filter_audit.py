"""Operator 13: how document filters interact, in every order in which they can be applied.

A table-driven byte transducer reads each text once: its state says whether the last byte was in a word, its table
says for (state, byte) whether a word begins or ends and what is counted.  The machine's state depends on
the last byte alone, so NumPy runs it over a block at a time by looking up neighbouring bytes.  Word spans go into an open
hash table that compares bytes before it calls two spans the same word.

The counts decide which filters a document fails.  What all orders of the filters remove follows from the number
of documents of each set of failed filters, so the orders are never applied to documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dxweave.llm import common

SPACES, CAPITALS, SYMBOLS = b" \t\n\x0b\x0c\r", bytes(range(ord("A"), ord("Z") + 1)), b"#$%&*|"
#: Bytes of text that go through the transducer at once; blocks end with white space, so a longer word makes a longer block.
BLOCK_BYTES = 1 << 20

MEASURES = "doc_id long, part string, n_words long, n_distinct long, n_capitals long, n_symbols long, n_chars long, digest binary"

#: Outputs of the transducer.
_BEGINS, _ENDS, _CAPITAL, _SYMBOL, _POINT = 1, 2, 4, 8, 16
_OUTSIDE, _INSIDE = 0, 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """State after each byte, and the outputs for (state, byte) at 256 * state + byte."""
    after = np.full(256, _INSIDE, np.uint16)
    after[list(SPACES)] = _OUTSIDE
    counted = np.full(256, _POINT, np.uint8)
    counted[0x80:0xC0] = 0  # the further bytes of a code point
    counted[list(CAPITALS)] |= _CAPITAL
    counted[list(SYMBOLS)] |= _SYMBOL
    outputs = np.concatenate([counted, counted])
    outputs[:256][after == _INSIDE] |= _BEGINS
    outputs[256:][after == _OUTSIDE] |= _ENDS
    return after << 8, outputs


_AFTER, _OUTPUTS = _tables()
_BYTE_HASHES = common.mix(np.arange(1, 257, dtype=np.uint64))
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            for name, base in (("up", _FACTOR), ("down", _INVERSE)):
                known = getattr(self, name)
                setattr(self, name, np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))]))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def _blocks(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts after white space; ``raw`` ends with white space."""
    start = 0
    while start < len(raw):
        end = start + BLOCK_BYTES
        if end < len(raw):
            space = np.flatnonzero(_AFTER[raw[start:end]] == _OUTSIDE)
            if len(space):
                end = start + int(space[-1]) + 1
            else:  # one word fills the block: go on to its end
                while end < len(raw) and _AFTER[raw[end - 1]] != _OUTSIDE:
                    more = np.flatnonzero(_AFTER[raw[end : end + BLOCK_BYTES]] == _OUTSIDE)
                    end = end + int(more[0]) + 1 if len(more) else min(len(raw), end + BLOCK_BYTES)
        yield start, min(end, len(raw))
        start = end


class Spans:
    """Spans and hashes of the words of ``raw``, which ends with white space, and places of what is counted."""

    def __init__(self, raw: np.ndarray):
        found: list[tuple[np.ndarray, ...]] = []
        for start, end in _blocks(raw):
            block = raw[start:end]
            state = np.empty(len(block), np.uint16)
            state[:1] = _OUTSIDE
            np.take(_AFTER, block[:-1], out=state[1:])
            state |= block
            outputs = _OUTPUTS[state]
            begin, stop = np.flatnonzero(outputs & _BEGINS), np.flatnonzero(outputs & _ENDS)
            up, down = _POWERS.to(len(block))
            # A sum over all bytes before a place; a word's own sum, moved to the block's start, is its hash.
            sums = np.cumsum(_BYTE_HASHES[block] * up)
            before = np.where(begin > 0, sums[begin - 1], np.uint64(0))
            hashes = (sums[stop - 1] - before) * down[begin]
            found.append(
                (begin + start, stop + start, hashes, np.flatnonzero(outputs & _CAPITAL) + start,
                 np.flatnonzero(outputs & _SYMBOL) + start, np.flatnonzero(outputs & _POINT == 0) + start)
            )
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 6
        self.begin, self.end, hashes, self.capitals, self.symbols, self.continued = columns
        self.hashes = hashes.astype(np.uint64)


def same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from ``a`` are those from ``b``; ``raw`` holds eight bytes more than any span ends at."""
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    same, left = np.ones(len(a), bool), np.arange(len(a))
    done = 0
    while len(left):
        differ = words[a[left] + done] ^ words[b[left] + done]
        rest = np.minimum(size[left] - done, 8).astype(np.uint64) * np.uint64(8)
        differ <<= np.uint64(64) - rest  # bytes after the span don't count; at least one byte is left
        same[left[differ != 0]] = False
        done += 8
        left = left[(differ == 0) & (size[left] > done)]
    return same


def distinct_words(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct words of each of ``n`` documents.

    All spans are offered to the slots of an open hash table at once.  An empty slot takes the first of them; a span that
    finds a word of its document with the same bytes is done, any other goes on to the next slot.
    """
    bits = max(4, int(2 * len(begin)).bit_length())
    slots = np.full(1 << bits, -1, np.int64)
    place = (common.mix(hashes ^ (doc.astype(np.uint64) * np.uint64(_FACTOR))) >> np.uint64(64 - bits)).astype(np.int64)
    size = end - begin
    waiting = np.arange(len(begin))
    while len(waiting):
        at = place[waiting]
        free = slots[at] < 0
        slots[at[free][::-1]] = waiting[free][::-1]  # of several spans for one slot the first stays
        held = slots[at]
        alike = (hashes[held] == hashes[waiting]) & (doc[held] == doc[waiting]) & (size[held] == size[waiting])
        other = np.flatnonzero(alike & (held != waiting))
        alike[other] = same_bytes(raw, begin[held[other]], begin[waiting[other]], size[waiting[other]])
        waiting = waiting[~alike]
        place[waiting] = (place[waiting] + 1) & ((1 << bits) - 1)
    return np.bincount(doc[slots[slots >= 0]], minlength=n)


def measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each text.  Texts are joined by a line break, which ends the last word of each."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    spans = Spans(raw[:-8])

    def each(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, ends), prepend=0)

    doc = np.searchsorted(ends, spans.begin, "right")
    return {
        "n_words": each(spans.begin),
        "n_distinct": distinct_words(raw, spans.begin, spans.end, spans.hashes, doc, len(texts)),
        "n_capitals": each(spans.capitals),
        "n_symbols": each(spans.symbols),
        "n_chars": sizes - each(spans.continued),
    }


def measure(docs: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, part``, the counts and a SHA-256 digest of the text for every row of ``docs``.

    ``n_words``, ``n_distinct``: runs of bytes other than ASCII white space, and different ones of them;
    ``n_capitals``: A to Z; ``n_symbols``: characters of ``SYMBOLS``; ``n_chars``: code points.  Nothing is shuffled.

    A null text is an empty one, a null part an empty string.  Null ids and repeated rows stay.  An empty table gives an
    empty result.  Other columns are not read.
    """
    common.known_to_workers(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.pieces(batches):
            counts = measure_texts(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "part": batch.column(2),
                    **{name: pa.array(values, pa.int64()) for name, values in counts.items()},
                    "digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                }
            ).select([c.split()[0] for c in MEASURES.split(", ")])

    return rows.mapInArrow(run, MEASURES)


def conditions() -> dict[str, Column]:
    """Failure conditions on ``measure``'s columns of the filters that look at one document."""
    n, c = F.col("n_words"), F.col
    return {
        "A": n < 50,
        "B": 100 * c("n_distinct") < 65 * n,
        "C": 100 * c("n_capitals") > 5 * c("n_chars"),
        "D": c("n_symbols") > 0,
    }


def failed_sets(measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``part, failed, good, toxic, n``: documents by the set of filters that they fail, as bits in the order of the letters.

    A text is repeated if a row with a smaller id has the same one; rows without an id have none that is smaller.
    Rows are counted by (text, part, failed, label) before any text is judged as a whole: of each such count the
    smallest id and its number of rows are kept, so a text that a third of all rows share is a few rows.
    """
    filters = conditions()
    bits = sum((F.when(fails, F.lit(1 << i)).otherwise(0) for i, fails in enumerate(filters.values())), F.lit(0))
    rows = measured.select("doc_id", "part", "digest", bits.alias("failed")).groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n"))
    marks = (
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), "quality", "toxic")
        .groupBy("doc_id")
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    marked = rows.join(marks.where("doc_id is not null"), "doc_id", "left").na.fill(False, ["good", "toxic"])
    counted = marked.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    least = F.min("least").over(Window.partitionBy("digest"))
    first = F.when(F.col("least") == least, F.col("n_least")).otherwise(0) + F.col("n_null")
    split = counted.withColumn("first", first).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct("failed", F.col("first").alias("n")),
            F.struct((F.col("failed") + (1 << len(filters))).alias("failed"), (F.col("n") - F.col("first")).alias("n")),
        )),
    )
    return split.where("n > 0").groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def _steps(letters: str) -> str:
    """JSON of every (filter, set of filters before it) with the orders and steps where it occurs."""
    steps: dict[tuple[int, int], list] = {}
    for order in permutations(range(len(letters))):
        before = 0
        for step, f in enumerate(order):
            steps.setdefault((1 << f, before), []).append({"filter_order": "".join(letters[i] for i in order), "step": step + 1})
            before |= 1 << f
    return json.dumps([{"own": own, "before": before, "places": places} for (own, before), places in steps.items()])


def interactions(sets: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``failed_sets``.

    A document leaves at the first filter of an order that it fails.  Among all orders each of its
    k failed filters comes first equally often, which gives ``shapley`` without a sum over orders.
    """
    cells = (
        sets.groupBy("part", "failed")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
        .groupBy("part")
        .agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))  # one for each set of filters
    )
    schema = "array<struct<own:int,before:int,places:array<struct<filter_order:string,step:int>>>>"
    steps = cells.select("part", "cells", F.inline(F.from_json(F.lit(_steps(letters)), schema)))
    own, before, none = F.col("own"), F.col("before"), F.lit(0)

    def total(value: str, chosen) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda sum, c: sum + F.when(chosen(c["failed"]), c[value]).otherwise(0))

    def fails(failed: Column, filters: Column) -> Column:
        return failed.bitwiseAND(filters) != none

    def removed(value: str) -> Column:
        return total(value, lambda m: fails(m, own) & ~fails(m, before))

    orders = factorial(len(letters))
    shapley = F.aggregate(
        "cells", F.lit(0).cast("long"),
        lambda sum, c: sum + F.when(fails(c["failed"], own), (c["n"] * orders / F.bit_count(c["failed"])).cast("long")).otherwise(0),
    )
    return steps.select(
        "part",
        F.col("places"),
        total("n", lambda m: ~fails(m, own.bitwiseOR(before))).alias("kept"),
        removed("n").alias("removed"),
        total("n", lambda m: fails(m, own) & fails(m, before)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    ).select(
        "part", F.inline("places"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The interaction of the five filters for every part of ``docs``.

    Null texts are empty ones, null parts an empty string.  A row without an id repeats no other and has no labels; rows
    with one id are documents of their own, and none of them repeats another for having the same id.  Of several labels of an id
    any that is 1 counts.  An empty table has no parts and gives an empty result.  Other columns are not read.
    """
    return interactions(failed_sets(measure(docs, part, doc_id, text), labels, doc_id))


ORACLE = r"""
WITH measured AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), firsts AS (SELECT body, min(doc_id) AS least FROM measured GROUP BY body
), judged AS (
  SELECT m.doc_id, part, [
    len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(m.body, '[^A-Z]', '', 'g')) > 5 * length(m.body),
    regexp_matches(m.body, '[#$%&*|]'), coalesce(f.least < m.doc_id, false)] AS fails
  FROM measured m JOIN firsts f ON m.body = f.body
), marks AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), sets AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM judged LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT array_to_string(o, '') AS filter_order, s.step::INTEGER AS step, o[s.step] AS f, o[1:s.step - 1] AS prev
  FROM orders, (SELECT unnest(range(1, 6)) AS step) s
), counted AS (
  SELECT part, filter_order, step, f, n, good, toxic,
         fails[ascii(f) - 64] AS own, list_has_any(failing, prev) AS earlier, len(list_filter(fails, lambda x: x)) AS k
  FROM (SELECT *, [x.f FOR x IN [{'f': 'A', 'v': fails[1]}, {'f': 'B', 'v': fails[2]}, {'f': 'C', 'v': fails[3]}, {'f': 'D', 'v': fails[4]}, {'f': 'E', 'v': fails[5]}] IF x.v] AS failing FROM sets), steps
), sums AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (WHERE NOT own AND NOT earlier) AS kept, sum(n) FILTER (WHERE own AND NOT earlier) AS removed,
    sum(n) FILTER (WHERE own AND earlier) AS redundant, sum(n) FILTER (WHERE own AND k = 1) AS unique_fails,
    sum(good) FILTER (WHERE own AND NOT earlier) AS good_lost, sum(toxic) FILTER (WHERE own AND NOT earlier) AS toxic_lost
  FROM counted GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM sums
"""
