"""Operator 3: packing of documents into sequences by linear grouping and a few-size configuration program.

The plan is made on the histogram of piece lengths, which has at most ``capacity`` entries whatever the
size of the corpus.  It is a list of bin classes: how many sequences hold the same lengths in the same
places.  A piece finds its sequence from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dxweave.llm import common, tokens

CAPACITY = 4096
#: Lengths above this share of the capacity are grouped and rounded, smaller ones are filled in by best fit.
LARGE_SHARE = 1 / 3
#: Number of groups of equal cardinality, and so of sizes in the configuration program.
GROUPS = 64
#: Distinct chunks that a worker keeps with their ids.
CACHE = 1 << 18

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"


# ---- cutting -------------------------------------------------------------------------------


_CACHES: dict[str, tokens.Kept] = {}


def _cache(path: str) -> tokens.Kept:
    """The cache of this worker, for all its tasks."""
    return _CACHES.setdefault(path, tokens.Kept(CACHE))


def _ids(cache: tokens.Kept, path: str, parts: list[list[bytes]]) -> dict[bytes, bytes]:
    """Ids, as bytes, of at least all chunks in ``parts``; the library encodes the new ones together."""
    new = cache.missing(set().union(*parts))
    words, ids, sizes = tokens.encode_each(path, [m.decode() for m in new])
    raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
    cache.young.update((w.encode(), raw[a:b]) for w, a, b in zip(words, [0, *ends], ends))
    return cache.young


def cut(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every document, each with its rank among those of its length in its task.

    No token of this vocabulary reaches over white space, so the ids of a text are those of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path)
        task = TaskContext.get().partitionId()
        last = array("I", [end_id]).tobytes()
        seen: dict[int, int] = {}
        for batch, texts in common.pieces(batches):
            parts = [t.split() for t in texts]
            known = _ids(cache, path, parts)
            rows: list[tuple] = []
            for doc, words in zip(batch.column(0).to_pylist(), parts):
                ids = b"".join(map(known.__getitem__, words)) + last
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((doc, piece, at // 4, length, zlib.crc32(own), task, seen.get(length, 0)))
                    seen[length] = seen.get(length, 0) + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.mapInArrow(run, PIECES)


# ---- the plan ------------------------------------------------------------------------------


@dataclass
class Bins:
    """``count`` sequences that hold these lengths one after the other."""

    count: int
    lengths: list[int] = field(default_factory=list)

    def used(self) -> int:
        return sum(self.lengths)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns over few sizes with how often to use each: the linear program by column generation, rounded down.

    The basis starts with one size a pattern.  Each step prices patterns with a knapsack over the dual
    values and exchanges one column.  What rounding down leaves open is less than a bin for each size.
    """
    m = len(sizes)
    if not m:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(60 * m):
        inverse = np.linalg.inv(basis)
        duals = inverse.sum(axis=0)
        column, value = _knapsack(sizes, duals, capacity)
        if value <= 1 + 1e-9:
            break
        amounts, direction = inverse @ need, inverse @ column
        ratios = np.where(direction > 1e-12, amounts / np.where(direction > 1e-12, direction, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    amounts = np.floor(np.linalg.solve(basis, need) + 1e-9).astype(np.int64)
    return [([int(a) for a in basis[:, j]], int(amounts[j])) for j in range(m) if amounts[j] > 0]


def _knapsack(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The best pattern: how many of each size fit into the capacity with the largest total value."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for k, s in enumerate(sizes):
        if values[k] <= 1e-12:
            continue
        for start in range(s, capacity + 1, s):  # one block of s capacities may build on the block before
            block = slice(start, min(start + s, capacity + 1))
            offer = best[start - s : block.stop - s] + values[k]
            better = offer > best[block] + 1e-12
            best[block][better], last[block][better] = offer[better], k
    column, c = np.zeros(len(sizes)), capacity
    while c > 0 and last[c] >= 0:
        column[last[c]] += 1
        c -= sizes[last[c]]
    return column, float(best[capacity])


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Bins]:
    """Bin classes for so many pieces of each length."""
    full = Bins(histogram.get(capacity, 0), [capacity])
    large = sorted((n for n in histogram if capacity * LARGE_SHARE < n < capacity), reverse=True)
    small = sorted((n for n in histogram if n <= capacity * LARGE_SHARE), reverse=True)
    out = [full] if full.count else []
    queues = _groups([(n, histogram[n]) for n in large], groups)
    sizes = [q[0][0] for q in queues]
    demand = [sum(c for _, c in q) for q in queues]
    for pattern, count in configurations(sizes, demand, capacity):
        slots = [g for g, a in enumerate(pattern) for _ in range(a)]
        left = [sum(c for _, c in q) for q in queues]
        count = min([count, *(left[g] // pattern[g] for g in set(slots))])
        columns = [_take(queues[g], count) for g in slots]
        while count:
            run = min(c[0][1] for c in columns)
            out.append(Bins(run, [_take(c, run)[0][0] for c in columns]))
            count -= run
    rest: dict[int, int] = {}
    for queue in queues:
        for n, c in queue:
            rest[n] = rest.get(n, 0) + c
    for n in small:
        rest[n] = rest.get(n, 0) + histogram[n]
    return best_fit(out, sorted(rest.items(), reverse=True), capacity)


def _groups(runs: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Cuts runs of (length, count), longest first, into groups of equal cardinality."""
    total = sum(c for _, c in runs)
    out: list[list[tuple[int, int]]] = []
    queue = list(runs)
    for g in range(min(groups, total)):
        want = total * (g + 1) // min(groups, total) - total * g // min(groups, total)
        if want:
            out.append(_take(queue, want))
    return out


def _take(queue: list[tuple[int, int]], want: int) -> list[tuple[int, int]]:
    """The first ``want`` items of a list of runs, which loses them."""
    out = []
    while want:
        n, c = queue[0]
        got = min(c, want)
        out.append((n, got))
        want -= got
        if got == c:
            queue.pop(0)
        else:
            queue[0] = (n, c - got)
    return out


def best_fit(bins: list[Bins], items: list[tuple[int, int]], capacity: int) -> list[Bins]:
    """Puts runs of equal items, longest first, where the least room is left; many equal bins in one step."""
    rooms: dict[int, list[Bins]] = {}

    def put(b: Bins) -> None:
        rooms.setdefault(capacity - b.used(), []).append(b)

    for b in bins:
        put(b)
    for n, c in items:
        while c:
            room = min((r for r in rooms if r >= n and rooms[r]), default=None)
            if room is None:
                fits = capacity // n
                if c >= fits:
                    put(Bins(c // fits, [n] * fits))
                if c % fits:
                    put(Bins(1, [n] * (c % fits)))
                break
            b, fits = rooms[room].pop(), room // n
            whole = min(b.count, c // fits)
            some = c % fits if whole < b.count and c // fits == whole else 0
            if whole:
                put(Bins(whole, b.lengths + [n] * fits))
            if some:
                put(Bins(1, b.lengths + [n] * some))
            if rest := b.count - whole - (some > 0):
                put(Bins(rest, b.lengths))
            c -= whole * fits + some
    return [b for same in rooms.values() for b in same if b.count]


def layout(bins: list[Bins]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of its runs, their first sequences and their offsets."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for b in bins:
        offset = 0
        for n in b.lengths:
            runs.setdefault(n, []).append((b.count, base, offset))
            offset += n
        base += b.count
    out = {}
    for n, own in runs.items():
        counts, bases, offsets = (np.array(x, np.int64) for x in zip(*own))
        out[n] = (np.cumsum(counts) - counts, bases, offsets)
    return out


# ---- the operator --------------------------------------------------------------------------

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    A document is its ids and then ``end_id``.  Documents longer than ``capacity`` are cut into
    pieces of that length and a last one.  Pieces are stored once in the shared folder; counts by
    (length, task) give each a rank, and only the histogram of lengths, at most ``capacity`` rows,
    reaches the driver.

    Null or empty text: one piece with the end id alone.  Null ids and repeated rows are packed like
    others.  An empty table gives an empty result.  Other columns are not read.
    """
    path = tokens.vocabulary("word_bpe_49k.json", tokenizer)
    rows = common.rows(docs, doc_id, text)
    pieces = common.stored(cut(rows, path, end_id, capacity), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    ranks = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(layout(plan(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
                first, base, at = places.value[int(lengths[own[0]])]
                run = np.searchsorted(first, ranks[own], side="right") - 1
                sequence[own], offset[own] = base[run] + ranks[own] - first[run], at[run]
            columns = [batch.column(i) for i in range(5)] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    ranked = pieces.join(ranks, ["length", "task"])
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank")
    ).mapInArrow(place, SCHEMA)
