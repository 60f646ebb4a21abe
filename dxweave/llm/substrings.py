"""Operator 7: removal of repeated passages, with a count-min prefilter and an exact second pass.

Texts are packed once into batch rows of the shared folder, bucketed by the task that wrote them, so that
answers come back to a batch without moving a text.  Windows of words live in slices of hash space:

1. every batch sends each slice a sparse sketch of its windows; a slice merges the sketches and
   answers which cells count two or more documents.  Counts are never too low, so no window is lost;
2. windows whose cells all count two or more go to their slice with a 128-bit key and the batch's smallest
   document; the slice answers for which a smaller document exists elsewhere;
3. every batch removes the words that such windows cover.

A batch speaks for all its documents, so a passage that a third of all documents share is one
entry for each batch.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dxweave.llm import common

WINDOW = 13
#: Text in one batch row, windows in one slice, and the size of a slice's sketch: cells in each of its rows.
BATCH_BYTES, SLICE_WINDOWS = 4 << 20, 2 << 20
DEPTH, WIDTH = 2, 1 << 24
#: Buckets of the table of batches for each task that wrote it, and at most.
BUCKETS_PER_TASK, MOST_BUCKETS = 4, 20_000

REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_LAST = np.iinfo(np.int64).max
_CELL_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _expand(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _bits(flags: np.ndarray) -> bytes:
    return _squeeze(np.packbits(flags))


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(_expand(blob, np.uint8), count=n).astype(bool)


# ---- batches -------------------------------------------------------------------------------


def _packed(docs: DataFrame, text: int, order: int, window: int) -> DataFrame:
    """Rows of batches: task, number in the task, number of windows, and the documents as compressed Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []
        size = windows = 0

        def row() -> pa.RecordBatch:
            whole = pa.Table.from_batches(waiting)
            whole = whole.sort_by(whole.column_names[order]).combine_chunks()  # nulls last
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(whole)
            columns = [pa.array([part]), pa.array([number]), pa.array([windows]), pa.array([sink.getvalue().to_pybytes()])]
            return pa.RecordBatch.from_arrays(columns, names=["part", "batch", "windows", "blob"])

        for batch, texts in common.pieces(batches, text):
            grown = sum(map(len, texts))
            if waiting and size + grown > BATCH_BYTES:
                yield row()
                waiting, size, windows, number = [], 0, 0, number + 1
            waiting.append(batch)
            size += grown
            windows += sum(max(0, len(t.split()) - window + 1) for t in texts)
        if waiting:
            yield row()

    return docs.mapInArrow(run, "part long, batch long, windows long, blob binary")


def _bucketed(packed: DataFrame, tasks: int) -> DataFrame:
    """The batches as a table of the shared folder, bucketed by the task that made them."""
    spark, name = packed.sparkSession, f"batches_{uuid.uuid4().hex}"
    buckets = max(1, min(BUCKETS_PER_TASK * tasks, MOST_BUCKETS))
    writer = packed.write.format("parquet").bucketBy(buckets, "part").option("path", common.scratch(spark, name))
    writer.saveAsTable(name)
    return spark.table(name)


@dataclass
class Windows:
    """Distinct windows of a batch in the order of their keys."""

    rows: pa.Table
    parts: list[list[bytes]]  #: words of each document; none where they are not asked for
    ids: np.ndarray  #: of documents; a null id counts as larger than any
    start: np.ndarray  #: place of every window's first word among all words of the batch
    doc: np.ndarray  #: its document's row
    inverse: np.ndarray  #: its distinct window
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray  #: smallest document id that holds a distinct window
    several: np.ndarray  #: whether more than one row does


def _windows(blob: bytes, known: common.WordHashes, text: int, order: int, window: int, keep: bool = False) -> Windows:
    rows = pa.ipc.open_stream(blob).read_all()
    parts = [t.split() for t in common.text_bytes(rows.column(text).combine_chunks())]
    known.trim()
    places = known.places([w for p in parts for w in p])
    ids = rows.column(order).combine_chunks().cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    if not keep:
        parts = []  # a word object takes more than its text
    n = max(0, len(doc) - window + 1)
    start = np.flatnonzero(doc[:n] == doc[window - 1 :][:n])
    low, high = (common.windows(h[places], window, m)[start] for h, m in zip(known.arrays(), (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)))
    doc = doc[start]
    by = np.argsort(low, kind="stable")
    if ((low[by][1:] == low[by][:-1]) & (high[by][1:] != high[by][:-1])).any():
        by = np.lexsort((high, low))  # stable as well: documents of a window stay in order
    new = np.ones(len(by), bool)
    new[1:] = (low[by][1:] != low[by][:-1]) | (high[by][1:] != high[by][:-1])
    inverse = np.empty(len(by), np.int64)
    inverse[by] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(by)) - 1 if len(heads) else heads
    first, last = doc[by[heads]], doc[by[tails]]
    return Windows(rows, parts, ids, start, doc, inverse, low[by[heads]], high[by[heads]], ids[first], first != last)


def _slices(low: np.ndarray, slices: int) -> np.ndarray:
    """Ends of the slices in sorted keys."""
    of = ((low >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(slices + 1))


def _cells(low: np.ndarray, row: int) -> np.ndarray:
    return (common.mix(low ^ np.uint64(_CELL_SEEDS[row])) & np.uint64(WIDTH - 1)).astype(np.uint32)


def _each_batch(table: pa.Table) -> Iterator[tuple[int, bytes]]:
    for batch in table.sort_by("batch").select(["batch", "blob"]).to_batches(max_chunksize=1):
        yield batch.column(0)[0].as_py(), batch.column(1)[0].as_py()


# ---- first pass: the sketch ----------------------------------------------------------------


def _send_cells(w: Windows, slices: int) -> Iterator[dict]:
    """The sparse sketch of a batch: for each slice and row its cells, and which of them count two or more."""
    ends = _slices(w.low, slices)
    for s in range(slices):
        own = slice(ends[s], ends[s + 1])
        if ends[s] == ends[s + 1]:
            continue
        for row in range(DEPTH):
            cells, place = np.unique(_cells(w.low[own], row), return_inverse=True)
            count = np.bincount(place, 1 + w.several[own], len(cells))
            yield {"slice": s, "row": row, "cells": _squeeze(np.diff(cells, prepend=np.uint32(0))), "twice": _bits(count >= 2)}


def _merge_sketches(table: pa.Table) -> pa.Table:
    """Adds up the sketches of a slice, counts stopping at two, and answers each batch."""
    out: dict[str, list] = {"part": [], "batch": [], "slice": [], "row": [], "often": []}
    for row in range(DEPTH):
        entries = [e for e in table.to_pylist() if e["row"] == row]
        count = np.zeros(WIDTH, np.uint8)
        cells = [np.cumsum(_expand(e["cells"], np.uint32), dtype=np.uint32) for e in entries]
        for e, c in zip(entries, cells):
            count[c] = np.minimum(count[c] + 1 + _flags(e["twice"], len(c)), 2)
        for e, c in zip(entries, cells):
            for name in ("part", "batch", "slice", "row"):
                out[name].append(e[name])
            out["often"].append(_bits(count[c] >= 2))
    return pa.table(out, schema=pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("slice", pa.int32()), ("row", pa.int32()), ("often", pa.binary())]))


def _estimated_repeated(w: Windows, slices: int, answers: dict[tuple[int, int], bytes]) -> np.ndarray:
    """Places of the distinct windows that count two or more in every row of the sketch."""
    ends, out = _slices(w.low, slices), []
    for s in range(slices):
        if ends[s] < ends[s + 1]:
            often = np.ones(ends[s + 1] - ends[s], bool)
            for row in range(DEPTH):
                cells, place = np.unique(_cells(w.low[ends[s] : ends[s + 1]], row), return_inverse=True)
                often &= _flags(answers[s, row], len(cells))[place]
            out.append(np.flatnonzero(often) + ends[s])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


# ---- second pass: exact groups -------------------------------------------------------------


def _smaller_elsewhere(table: pa.Table) -> pa.Table:
    """For each batch of a slice the windows that a smaller document of any batch holds too."""
    entries = table.to_pylist()
    low, high, first = (np.concatenate([_expand(e[n], k) for e in entries]) for n, k in (("low", np.uint64), ("high", np.uint64), ("first", np.int64)))
    by = np.lexsort((first, high, low))
    new = np.ones(len(by), bool)
    new[1:] = (low[by][1:] != low[by][:-1]) | (high[by][1:] != high[by][:-1])
    least = np.empty(len(by), np.int64)
    least[by] = first[by[np.flatnonzero(new)]][np.cumsum(new) - 1]
    beaten, at, answers = least < first, 0, []
    for e in entries:
        place = np.cumsum(_expand(e["place"], np.int64))
        answers.append(_squeeze(np.diff(place[beaten[at : at + len(place)]], prepend=0)))
        at += len(place)
    return pa.table(
        {"part": [e["part"] for e in entries], "batch": [e["batch"] for e in entries], "beaten": answers},
        schema=pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("beaten", pa.binary())]),
    )


def _covered(w: Windows, beaten: np.ndarray, window: int) -> list[np.ndarray]:
    """For each document which of its words are to go."""
    found = np.zeros(len(w.low), bool)
    found[beaten] = True
    gone = found[w.inverse] | (w.ids[w.doc] > w.first[w.inverse])
    edges = np.zeros(sum(map(len, w.parts)) + 1, np.int64)
    np.add.at(edges, w.start[gone], 1)
    np.add.at(edges, w.start[gone] + window, -1)
    covered = np.cumsum(edges)[:-1] > 0
    return np.split(covered, np.cumsum([len(p) for p in w.parts])[:-1]) if w.parts else []


# ---- the operator --------------------------------------------------------------------------


def _answered(docs: DataFrame, text: int, order: int, window: int):
    """The table of batches, and for each which of its windows a smaller document elsewhere holds."""
    table = _bucketed(_packed(docs, text, order, window), docs.rdd.getNumPartitions())
    total = table.agg(F.sum("windows")).first()[0] or 0
    slices = max(1, -(-total // SLICE_WINDOWS))
    seeds = (11, 12)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.WordHashes(seeds)
        for batch in batches:
            for part, number, blob in zip(*(batch.column(i) for i in range(3))):
                w = _windows(blob.as_py(), known, text, order, window)
                rows = [e | {"part": part.as_py(), "batch": number.as_py()} for e in _send_cells(w, slices)]
                kinds = [("slice", pa.int32()), ("row", pa.int32()), ("part", pa.int64()), ("batch", pa.int64()), ("cells", pa.binary()), ("twice", pa.binary())]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    often = (
        table.select("part", "batch", "blob")
        .mapInArrow(sketch, "slice int, row int, part long, batch long, cells binary, twice binary")
        .groupBy("slice")
        .applyInArrow(_merge_sketches, "part long, batch long, slice int, row int, often binary")
    )
    sent = pa.schema([("slice", pa.int32()), ("part", pa.int64()), ("batch", pa.int64()), ("place", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("first", pa.binary())])

    def candidates(batches: pa.Table, answers: pa.Table) -> pa.Table:
        known, rows = common.WordHashes(seeds), []
        by_batch: dict[int, dict] = {}
        for e in answers.to_pylist():
            by_batch.setdefault(e["batch"], {})[e["slice"], e["row"]] = e["often"]
        for number, blob in _each_batch(batches):
            w = _windows(blob, known, text, order, window)
            places = _estimated_repeated(w, slices, by_batch.get(number, {}))
            ends = _slices(w.low[places], slices)
            for s in np.flatnonzero(np.diff(ends)):
                own = places[ends[s] : ends[s + 1]]
                rows.append({
                    "slice": int(s), "part": batches["part"][0].as_py(), "batch": number, "place": _squeeze(np.diff(own, prepend=0)),
                    "low": _squeeze(w.low[own]), "high": _squeeze(w.high[own]), "first": _squeeze(w.first[own]),
                })
        return pa.Table.from_pylist(rows, sent)

    beaten = (
        table.select("part", "batch", "blob")
        .groupBy("part")
        .cogroup(often.groupBy("part"))
        .applyInArrow(candidates, "slice int, part long, batch long, place binary, low binary, high binary, first binary")
        .groupBy("slice")
        .applyInArrow(_smaller_elsewhere, "part long, batch long, beaten binary")
    )
    return table.select("part", "batch", "blob"), beaten, seeds


def _apply(docs: DataFrame, text: int, order: int, window: int, finish, schema) -> DataFrame:
    table, beaten, seeds = _answered(docs, text, order, window)

    def run(batches: pa.Table, answers: pa.Table) -> pa.Table:
        known, out = common.WordHashes(seeds), []
        by_batch: dict[int, list[np.ndarray]] = {}
        for e in answers.to_pylist():
            by_batch.setdefault(e["batch"], []).append(np.cumsum(_expand(e["beaten"], np.int64)))
        for number, blob in _each_batch(batches):
            w = _windows(blob, known, text, order, window, keep=True)
            found = by_batch.get(number, [])
            out.append(finish(w, _covered(w, np.concatenate(found) if found else np.zeros(0, np.int64), window)))
        return pa.concat_tables(out)

    return table.groupBy("part").cogroup(beaten.groupBy("part")).applyInArrow(run, schema)


def report(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``.

    A word goes if a window of ``window`` consecutive words that covers it has the same words as a window
    of a document with a smaller id.  All windows are judged on the input.  Kept words are joined by a space.

    Null and empty texts, and those shorter than a window, lose nothing.  Rows with the same id lose
    nothing to each other; a null id counts as larger than any other.  An empty table gives an empty
    result.  Other columns are not read.
    """

    def finish(w: Windows, covered: list[np.ndarray]) -> pa.Table:
        kept = [b" ".join([x for x, c in zip(p, own) if not c] if own.any() else p) for p, own in zip(w.parts, covered)]
        return pa.table(
            [
                w.rows.column(0),
                pa.array([len(p) for p in w.parts], pa.int64()),
                pa.array([int(c.sum()) for c in covered], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    return _apply(common.rows(docs, doc_id, text), 1, 0, window, finish, REPORT)


def rewrite(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns; texts that lose words become their kept words joined by a space.

    Texts that lose nothing stay as they are, null included.  Rules and special cases are those of ``report``.
    """
    common.known_to_workers(docs.sparkSession)
    names = docs.columns
    place, order = names.index(text), names.index(doc_id)

    def finish(w: Windows, covered: list[np.ndarray]) -> pa.Table:
        texts = w.rows.column(place).to_pylist()
        for i, own in enumerate(covered):
            if own.any():
                texts[i] = b" ".join([x for x, c in zip(w.parts[i], own) if not c]).decode()
        return w.rows.set_column(place, w.rows.schema.field(place), pa.array(texts, w.rows.schema.field(place).type))

    nullable = StructType.fromJson(docs.schema.jsonValue())
    for field in nullable:
        field.nullable = True
    return _apply(docs, place, order, window, finish, nullable)


#: DuckDB SQL for the report over ``documents``.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, i, hash(array_to_string(words[i : i + 12], ' ')) AS h, array_to_string(words[i : i + 12], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)
), f AS (
  SELECT k, min(doc_id) AS first FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)
), c AS (
  SELECT DISTINCT w.doc_id, w.i + j AS place
  FROM w JOIN f ON w.k = f.k AND f.first < w.doc_id, range(0, 13) AS r(j)
), k AS (
  SELECT d.doc_id, len(words) AS n_words, x.i, words[x.i] AS word
  FROM d, LATERAL (SELECT unnest(range(1, len(d.words) + 1)) AS i) x
), kept AS (
  SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.i) FILTER (c.place IS NULL) AS t, count(c.place) AS n_removed
  FROM k LEFT JOIN c ON c.doc_id = k.doc_id AND c.place = k.i GROUP BY k.doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(kept.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
