"""Operator 11: how the tokens of two tokenizers overlap, by products of sparse incidence matrices.

A text is cut at spaces that neither tokenizer reaches across, and each different chunk is aligned once for each worker.  Tokens and bytes
form incidence matrices in compressed rows.  Gustavson's row product of one with the other's transpose gives
the tokens that overlap; where both move on at once a group ends.  Matrices of token ids and groups give, by the same product,
the ids that share a group.

1. Texts go to batch rows of the shared folder: for each document its chunks, for each chunk its pairs of ids.
2. Every batch sends the documents that hold each of its different pairs, once a pair; Spark adds them up and finds each id's most frequent pairs.
3. Every batch gets back the counts of its pairs and sums them over its documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common, tokens

#: Text in one batch row, and chunks that a worker remembers before it starts anew.
BATCH_BYTES, KNOWN_CHUNKS = 4 << 20, 1 << 18
#: New chunks that are encoded and aligned together.
AT_ONCE = 1 << 14

SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_CUT = re.compile(r"(?<! ) (?=\S)")
_ODD = re.compile(r"^ | (?!\S)")
_MARK = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def chunks(text: str) -> list[str]:
    """Cuts ``" " + text`` before single spaces that white space does not follow; chunks have lost their first space.

    The byte-level tokenizer begins a pre-token at such a space, and no entry of the piece model goes on from
    another character to a space, so the tokens of a text are those of ``" " + chunk`` for all its chunks.
    """
    if not text:
        return []
    if not _ODD.search(text):
        return text.split(" ")
    first, *others = _CUT.split(" " + text)
    return [first[1:], *others] if first else others


# ---- tokens of both tokenizers -------------------------------------------------------------


def _characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by the published rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens:
    """Ids of both tokenizers and the bytes of each id."""

    def __init__(self, byte_level: str, piece: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=piece)
        self.a.encode_special_tokens = True
        plain = _characters()
        self.a_bytes: dict[int, bytes] = {}
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(plain[c] for c in entry) if all(c in plain for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError(f"{piece}: a piece goes on from another character to a space")
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace(_MARK, " ").encode() for p in pieces]
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, entry in self.a_bytes.items():
            self.a_size[i] = len(entry)
        self.b_size = np.array([len(p) for p in self.b_bytes], np.int64)

    def encode(self, missing: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of ``" " + chunk`` for each chunk, by both; none for a chunk that either does not give back byte for byte."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in missing], add_special_tokens=False)]
        b = self.b.encode(missing, num_threads=1)
        for k, chunk in enumerate(missing):
            raw = b" " + chunk.encode()
            if raw != b"".join([self.a_bytes[i] for i in a[k]]) or raw != b"".join([self.b_bytes[i] for i in b[k]]):
                a[k] = b[k] = []
        return a, b


_TOKENS: dict[tuple[str, str], Tokens] = {}


def _tokens(byte_level: str, piece: str) -> Tokens:
    if (byte_level, piece) not in _TOKENS:
        _TOKENS[byte_level, piece] = Tokens(byte_level, piece)
    return _TOKENS[byte_level, piece]


# ---- sparse matrices -----------------------------------------------------------------------


@dataclass
class Rows:
    """A sparse matrix in compressed rows: entries ``start[i]`` to ``start[i + 1]`` belong to row i."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def compressed(row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> Rows:
    """Entries in any order to ``n`` compressed rows; entries of one place are added up."""
    order = np.lexsort((column, row))
    row, column, value = row[order], column[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
    heads = np.flatnonzero(new)
    sums = np.add.reduceat(value, heads) if len(heads) else value
    start = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(row[heads], minlength=n), out=start[1:])
    return Rows(start, column[heads], sums)


def gustavson(a: Rows, b: Rows) -> Rows:
    """The product of two matrices by rows: row i is the sum of b's rows k, each times a's entry (i, k)."""
    sizes = np.diff(b.start)[a.column]
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(b.start[a.column], sizes)
    return compressed(np.repeat(a.rows(), sizes), b.column[place], np.repeat(a.value, sizes) * b.value[place], len(a.start) - 1)


def incidence(size: np.ndarray) -> Rows:
    """Tokens that follow each other without a gap, and their bytes."""
    start = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=start[1:])
    return Rows(start, np.arange(start[-1]), np.ones(start[-1], np.int64))


def transposed(matrix: Rows, n: int) -> Rows:
    return compressed(matrix.column, matrix.rows(), matrix.value, n)


def overlaps(a_size: np.ndarray, b_size: np.ndarray) -> Rows:
    """Bytes that each A token shares with each B token, both cut from the same bytes."""
    # Every byte is in one token, so the transpose has one entry a row and is written down as it is.
    b = incidence(b_size)
    n = int(b.start[-1])
    return gustavson(incidence(a_size), Rows(np.arange(n + 1), b.rows(), b.value))


def grouped(links: Rows, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token.

    Overlaps in order go on by one token of either side, or of both where both end at the same byte: there a new group begins.
    """
    a, b = links.rows(), links.column
    cut = np.zeros(len(a), np.int64)
    cut[1:] = (a[1:] != a[:-1]) & (b[1:] != b[:-1])
    group = np.cumsum(cut)
    of_a, of_b = np.zeros(len(links.start) - 1, np.int64), np.zeros(n_b, np.int64)
    of_a[a], of_b[b] = group, group
    return of_a, of_b


# ---- aligned chunks ------------------------------------------------------------------------


@dataclass
class Aligned:
    """Chunks one after another: counts, the text of their groups, and their pairs of ids with the number of links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    text: list[str]
    start: np.ndarray
    pair: np.ndarray  #: id of A * 2^32 + id of B
    links: np.ndarray


def align_chunks(known: Tokens, missing: list[str]) -> Aligned:
    a_lists, b_lists = known.encode(missing)
    n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists))
    a, b = (np.array([i for x in lists for i in x], np.int64) for lists in (a_lists, b_lists))
    of_a, of_b = grouped(overlaps(known.a_size[a], known.b_size[b]), len(b))
    n = len(missing)
    # A chunk's end is the end of a token of both, so groups don't cross chunks.
    chunk_a, chunk_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    first = np.flatnonzero(np.diff(of_a, prepend=-1))
    n_groups = np.bincount(chunk_a[first], minlength=n)
    # Rows: the different A ids of a chunk.  Equal ids of a group are one entry with their number, so a long group stays small.
    ids, row = np.unique(chunk_a << 32 | a, return_inverse=True)
    total = int(of_a[-1]) + 1 if len(of_a) else 0
    one = np.ones(max(len(a), len(b)), np.int64)
    shared = gustavson(compressed(row, of_a, one[: len(a)], len(ids)), compressed(of_b, b, one[: len(b)], total))
    owner = ids[shared.rows()]
    start = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(owner >> 32, minlength=n), out=start[1:])
    return Aligned(n_a, n_b, n_groups, _written(n, a, b, of_a, of_b, n_groups), start, (owner & 0xFFFFFFFF) << 32 | shared.column, shared.value)


def _written(n: int, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n_groups: np.ndarray) -> list[str]:
    """The groups of each chunk as ``a1,a2|b1;a3|b2,b3``."""
    total = int(n_groups.sum())
    sides = []
    for ids, group in ((a, of_a), (b, of_b)):
        bounds = np.searchsorted(group, np.arange(total + 1)).tolist()
        names = list(map(str, ids.tolist()))
        sides.append([names[i] if j == i + 1 else ",".join(names[i:j]) for i, j in zip(bounds, bounds[1:])])
    groups = [f"{x}|{y}" for x, y in zip(*sides)]
    ends = np.cumsum(n_groups).tolist()
    return [";".join(groups[i:j]) for i, j in zip([0, *ends], ends)]


class KnownChunks:
    """Aligned chunks of a worker; forgotten all at once between batches when there are many."""

    def __init__(self, known: Tokens):
        self.tokens = known
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[str] = []
        self.counts = np.zeros((3, 0), np.int64)
        self.start, self.pair, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, wanted: set[str]) -> None:
        missing = sorted(wanted.difference(self.place))
        parts = [align_chunks(self.tokens, missing[i : i + AT_ONCE]) for i in range(0, len(missing), AT_ONCE)]
        self.place.update(zip(missing, range(len(self.place), len(self.place) + len(missing))))
        counts, starts, end = [self.counts], [self.start], len(self.pair)
        for new in parts:
            self.text += new.text
            counts.append(np.stack([new.n_a, new.n_b, new.n_groups]))
            starts.append(new.start[1:] + end)
            end += len(new.pair)
        self.counts, self.start = np.concatenate(counts, axis=1), np.concatenate(starts)
        self.pair = np.concatenate([self.pair, *(new.pair for new in parts)])
        self.links = np.concatenate([self.links, *(new.links for new in parts)])


# ---- batches -------------------------------------------------------------------------------


def _squeeze(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.compress(sink.getvalue(), 1)


def _expand(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(blob)).read_all()


def _ranges(start: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the chosen rows, and for each the number of its choice."""
    sizes = start[chosen + 1] - start[chosen]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - start[chosen], sizes), np.repeat(np.arange(len(chosen)), sizes)


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Integer sums of ``values`` for each of ``n`` owners, which come in order."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return np.diff(total[np.searchsorted(owner, np.arange(n + 1))])


def align_batch(known: KnownChunks, ids: pa.Array, texts: list[bytes], outputs: bool) -> tuple[pa.Table, pa.Table, pa.Table]:
    """Of a batch: its documents with their chunks, its chunks with their pairs, and its pairs with their documents."""
    parts = [chunks(t.decode()) for t in texts]
    if len(known.place) > KNOWN_CHUNKS:
        known.clear()
    known.learn(set().union(*parts))
    n = len(texts)
    sizes = np.array([len(p) for p in parts], np.int64)
    doc = np.repeat(np.arange(n), sizes)
    place = np.fromiter((known.place[c] for p in parts for c in p), np.int64, int(sizes.sum()))
    broken = np.bincount(doc, known.counts[0][place] == 0, n) > 0  # a chunk without tokens: the bytes differ
    place, doc = place[~broken[doc]], doc[~broken[doc]]
    sizes[broken] = 0
    n_a, n_b, n_groups = (_sums(c[place], doc, n) for c in known.counts)
    chosen, inverse = np.unique(place, return_inverse=True)
    entry, owner = _ranges(known.start, chosen)
    pairs, pair = np.unique(known.pair[entry], return_inverse=True)
    links = known.links[entry]
    start = np.searchsorted(owner, np.arange(len(chosen) + 1))
    # The documents of each pair: once for each document, however many of its chunks hold it.
    held = np.zeros(len(pairs), np.int64)
    mine = np.unique(doc * len(chosen) + inverse) if len(doc) else np.zeros(0, np.int64)
    bounds = np.searchsorted(mine, np.arange(n + 1) * max(len(chosen), 1))
    for first, last in _spans(bounds, 64):
        of, chunk = np.divmod(mine[first:last], max(len(chosen), 1))
        where, k = _ranges(start, chunk)
        held += np.bincount(np.unique(of[k] * len(pairs) + pair[where]) % max(len(pairs), 1), minlength=len(pairs))
    text = [";".join([known.text[k] for k in place[i:j]]) for i, j in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))]
    docs = {
        "doc_id": ids,
        "n_a": pa.array(n_a),
        "n_b": pa.array(n_b),
        "n_groups": pa.array(n_groups),
        "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in text]),
        "chunks": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(inverse, pa.int32())),
    }
    if outputs:
        docs["groups"] = pa.array(text, pa.large_string())
    return (
        pa.table(docs),
        pa.table({"pairs": pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(pair, pa.int32())), "links": pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(links))}),
        pa.table({"pair": pairs, "docs": held}),
    )


def _spans(bounds: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    for i in range(0, len(bounds) - 1, step):
        yield int(bounds[i]), int(bounds[min(i + step, len(bounds) - 1)])


_KNOWN: dict[tuple[str, str], KnownChunks] = {}


def _packed(rows: DataFrame, byte_level: str, piece: str, outputs: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        known = _KNOWN.setdefault((byte_level, piece), KnownChunks(_tokens(byte_level, piece)))
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            made = align_batch(known, pa.concat_arrays(ids), texts, outputs)
            return pa.RecordBatch.from_arrays([pa.array([f"{part}-{number}"]), *(pa.array([_squeeze(t)], pa.binary()) for t in made)], names=["batch", "docs", "chunks", "pairs"])

        for batch, found in common.pieces(batches):
            grown = sum(map(len, found))
            if texts and size + grown > BATCH_BYTES:
                yield row()
                ids, texts, size, number = [], [], 0, number + 1
            ids.append(batch.column(0))
            texts += found
            size += grown
        if texts:
            yield row()

    return rows.mapInArrow(run, "batch string, docs binary, chunks binary, pairs binary")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = _expand(blob.as_py()).combine_chunks()
            for part in found.to_batches(max_chunksize=1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array([name] * part.num_rows, pa.string()), part.column(0), part.column(1)], names=["batch", "pair", "docs"])


def align(
    docs: DataFrame, byte_level: str | None = None, piece: str | None = None, doc_id: str = "doc_id", text: str = "text", outputs: bool = False
) -> DataFrame:
    """Tokens, groups and links of two tokenizers for every row of ``docs``; with ``outputs`` also ``groups``.

    ``n_a, n_b``: tokens of ``" " + text`` by the byte-level tokenizer A and of ``text`` by the piece model B; ``n_groups``: runs of bytes between
    offsets where tokens of both end; ``n_links``: pairs of an A and a B token in one group.  A pair of ids counts the rows that hold it
    linked.  ``n_best``: links whose count is the highest of their A id; ``count_sum``: counts added over all links.
    ``groups`` is ``a1,a2|b1;a3|b2,b3``, its digest is in ``groups_sha256``.

    A null or empty text, and one whose bytes either tokenizer does not give back, has no tokens: zeros and an empty digest.  Null ids and repeated
    rows stay and count as documents of their own.  An empty table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    paths = tokens.vocabulary("byte_bpe_50k.json", byte_level), tokens.vocabulary("piece_bpe_32k.model", piece)
    packed = common.stored(_packed(common.rows(docs, doc_id, text), *paths, outputs), "aligned")
    held = packed.select("batch", "pairs").mapInArrow(_pairs, "batch string, pair long, docs long")
    counts = common.stored(held.groupBy("pair").agg(F.sum("docs").alias("n")), "pair-counts")
    id_a = F.shiftright("pair", 32)
    highest = counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("highest"))
    judged = counts.withColumn("a", id_a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    answers = held.select("batch", "pair").join(judged, "pair")
    schema = SCHEMA + (", groups string" if outputs else "")

    def run(batch: pa.Table, answers: pa.Table) -> pa.Table:
        made = [_answered(*(_expand(batch[c][i].as_py()) for c in ("docs", "chunks", "pairs")), answers) for i in range(batch.num_rows)]
        return pa.concat_tables(made)

    return packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, schema)


def _answered(docs: pa.Table, chunk: pa.Table, pairs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a batch with the counts of its pairs summed up."""
    count, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
    at = np.searchsorted(pairs["pair"].to_numpy(), answers["pair"].to_numpy())
    count[at], best[at] = answers["n"].to_numpy(), answers["best"].to_numpy()

    def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
        array = column.combine_chunks()
        return array.offsets.to_numpy(), array.values.to_numpy(), len(array)

    offsets, pair, n = lists(chunk["pairs"])
    links = lists(chunk["links"])[1]
    owner = np.repeat(np.arange(n), np.diff(offsets))
    per_chunk = [_sums(v, owner, n) for v in (links, links * best[pair], links * count[pair])]
    offsets, places, n = lists(docs["chunks"])
    owner = np.repeat(np.arange(n), np.diff(offsets))
    n_links, n_best, count_sum = (pa.array(_sums(v[places], owner, n)) for v in per_chunk)
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups"])
    for name, values in (("n_links", n_links), ("n_best", n_best), ("count_sum", count_sum)):
        out = out.append_column(name, values)
    out = out.append_column("groups_sha256", docs["groups_sha256"])
    if "groups" in docs.column_names:
        out = out.append_column("groups", docs["groups"].cast(pa.string()))
    return out
