"""Operator 6: token counts by a two-tier lookup on the map side."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from dxweave.llm import common, tokens

#: Rows from which the frequent chunks are learned; they only decide what is looked up faster, never a result.
SAMPLE_ROWS = 1024
#: Entries of the broadcast table, and the longest chunk in it: together its bound (about 4 MB).
FREQUENT, FREQUENT_CHARS = 1 << 16, 32
#: Entries of a worker's own cache.
CACHE = 1 << 18

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(
    docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    The count is what the tokenizers library gives for the whole text without added special tokens.
    A text is cut where pre-tokens begin; a chunk's count comes from a broadcast table of frequent
    chunks, else from the worker's cache, else from the library, which encodes the misses of a piece
    in one call.  Nothing is shuffled.

    Null or empty text: 0 bytes, 0 tokens.  Null ids and repeated rows stay, one result per row.
    An empty table gives an empty result.  Other columns are not read.
    """
    path = tokens.vocabulary("byte_bpe_50k.json", tokenizer)
    rows = common.rows(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(rows, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = _worker_cache(path)
        for batch, texts in common.pieces(batches):
            totals = _totals([t.decode() for t in texts], path, shared.value, inner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals]),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(count, SCHEMA)


_CACHES: dict[str, dict[str, int]] = {}


def _worker_cache(path: str) -> dict[str, int]:
    return _CACHES.setdefault(path, {})


def _frequent(rows: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the most frequent chunks of a few rows; of bounded size."""
    seen: Counter[str] = Counter()
    for row in rows.select("text").limit(SAMPLE_ROWS).toLocalIterator():
        seen.update(c for c in tokens.chunks(row.text or "")[1:] if len(c) <= FREQUENT_CHARS)
    chosen = [c for c, _ in seen.most_common(FREQUENT)]
    return dict(zip(chosen, _encode(chosen, path)))


def _encode(chosen: list[str], path: str) -> list[int]:
    found = tokens.library(path).encode_batch_fast([" " + c for c in chosen], add_special_tokens=False)
    return [len(e.ids) for e in found]


def _totals(texts: list[str], path: str, frequent: dict[str, int], cache: dict[str, int]) -> list[int]:
    parts = [tokens.chunks(t) for t in texts]
    firsts = tokens.library(path).encode_batch_fast([p[0] for p in parts], add_special_tokens=False)
    if len(cache) > CACHE:
        cache.clear()
    missing = set().union(*(p[1:] for p in parts)).difference(frequent)
    missing.difference_update(cache)
    missing = list(missing)
    cache.update(zip(missing, _encode(missing, path)))
    return [
        len(first.ids) + sum([frequent[c] if c in frequent else cache[c] for c in part[1:]])
        for first, part in zip(firsts, parts)
    ]
