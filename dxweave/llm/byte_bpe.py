"""Operator 4: byte-level BPE by recursive queries of an in-process DuckDB in every partition.

Spark deals out the texts; each task cuts them into words and keeps the results of words in a bounded
cache.  New words of a piece become rows (word, position, token).  A recursive query joins them with the
merge table and contracts the leftmost pair of minimum rank of each word until no pair merges.  An ordered
aggregation turns ids back into bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from dxweave.llm import common, tokens

#: Distinct words, and chunks of words, in either generation of a worker's caches.
CACHE = 1 << 18
#: Words longer than this contract all occurrences of a safe minimum pair in one step.
LONG = 48

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Of every word its ids in order, and the bytes they stand for.  One step: the pair of minimum rank that is leftmost merges.  A word is one row with its ids in order; its pairs become rows for the
#: join with the merge table only, and a hash aggregate finds the first.  A word without a pair to merge comes out once more and is done.
_SHORT = """
WITH RECURSIVE s(word, ids, done) AS (
  SELECT word, ids, false FROM short
  UNION ALL
  SELECT s.word, if(best IS NULL, ids, ids[:best % 4294967296 - 1] || [best // 4294967296] || ids[best % 4294967296 + 2:]), best IS NULL
  FROM s LEFT JOIN (
    SELECT word, min(m.rank * 4294967296 + n.pos) AS best FROM (
      SELECT word, unnest(ids[:-2]) * 4294967296 + unnest(ids[2:]) AS pair, unnest(range(1, len(ids))) AS pos FROM s WHERE NOT done
    ) n JOIN merges m ON n.pair = m.pair GROUP BY word
  ) USING (word) WHERE NOT done
), t AS (
  SELECT word, unnest(range(len(ids))) AS pos, unnest(ids) AS id FROM s WHERE done
), bytes AS (
  SELECT word, string_agg(hex, '' ORDER BY pos) AS hex FROM t JOIN vocabulary USING (id) GROUP BY word
)
SELECT word, array_to_string(ids, ' '), unhex(hex) FROM s JOIN bytes USING (word) WHERE done
"""

#: The same for long words, with a row for each token; of a safe pair all occurrences merge at once, in runs like aaaa every second one.
_LONG = """
WITH RECURSIVE t(word, pos, id, step) AS (
  SELECT word, pos, id, 0 FROM words
  UNION ALL
  SELECT word, pos, if(taken, rank, id), if(best IS NULL, -1, step + 1) FROM (
    SELECT *, coalesce(lag(taken) OVER (PARTITION BY word ORDER BY pos), false) AS eaten FROM (
      SELECT *, hit AND (safe AND row_number() OVER (PARTITION BY word, hit, i - k ORDER BY pos) % 2 = 1 OR k = 1) AS taken
      FROM (
        SELECT *, row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS k FROM (
          SELECT *, coalesce(rank = best, false) AS hit FROM (
            SELECT n.*, m.rank, m.safe, min(m.rank) OVER (PARTITION BY n.word) AS best
            FROM (
              SELECT word, pos, id, step, id * 4294967296 + lead(id) OVER w AS pair, row_number() OVER w AS i
              FROM t WHERE step >= 0 WINDOW w AS (PARTITION BY word ORDER BY pos)
            ) n LEFT JOIN merges m ON n.pair = m.pair
          )
        )
      )
    )
  ) WHERE NOT eaten
)
SELECT word, string_agg(id, ' ' ORDER BY pos) AS ids, unhex(string_agg(hex, '' ORDER BY pos)) AS decoded
FROM t JOIN vocabulary USING (id) WHERE step < 0
GROUP BY word
"""


class Encoder:
    """Merge tables in a DuckDB of this worker, and a bounded cache of chunks."""

    def __init__(self, path: str, pattern: str):
        self.pattern = regex.compile(pattern)
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        merges = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        left, right, rank = (np.array(c, np.int64) for c in zip(*merges))
        # A pair is safe if no later pair with its merged token has a lower rank: then its occurrences can't disturb each other.
        lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "300MB"})
        self._table("merges", pair=(left << 32) + right, rank=rank, safe=lowest[rank] > rank)
        self._table("vocabulary", id=np.array(list(ranks.values()), np.int64), hex=[t.hex() for t in ranks])
        self.known_words, self.known_chunks = tokens.Kept(CACHE), tokens.Kept(CACHE)

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def words(self, words: list[str]) -> list[tuple[str, bytes]]:
        """Ids joined by spaces and decoded bytes of each word."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        starts = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(raw)), sizes)
        ids = self.single[np.frombuffer(b"".join(raw), np.uint8)]
        out = [("", b"")] * len(words)
        short, long = (sizes > 0) & (sizes <= LONG), sizes[word] > LONG
        lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes[short])).astype(np.int32), ids[short[word]])
        self._table("short", word=np.flatnonzero(short).astype(np.int32), ids=lists)
        self._table("words", word=word[long].astype(np.int32), pos=(np.arange(len(word)) - starts[word])[long].astype(np.int32), id=ids[long])
        for query in (_SHORT, _LONG) if long.any() else (_SHORT,):
            for i, listed, decoded in self.db.execute(query).fetchall():
                out[i] = listed, decoded
        return out

    def chunks(self, parts: list[list[str]]) -> tuple[dict[str, tuple[str, bytes]], dict[str, tuple[str, bytes]]]:
        """Results of all first chunks, and of all others, which have a space before them."""
        firsts = {p[0] for p in parts}
        missing = self.known_chunks.missing(set().union(*(p[1:] for p in parts)))
        wanted = [(c, self.pattern.findall(c)) for c in firsts] + [(c, self.pattern.findall(" " + c)) for c in missing]
        new = self.known_words.missing({w for _, found in wanted for w in found})
        known = self.known_words.young
        if new:
            known.update(zip(new, self.words(new)))
        whole: dict[str, tuple[str, bytes]] = {}
        for k, (c, found) in enumerate(wanted):
            own = [known[w] for w in found]
            value = own[0] if len(own) == 1 else (" ".join([i for i, _ in own]), b"".join([d for _, d in own]))
            (whole if k < len(firsts) else self.known_chunks.young)[c] = value
        return whole, self.known_chunks.young


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode_decode(
    docs: DataFrame,
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    doc_id: str = "doc_id",
    text: str = "text",
    outputs: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row; with ``outputs`` also ``ids, decoded``.

    Ids are those that a byte-pair encoder with these ranks gives for every match of ``pattern``;
    special strings are ordinary text.  Digests are of the decimal ids joined by a space, and
    of the bytes decoded from the ids.  Nothing is shuffled.

    Null or empty text: no ids, digests of the empty string.  Null ids and repeated rows stay.  An
    empty table gives an empty result.  Other columns are not read.
    """
    path = tokens.vocabulary("byte_bpe_50k.tiktoken", ranks)
    rows = common.rows(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch, texts in common.pieces(batches):
            parts = [tokens.chunks(t.decode()) for t in texts]
            firsts, others = encoder.chunks(parts)
            listed, decoded = [], []
            for p in parts:
                found = [firsts[p[0]], *map(others.__getitem__, p[1:])]
                listed.append(" ".join([ids for ids, _ in found if ids]))
                decoded.append(b"".join([d for _, d in found]))
            counts = [x.count(" ") + bool(x) for x in listed]
            columns = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if outputs:
                columns += [pa.array([[int(i) for i in x.split()] for x in listed], pa.list_(pa.int64())), pa.array(decoded)]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, SCHEMA + (", ids array<long>, decoded binary" if outputs else ""))
