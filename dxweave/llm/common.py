"""Small helpers that the operators of this subpackage share.

All of them treat a null text as an empty one, keep only the columns they are told to read (so
columns of the caller can never clash with their own), and work on bounded pieces of an Arrow batch.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a worker takes apart at once; a single longer text is taken whole.
PIECE_BYTES = 2 << 20
#: Ids (8 MB of them) that may be broadcast instead of shuffling texts.
BROADCAST_IDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def known_to_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package also where only the driver's path holds it (local mode)."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, (root, environment.get("PYTHONPATH"))))


def rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The two columns that an operator on texts reads."""
    known_to_workers(df.sparkSession)
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder that the session names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_ids(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``df`` joined with a stored table of distinct ``doc_id`` by a semi or anti join.

    Texts are wide and ids are not: up to ``BROADCAST_IDS`` counted ids go to the texts, beyond that the two are
    shuffled.  Either way gives the same rows.
    """
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, "doc_id", how)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts batches into runs of rows with at most ``PIECE_BYTES`` of text, or one longer row."""
    for batch in batches:
        sizes = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)).astype(np.int64)
        start = size = 0
        for i, n in enumerate([*sizes.tolist(), PIECE_BYTES]):
            if i > start and size + n > PIECE_BYTES or i == len(sizes) > start:
                piece = batch.slice(start, i - start)
                yield piece, text_bytes(piece.column(text))
                start, size = i, 0
            size += n


class WordHashes(dict):
    """word -> its place in ``hashes``; a word is hashed once.  Emptied between pieces when it is large."""

    LIMIT = 1 << 18

    def __init__(self, seeds: tuple[int, ...] = (0,)):
        super().__init__()
        self.seeds = seeds
        self.hashes = [self.column() for _ in seeds]

    @staticmethod
    def column():
        return array("Q")  # eight bytes a word

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        for seed, hashes in zip(self.seeds, self.hashes):
            hashes.append(xxhash.xxh64_intdigest(word, seed))
        return place

    def places(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def arrays(self) -> list[np.ndarray]:
        return [np.array(h, np.uint64) for h in self.hashes]

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()
            self.hashes = [self.column() for _ in self.seeds]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(hashes: np.ndarray, width: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """One hash for each run of ``width`` consecutive hashes; depends on their order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), 1
    for j in range(width):
        out += hashes[j : j + n] * np.uint64(factor)
        factor = factor * multiplier % (1 << 64)
    return mix(out)
