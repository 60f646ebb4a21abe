"""Operator 9: embedding near-dedup by rotated binary codes with correction factors.

A vector is rotated at random and kept as the signs of its components, with its inner product with them.
The signs give an unbiased estimate of an inner product and a bound of its error.  Pairs whose upper bound
falls short of the threshold are left out; all others are computed again in double precision.

Pairs to estimate share a band: the signs of a few components of one of several other rotations.  Equal
vectors are one vector with a weight.  Groups that share a band are cut into blocks, and pairs of blocks are tasks, so
a large group of near copies is spread, and only counts and a few links for each vector leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, ShortType, StructType

from dxweave.llm import common
from dxweave.llm.components import components

COSINE = 0.93
#: Bands and signs in each.  Two vectors at the threshold agree in a sign with probability 1 - acos(0.93)/pi = 0.88,
#: so they share no band with probability (1 - 0.88**12)**32, about 5e-4; closer ones far less.
BANDS, BAND_BITS = 32, 12
#: Width of the error bound in standard deviations.
SIGMAS = 4.0
#: Vectors in a block of a group that shares a band.
BLOCK = 512
#: Groups up to this size are compared together.
SMALL = 32

SCHEMA = "vec_id long, n_links long, component_id long, kept boolean"


@cache
def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


class Codes:
    """Sign codes of unit vectors and their correction factors."""

    def __init__(self, unit: np.ndarray):
        self.rotated = unit @ rotation(unit.shape[1], 1)
        self.signs = np.where(self.rotated >= 0, 1.0, -1.0) / np.sqrt(unit.shape[1])
        self.aligned = np.maximum((self.rotated * self.signs).sum(axis=1), 1e-9)
        spread = np.sqrt(np.maximum(1 - self.aligned**2, 0)) / self.aligned
        self.margin = SIGMAS * spread / np.sqrt(max(unit.shape[1] - 1, 1))

    def table(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """For each query (row) and code (column) the largest cosine that the estimate allows."""
        return (self.rotated[queries] @ self.signs[codes].T) / self.aligned[codes] + self.margin[codes]

    def pairs(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The same for pairs."""
        products = np.einsum("ij,ij->i", self.rotated[queries], self.signs[codes])
        return products / self.aligned[codes] + self.margin[codes]


def _unit(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    largest = np.abs(values).max(axis=1, keepdims=True) if values.size else np.ones((len(values), 1))
    values = values / np.where(largest > 0, largest, 1)  # squares of large components stay finite
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _coded(embedding: DataType) -> StructType:
    out = StructType().add("rep", "long").add("weight", "long").add("label", "string").add("embedding", embedding)
    return out.add("bands", ArrayType(ShortType()))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every vector with its band codes."""
    for batch in batches:
        vectors = batch.column(3)
        sizes = np.diff(vectors.offsets.to_numpy())
        out = np.zeros((len(vectors), BANDS), np.int16)
        for dimension in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == dimension)
            unit = _unit(vectors.take(pa.array(own)))
            turns = [unit @ rotation(dimension, 100 + k) for k in range(-(-BANDS * BAND_BITS // dimension))]
            signs = np.concatenate(turns, axis=1)[:, : BANDS * BAND_BITS] >= 0
            out[own] = signs.reshape(len(own), BANDS, BAND_BITS) @ (1 << np.arange(BAND_BITS))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(list(out), pa.list_(pa.int16()))], names=[*batch.schema.names, "bands"]
        )


def _candidates(codes: Codes, group: np.ndarray, kind: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a group whose upper bound reaches the threshold.

    ``kind`` 0: pairs within a block; 1 and 2: pairs of a row of one block with one of the other.  Rows are in
    order of their groups.  Small groups are done together, by distance in that order; large ones as matrices.
    """
    first, second = [], []
    sizes = np.diff(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)))
    size = np.repeat(sizes, sizes)
    for k in range(1, min(SMALL, sizes.max(initial=0))):
        i = np.flatnonzero((group[:-k] == group[k:]) & (size[:-k] <= SMALL) & ((kind[:-k] != kind[k:]) | (kind[:-k] == 0)))
        i = i[codes.pairs(i, i + k) >= cosine]
        first.append(i)
        second.append(i + k)
    ends = np.cumsum(sizes)
    for end, n in zip(ends[sizes > SMALL], sizes[sizes > SMALL]):
        rows = np.arange(end - n, end)
        left, right = rows[kind[rows] < 2], rows[kind[rows] != 1]
        i, j = np.nonzero(codes.table(left, right) >= cosine)
        i, j = left[i], right[j]
        once = (i < j) | (kind[i] == 1)
        first.append(i[once])
        second.append(j[once])
    return (np.concatenate(first), np.concatenate(second)) if first else (np.zeros(0, int), np.zeros(0, int))


def _local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that the links reach."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(cosine: float):
    """Links of whole groups: how many each vector has, and with the smallest vector they reach within the rows at hand."""

    def links(table: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.list_value_length(table["embedding"])
        for size in pc.unique(sizes):  # vectors of different lengths have no cosine
            yield of_one_length(table.filter(pc.equal(sizes, size)))

    def of_one_length(table: pa.Table) -> pa.RecordBatch:
        group, kind, band = (table[c].to_numpy() for c in ("gid", "kind", "band"))
        label, rep, weight = table["label"].combine_chunks().dictionary_encode().indices.to_numpy(), table["rep"].to_numpy(), table["weight"].to_numpy()
        unit, bands = _unit(table["embedding"].combine_chunks()), np.array(table["bands"].to_pylist(), np.int64)
        i, j = _candidates(Codes(unit), group, kind, cosine)
        use = (label[i] == label[j]) & (band[i] == band[j])  # should two groups have the same hash
        earlier = ((bands[i] == bands[j]) & (np.arange(bands.shape[1]) < band[i][:, None])).any(axis=1)
        i, j = i[use & ~earlier], j[use & ~earlier]  # a pair counts in the first band it shares
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
        i, j = i[near], j[near]
        vectors, row = np.unique(rep, return_inverse=True)
        linked = np.bincount(row[i], weight[j], len(vectors)) + np.bincount(row[j], weight[i], len(vectors))
        own = np.flatnonzero(linked > 0)
        least = vectors[_local_components(len(vectors), row[i], row[j])]
        return pa.RecordBatch.from_arrays([pa.array(vectors[own]), pa.array(linked[own].astype(np.int64)), pa.array(least[own])], names=["rep", "links", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            group = batch.column(0).to_numpy()
            if not len(group):
                continue
            if waiting and waiting[-1].column(0)[-1].as_py() != group[0]:
                yield from links(pa.Table.from_batches(waiting))
                waiting = []
            last = int(np.flatnonzero(group != group[-1])[-1]) + 1 if (group != group[-1]).any() else 0
            if last:  # the last group may go on in the next batch
                yield from links(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield from links(pa.Table.from_batches(waiting))

    return run


def near_copies(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors with equal labels are linked if their cosine in double precision is at least ``cosine``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id that links reach.
    No pair below the threshold is linked; a pair at it is missed with a probability of about 5e-4.

    Vectors that are null, empty, zero or hold a null or non-finite component, those with a null label and
    those with a null id link with nothing.  Vectors of different lengths do not link.  Repeated rows
    link with each other; should rows with the same smallest id hold different vectors, one of them is compared
    for all.  An empty table gives an empty result.  Other columns are not read.
    """
    common.known_to_workers(vectors.sparkSession)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("string").alias("label")
    )
    usable = rows.where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    # Equal vectors become one; zeros of either sign are equal, and print alike.
    usable = common.stored(usable.withColumn("embedding", F.transform("embedding", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))), "vectors")
    keyed = usable.withColumn("key", F.sha2(F.concat_ws(",", "label", F.col("embedding").cast("string")), 256))
    distinct = common.stored(keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "distinct")
    same = keyed.join(distinct, "key").select("vec_id", "rep", "weight", "embedding", "label")
    reps = keyed.join(distinct, "key").where("vec_id = rep").groupBy("rep").agg(F.min_by(F.struct("weight", "label", "embedding"), "key").alias("r"))
    reps = reps.select("rep", "r.*")
    coded = common.stored(reps.mapInArrow(_bands, _coded(reps.schema["embedding"].dataType)), "coded")

    group = ["label", "dimension", "band", "code"]
    placed = coded.select("rep", "label", F.size("embedding").alias("dimension"), F.posexplode("bands").alias("band", "code"))
    sizes = placed.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1")
    placed = placed.join(sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK)), group)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    # A block meets itself and every other block of its group, as the first or the second of the two.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    kind = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    placed = placed.select("rep", F.xxhash64(*group, F.least("block", "other"), F.greatest("block", "other")).alias("gid"), kind.alias("kind"), "band")
    pairs = placed.join(coded, "rep").select("gid", "kind", "band", "label", "rep", "weight", "embedding", "bands")
    found = pairs.repartition("gid").sortWithinPartitions("gid").mapInArrow(_compare(cosine), "rep long, links long, least long")
    found = common.stored(found.groupBy("rep", "least").agg(F.sum("links").alias("links")), "found")
    links = found.select(F.col("rep").alias("a"), F.col("least").alias("b"))
    links = links.union(same.where("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b")))
    label_of = components(links)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = same.select("vec_id", "rep", "weight").join(counts, "rep", "left")
    linked = linked.groupBy("vec_id").agg(F.max(F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id").join(linked, "vec_id", "left").join(label_of.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


#: DuckDB SQL for the same rows over ``embeddings``.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a
)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, component_id = vec_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""
