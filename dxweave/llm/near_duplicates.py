"""Operator 2: near duplicates by Order MinHash and banded alignment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave.llm import common
from dxweave.llm.components import components

#: Words in a k-mer, and the similarity from which two texts are near copies.
WORDS, SIMILARITY = 5, 0.8
#: Entries of a sketch and k-mers in an entry.  A pair of similarity 0.8 shares none with probability
#: (1 - 0.8**3)**16, about 1e-5.
ENTRIES, PICKED = 16, 3
#: Places of a bag: counts of a text's k-mers by hash.  What two bags differ by, no alignment can match.
BAG = 128
#: Heads of a group grow by this factor from round to round; documents of a group in one part of the last join.
MORE_HEADS, BLOCK = 16, 512
#: Groups up to this size compare all their classes; larger ones are cut by rare k-mers first.
FEW = 16
#: Pairs that a task aligns, about.
PAIRS_PER_TASK = 1 << 10

SCHEMA = "doc_id long, class_id long, kept boolean, n_kmers long"
SKETCH = "doc_id long, digest binary, n_kmers long, entries array<long>, bag binary"
_SEED = 0x5851F42D4C957F2D


# ---- sketches ------------------------------------------------------------------------------


def kmers(parts: list[list[bytes]], known: common.WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every run of ``WORDS`` words."""
    places = known.places([w for p in parts for w in p])
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    n = max(0, len(doc) - WORDS + 1)
    whole = doc[:n] == doc[WORDS - 1 :][:n]
    return doc[:n][whole], common.windows(known.arrays()[0][places], WORDS)[whole]


def labelled(doc: np.ndarray, kmer: np.ndarray) -> np.ndarray:
    """A hash of each k-mer with the number of its earlier occurrences in the document."""
    order = np.lexsort((kmer, doc))  # stable: occurrences stay in text order
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (kmer[order][1:] != kmer[order][:-1])
    heads = np.flatnonzero(new)
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = np.arange(len(order)) - heads[np.cumsum(new) - 1]
    return common.mix(kmer + occurrence * np.uint64(_SEED))


def sketches(doc: np.ndarray, kmer: np.ndarray, n: int) -> np.ndarray:
    """``ENTRIES`` hashes for each of ``n`` documents: the k-mers of minimum labelled hash, in text order.

    Documents with fewer than ``PICKED`` k-mers use those they have; rows of documents without any are 0.
    """
    out = np.zeros((n, ENTRIES), np.uint64)
    if not len(doc):
        return out
    label = labelled(doc, kmer)
    heads = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    owner = doc[heads]
    sizes = np.diff(np.append(heads, len(doc)))
    group = np.repeat(np.arange(len(heads)), sizes)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for j in range(ENTRIES):
        rank = common.mix(label ^ np.uint64((j + 1) * _SEED % (1 << 64)))
        picked = []
        for _ in range(PICKED):
            least = np.minimum.reduceat(rank, heads)
            hit = np.flatnonzero(rank == least[group])
            place = np.full(len(heads), len(doc))
            place[group[hit][::-1]] = hit[::-1]  # the first, should two be equal
            place[least == top] = len(doc)
            rank[place[place < len(doc)]] = top
            picked.append(place)
        places = np.sort(np.stack(picked), axis=0)
        entry = np.full(len(heads), np.uint64(j + 1))
        for row in places:
            value = np.where(row < len(doc), kmer[np.minimum(row, len(doc) - 1)], np.uint64(0))
            entry = common.mix(entry * np.uint64(0x9E3779B97F4A7C15) + value)
        out[owner, j] = entry
    return out


def bags(doc: np.ndarray, kmer: np.ndarray, n: int) -> np.ndarray:
    """How many k-mers of each of ``n`` documents fall on each place, up to 255."""
    place = doc * BAG + (kmer % np.uint64(BAG)).astype(np.int64)
    return np.minimum(np.bincount(place, minlength=n * BAG), 255).astype(np.uint8).reshape(n, BAG)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = common.WordHashes((3,))
    for batch, texts in common.pieces(batches):
        known.trim()
        parts = [t.split() for t in texts]
        doc, kmer = kmers(parts, known)
        counts = np.bincount(doc, minlength=len(parts))
        entries = sketches(doc, kmer, len(parts)).view(np.int64)
        digests = [hashlib.blake2b(b" ".join(p), digest_size=16).digest() if p else None for p in parts]
        columns = [
            batch.column(0),
            pa.array(digests, pa.binary()),
            pa.array(counts.astype(np.int64)),
            pa.array([e if c else [] for e, c in zip(entries, counts)], pa.list_(pa.int64())),
            pa.array([b.tobytes() for b in bags(doc, kmer, len(parts))], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "n_kmers", "entries", "bag"])


# ---- alignment -----------------------------------------------------------------------------


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> float:
    """k-mers of two sequences that a banded alignment matches, divided by all k-mers of both.

    At that similarity at most ``band`` k-mers stay unmatched, so no matched pair lies further from the diagonal.
    Sequences whose k-mers as bags are too different are answered at once, with 0.  Common ends are taken
    off; between them the longest common subsequence is found with one bit for each k-mer of ``b``.
    """
    n, m = len(a), len(b)
    band = int((n + m) * (1 - similarity) / (1 + similarity) + 1e-9)
    need = (n + m) * similarity / (1 + similarity) - 1e-9
    if abs(n - m) > band:
        return 0.0
    values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    in_a = np.bincount(np.searchsorted(values, a), minlength=len(values))
    if np.minimum(in_a, counts - in_a).sum() < need:
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    a, b = a[head : n - tail], b[head : m - tail]
    matched = head + tail
    if len(a) and len(b):
        places: dict[int, int] = {}
        for j, x in enumerate(b.tolist()):
            places[x] = places.get(x, 0) | 1 << j
        full = (1 << len(b)) - 1
        row = full
        for i, x in enumerate(a.tolist()):
            found = places.get(x)
            if found is None:
                continue
            low = max(0, i - band)
            hit = row & found & (((1 << (i + band + 1 - low)) - 1) << low)
            row = ((row + hit) | (row - hit)) & full
        matched += len(b) - row.bit_count()
    return matched / (n + m - matched)


def _possible(similarity: float):
    """Leaves out pairs whose bags differ by more k-mers than texts of that similarity leave unmatched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BAG).astype(np.int16) for i in (4, 5))
            most = (n_a + n_b) * (1 - similarity) / (1 + similarity) + 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(np.abs(a - b).sum(axis=1) <= most))

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.WordHashes((3,))
        for batch, b in common.pieces(batches, 3):
            known.trim()
            a = common.text_bytes(batch.column(2))
            place = {t: i for i, t in enumerate(dict.fromkeys(a + b))}  # a text is cut once, whatever the number of its pairs
            doc, kmer = kmers([t.split() for t in place], known)
            own = np.split(kmer, np.searchsorted(doc, np.arange(1, len(place))))
            keep = [aligned(own[place[x]], own[place[y]], similarity) >= similarity for x, y in zip(a, b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


# ---- the operator --------------------------------------------------------------------------


def classes(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id, kept, n_kmers`` for every row: the class is its smallest id, which is kept.

    Two texts are linked if an alignment matches at least ``similarity`` of their runs of five words; classes
    are what links connect.  Texts with the same words are one text from the start.  Candidates
    share an entry of their sketches.  In every group that shares one, all are compared with one head first, not with
    each other: what links to it is in its class anyway.  Large groups that still hold several classes are replaced by
    groups that share one of their documents' rarest k-mers, which no pair of that similarity can do without.  Classes
    without a head get one in later rounds, more in each; what is then left between different classes is compared pair by
    pair.  So every pair of a group is in one class, was found too different, or has too few k-mers in common.

    Texts without words (null, empty) stay alone.  Texts shorter than five words only equal their
    copies.  A null id has a null class and is kept.  Rows with the same id are one document that has
    several texts.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = common.rows(docs, doc_id, text)
    known = rows.where(F.col("doc_id").isNotNull())
    sketched = common.stored(known.mapInArrow(_sketch, SKETCH), "sketches")
    copies = sketched.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = common.stored(copies.where("n > 1"), "copied")  # apart from the join below, which may then split a hot digest
    same = sketched.select("doc_id", "digest").join(copies, "digest").where(F.col("doc_id") != F.col("first"))
    same = common.stored(same.select(F.col("first").alias("a"), F.col("doc_id").alias("b"), "digest"), "copies")
    texts = sketched.where(F.size("entries") > 0).select("doc_id", "digest", "n_kmers", "entries", "bag")
    # By id and text: a document with several texts may hold a copy and another text.
    texts = texts.join(same.select(F.col("b").alias("doc_id"), "digest").distinct(), ["doc_id", "digest"], "left_anti").drop("digest")
    links = same.select("a", "b").union(_near(known, texts, similarity))
    label = components(links)
    out = sketched.select("doc_id", "n_kmers").join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"), "n_kmers")
    out = out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), "n_kmers")
    none = F.lit(None).cast("long")
    return out.union(rows.where(F.col("doc_id").isNull()).select(none, none, F.lit(True), none))


def _near(docs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between different texts of the same group, round by round.

    A head meets all others of its group at once, so no pair with it is left.  After one head large groups of several classes
    give way to those of ``_by_rare_kmers``.  When all classes of a group but one at most have had a head, pairs of documents that
    were no heads are left, and these are compared last.
    """
    entries = texts.select("doc_id", "n_kmers", F.explode(F.array_distinct("entries")).alias("entry"))
    shared = entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1").select("entry")
    groups = common.stored(entries.join(shared, "entry"), "groups")
    wanted = common.stored(groups.select("doc_id").distinct(), "wanted")
    members = common.stored(common.by_ids(docs, wanted, "left_semi"), "members")
    sizes = common.stored(texts.select("doc_id", "n_kmers", "bag").join(wanted, "doc_id", "left_semi").distinct(), "bags")

    def linked(pairs: DataFrame) -> DataFrame:
        b = sizes.select(F.col("doc_id").alias("b"), F.col("n_kmers").alias("n_b"), F.col("bag").alias("bag_b"))
        a = sizes.select(F.col("doc_id").alias("a"), F.col("n_kmers").alias("n_a"), F.col("bag").alias("bag_a"))
        possible = pairs.join(b, "b").join(a, "a").select("a", "b", "n_a", "n_b", "bag_a", "bag_b")
        possible = common.stored(possible.mapInArrow(_possible(similarity), "a long, b long").distinct(), "possible")
        with_text = possible.join(members.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        with_text = with_text.join(members.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        # Aligning takes long for few bytes, so tasks follow the number of pairs; a head's pairs may be in many.
        tasks = max(1, -(-possible.count() // PAIRS_PER_TASK))
        with_text = with_text.repartition(tasks, F.col("a"), F.pmod(F.xxhash64("b"), F.lit(tasks))).sortWithinPartitions("a")
        return common.stored(with_text.select("a", "b", "text_a", "text_b").mapInArrow(_verify(similarity), "a long, b long"), "near")

    def labels(links: DataFrame) -> DataFrame:
        moved = wanted.join(components(links).withColumnRenamed("node", "doc_id"), "doc_id", "left")
        return common.stored(moved.select("doc_id", F.coalesce("component", "doc_id").alias("component")), "labels")

    label = wanted.select("doc_id", F.col("doc_id").alias("component"))
    placed = groups.join(label, "doc_id")
    heads = common.stored(_headless(placed, None).where("first").select("entry", "head"), "heads")
    tried = common.stored(_pairs(placed, heads, None, similarity), "pairs")
    links = linked(tried)
    label = labels(links) if links.take(1) else label
    few, crowded = _mixed(groups.join(label, "doc_id"))
    if crowded.take(1):
        groups = common.stored(few.union(_by_rare_kmers(common.by_ids(members, crowded, "left_semi"), similarity)), "groups")
    else:
        groups = few
    heads = heads.join(few.select("entry").distinct(), "entry", "left_semi")
    number = 1
    while True:
        placed = groups.join(label, "doc_id")
        headless = common.stored(_headless(placed, heads), "headless")
        if not headless.take(1):
            break
        chosen = headless.where(F.pmod(F.xxhash64("entry", "head.component"), F.col("n")) < number) if number > 1 else headless.where("first")
        chosen = common.stored(chosen.select("entry", "head"), "heads")
        pairs = common.stored(_pairs(placed, chosen, tried, similarity), "pairs")
        found = linked(pairs)
        tried, heads, links = tried.union(pairs), heads.union(chosen), links.union(found)
        number *= MORE_HEADS
        if found.take(1):
            label = labels(links)
    rest = _rest(placed, heads)
    return links.union(linked(common.stored(_rest_pairs(rest, tried, similarity), "pairs"))) if rest.take(1) else links


def _mixed(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of groups with more than one class the rows of small ones, and the documents of large ones."""
    mixed = placed.groupBy("entry").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    rows = common.stored(placed.join(mixed.where("low < high").select("entry", "n"), "entry").select("entry", "doc_id", "n_kmers", "n"), "mixed")
    crowded = common.stored(rows.where(F.col("n") > FEW).select("doc_id").distinct(), "crowded")
    return rows.where(F.col("n") <= FEW).drop("n"), crowded


def _labelled_kmers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = common.WordHashes((3,))
    for batch, texts in common.pieces(batches):
        known.trim()
        doc, kmer = kmers([t.split() for t in texts], known)
        ends = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(labelled(doc, kmer).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends).astype(np.int64)), lists], names=["doc_id", "n_kmers", "kmers"])


def _by_rare_kmers(members: DataFrame, similarity: float) -> DataFrame:
    """``entry, doc_id, n_kmers`` of groups that share one of the rarest k-mers of a document.

    Of n k-mers at least ``similarity * n`` are matched in a pair of that similarity, so with all k-mers in one order the pair has a
    common one among the first n minus that, plus one, of both documents.  Rare ones come first, so a passage that many texts hold
    makes no group of texts that are different otherwise.
    """
    texts = members.select("doc_id", "text").mapInArrow(_labelled_kmers, "doc_id long, n_kmers long, kmers array<long>")
    texts = common.stored(texts.where("n_kmers > 0").withColumn("row", F.monotonically_increasing_id()), "kmers")
    each = texts.select("row", F.explode("kmers").alias("entry"))
    shared = each.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1")
    held = each.join(shared, "entry").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "entry"))).alias("held"))
    # K-mers of one text only come before all others and make no group.
    first = F.col("n_kmers") - F.ceil(F.col("n_kmers") * similarity - 1e-6) + 1 - (F.col("n_kmers") - F.size("held"))
    kept = F.slice("held", 1, F.greatest(first, F.lit(0)).cast("int"))
    rows = texts.select("row", "doc_id", "n_kmers").join(held, "row").select(F.explode(kept["entry"]).alias("entry"), "doc_id", "n_kmers").distinct()
    several = rows.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1").select("entry")
    return rows.join(several, "entry").select("entry", "doc_id", "n_kmers")


def _headless(placed: DataFrame, heads: DataFrame | None) -> DataFrame:
    """Classes of a group without a head, where there are two or more: their smallest document, their number, whether it is the first."""
    of_class = placed.groupBy("entry", "component").agg(F.min(F.struct("doc_id", "n_kmers", "component")).alias("head"))
    if heads is not None:
        now = placed.select("entry", "doc_id", "component").join(heads.select("entry", F.col("head.doc_id").alias("doc_id")), ["entry", "doc_id"])
        of_class = of_class.join(now.select("entry", "component").distinct(), ["entry", "component"], "left_anti")
    counted = of_class.groupBy("entry").agg(F.count("*").alias("n"), F.min("head").alias("least")).where("n > 1")
    return of_class.join(counted, "entry").select("entry", "head", "n", (F.col("head") == F.col("least")).alias("first"))


def _alike(similarity: float, a: str, b: str) -> Column:
    """Lengths too different for the similarity are left out: no alignment could match enough."""
    return F.least(a, b) >= F.greatest(a, b) * similarity - 1e-9


def _pairs(placed: DataFrame, chosen: DataFrame, tried: DataFrame | None, similarity: float) -> DataFrame:
    """The heads of a group against all others that are not in their class; the smaller id comes first."""
    pairs = placed.join(chosen, "entry").where((F.col("component") != F.col("head.component")) & _alike(similarity, "n_kmers", "head.n_kmers"))
    pairs = pairs.select(F.least("head.doc_id", "doc_id").alias("a"), F.greatest("head.doc_id", "doc_id").alias("b")).distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def _rest(placed: DataFrame, heads: DataFrame) -> DataFrame:
    """What was no head, in groups where that is of different classes.  A repeated id is head with one length only."""
    used = heads.select("entry", F.col("head.doc_id").alias("doc_id"), F.col("head.n_kmers").alias("n_kmers"))
    rest = placed.join(used, ["entry", "doc_id", "n_kmers"], "left_anti")
    mixed = rest.groupBy("entry").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("entry", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    return common.stored(rest.join(mixed, "entry"), "rest")


def _rest_pairs(rest: DataFrame, tried: DataFrame, similarity: float) -> DataFrame:
    """All pairs of different classes in a group.  A large group is cut into blocks, which meet the whole group."""
    left = rest.select("entry", F.col("doc_id").alias("a"), F.col("n_kmers").alias("n_a"), F.col("component").alias("c_a"), F.pmod(F.xxhash64("doc_id"), "blocks").alias("block"))
    right = rest.select("entry", F.col("doc_id").alias("b"), F.col("n_kmers").alias("n_b"), F.col("component").alias("c_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    pairs = left.join(right, ["entry", "block"]).where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & _alike(similarity, "n_a", "n_b"))
    return pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
