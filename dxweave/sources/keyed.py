"""A stored table with one row per key that batches add to, and that a batch reads only where its keys can be.

Rows lie in folders of hash buckets.  A batch finds the few buckets of its keys and reads those; its new rows become a part
of their own.  Parts of similar size are merged, so there are about as many parts as the table has binary digits, and a row
is written again about as often.  A part's bucket count is a power of two that follows its rows, so a bucket stays small
however large the table becomes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave.operators.dedup import one_per_key
from dxweave.session import children, materialize, remove

_BUCKET = "__bucket"
_NAME = re.compile(r"part_(-?\d+)_(-?\d+)_(\d+)_(\d+)")


@dataclass(frozen=True)
class Part:
    """The rows that batches ``first`` to ``last`` added, in ``buckets`` buckets."""

    first: int
    last: int
    buckets: int
    rows: int

    @property
    def name(self) -> str:
        return f"part_{self.first}_{self.last}_{self.buckets}_{self.rows}"


@dataclass(frozen=True)
class KeyedTable:
    """The table in folder ``path``; ``key`` are its key columns.

    There is one writer at a time, whose batches are numbered and never go back by more than one.  Running a
    batch again replaces what it added.  What was read must be used before the next batch of the writer merges it away.
    """

    path: str
    key: Sequence[str]
    rows_per_bucket: int = 65_536

    # -- layout ---------------------------------------------------------------

    def parts(self, spark: SparkSession, before: int | None = None) -> list[Part]:
        """Finished parts of batches before ``before``, oldest first; without those that a merged one replaces."""
        found = [Part(*map(int, m.groups())) for m in map(_NAME.fullmatch, children(spark, self.path)) if m]
        found = [p for p in found if (before is None or p.last < before) and "_SUCCESS" in children(spark, f"{self.path}/{p.name}")]
        live: list[Part] = []
        for part in sorted(found, key=lambda p: (p.first, -p.last)):
            if not live or part.last > live[-1].last:
                live.append(part)
        return live

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    def _buckets_for(self, rows: int) -> int:
        return 1 << max(0, -(-rows // self.rows_per_bucket) - 1).bit_length()

    def _read(self, spark: SparkSession, part: Part, buckets: set[int] | None) -> DataFrame | None:
        """A part's rows in some of its buckets; None where it has none."""
        folder = f"{self.path}/{part.name}"
        names = [n for n in children(spark, folder) if n.startswith(_BUCKET)]
        if buckets is not None:
            names = [n for n in names if int(n.split("=")[1]) in buckets]
        return spark.read.option("basePath", folder).parquet(*[f"{folder}/{n}" for n in names]).drop(_BUCKET) if names else None

    def _write(self, rows: DataFrame, part: Part) -> None:
        placed = rows.withColumn(_BUCKET, self._bucket(part.buckets)).repartition(_BUCKET).sortWithinPartitions(_BUCKET, *self.key)
        placed.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/{part.name}")

    # -- reading --------------------------------------------------------------

    def rows(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """All rows; None while there are none."""
        return _union([self._read(spark, part, None) for part in self.parts(spark, before)])

    def lookup(self, asked: DataFrame, before: int | None = None) -> DataFrame | None:
        """Rows whose key occurs in ``asked``; None if there can be none.

        Only buckets to which a key of ``asked`` belongs are read.  Their numbers, at most as many as the table
        has buckets, reach the driver; keys don't.
        """
        spark, live = asked.sparkSession, self.parts(asked.sparkSession, before)
        if not live:
            return None
        most = max(part.buckets for part in live)
        touched = {r[0] for r in asked.select(self._bucket(most)).distinct().collect()}
        found = _union([self._read(spark, part, {b % part.buckets for b in touched}) for part in live])
        return found and found.join(asked.select(*self.key).distinct(), list(self.key), "left_semi")

    # -- writing --------------------------------------------------------------

    def append(self, rows: DataFrame, batch: int, order: str | None = None) -> None:
        """Adds the rows whose key earlier batches did not add; of several with one key the first by ``order``, else the smallest.

        Rows without a key are left out.  Earlier parts are merged first where that is due.
        """
        spark = rows.sparkSession
        self.compact(spark, batch)
        rows = one_per_key(rows.dropna(subset=list(self.key)), self.key, order)
        known = self.lookup(rows, batch)
        if known is not None:
            rows = rows.join(known.select(*self.key), list(self.key), "left_anti")
        rows = materialize(rows, "keyed")
        n = rows.count()
        for name in children(spark, self.path):
            if (m := _NAME.fullmatch(name)) and int(m[2]) == batch:  # of a run of this batch that did not end well
                remove(spark, f"{self.path}/{name}")
        if n:
            self._write(rows, Part(batch, batch, self._buckets_for(n), n))

    def compact(self, spark: SparkSession, before: int) -> None:
        """Merges the newest parts of batches before ``before`` while the next older one is not twice as large."""
        live = self.parts(spark, before)
        total, start = 0, len(live)
        while start and (start == len(live) or live[start - 1].rows <= 2 * total):
            start -= 1
            total += live[start].rows
        merged = live[start:]
        if len(merged) > 1:
            rows = _union([self._read(spark, part, None) for part in merged])
            self._write(rows, Part(merged[0].first, merged[-1].last, self._buckets_for(total), total))
        # What no reader of this batch or a later one uses any more, also what an interrupted merge left.
        kept = {part.name for part in self.parts(spark, before)}
        for name in children(spark, self.path):
            if (m := _NAME.fullmatch(name)) and int(m[2]) < before and name not in kept:
                remove(spark, f"{self.path}/{name}")


def _union(tables: Sequence[DataFrame | None]) -> DataFrame | None:
    present = [t for t in tables if t is not None]
    return reduce(DataFrame.unionByName, present) if present else None
