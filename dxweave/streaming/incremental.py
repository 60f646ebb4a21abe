"""Incremental coding: new records are coded as they arrive, terms only once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dxweave.operators.cascade import Resolvers, cache_additions, code_table, stored
from dxweave.operators.schema import terms_long
from dxweave.session import materialize
from dxweave.sources.keyed import KeyedTable


def term_cache(path: str, cache_key: str = "no_rules") -> KeyedTable:
    """(term, code) remembered for one model and rule set (see ``cache_name``)."""
    return KeyedTable(f"{path}/{cache_key}", ["term"])


def run_incremental_coding(
    records: DataFrame,
    columns: Sequence[str],
    resolvers: Resolvers,
    out: str,
    cache: str,
    checkpoint: str,
    rules: DataFrame | None = None,
    cache_key: str = "no_rules",
) -> StreamingQuery:
    """Code a stream of wide records.

    ``cache`` holds a keyed table for each ``cache_key`` (see ``cache_name``): results of another model or rule
    set are never used.  Resolvers are asked once for each open term of a batch: its results are stored, and
    the table and the additions to the cache are made from what is stored.

    A batch reads the buckets of the cache to which its terms belong, not the cache; parts that batches
    added are merged as they grow.  Rules and recorded replies are stored when the stream starts, so a batch does not derive them again.  The streaming checkpoint remembers which files are done.  Batch ``n`` reads the
    terms learnt by batches before it and replaces what it added itself, so running it again after a failure changes nothing.
    """

    remembered = term_cache(cache, cache_key)
    # What every batch reads is computed once.
    resolvers = stored(resolvers)
    rules = None if rules is None else materialize(rules, "rules")

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        known = remembered.lookup(terms_long(batch, columns).select("term"), number)
        coded_table, coded_terms = code_table(batch, columns, resolvers, known, rules, once=True)
        coded_table.write.mode("overwrite").parquet(f"{out}/batch={number}")
        remembered.append(cache_additions(coded_terms), number)
        batch.unpersist()

    return (
        records.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(run)
        .start()
    )
