"""Picking up an interrupted run and bringing its parts together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.operators.dedup import last_per_key


def unfinished(df: DataFrame, finished: DataFrame, id_column: str = "record_id") -> DataFrame:
    """Rows that have no result yet."""
    return df.join(finished.select(id_column).distinct(), id_column, "left_anti")


def merge_parts(parts: Sequence[DataFrame], key: str = "record_id", line: str | None = None) -> DataFrame:
    """Union of result parts; of two results for a key the later part, then the later
    line of a part, wins."""
    within = F.col(line) if line else F.lit(0)
    numbered = [
        p.withColumn("__at", F.struct(F.lit(i).alias("part"), within.cast("bigint").alias("line")))
        for i, p in enumerate(parts)
    ]
    merged = reduce(lambda a, b: a.unionByName(b), numbered)
    return last_per_key(merged, [key], "__at").drop("__at")


def merge_results(
    df: DataFrame, results: DataFrame, columns: Sequence[str], id_column: str = "record_id"
) -> DataFrame:
    """Code columns from (record_id, results map<column, cell>); no result means null."""
    joined = df.join(results.select(id_column, "results"), id_column, "left")
    cells = {c + V.CODE_SUFFIX: F.element_at("results", c) for c in columns}
    return joined.withColumns(cells).drop("results")
