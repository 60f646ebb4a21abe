"""First-wins and last-wins de-duplication.

Both are aggregates with a map-side stage rather than windows, so a key that fills a
third of the input is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: str, chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(chooser(F.struct(*rest), F.col(order)).alias("__row"))
    return chosen.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def one_per_key(df: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """One whole row of each key: the first by ``order``, without an order the smallest."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    chosen = F.min_by(row, order) if order else F.min(row)
    picked = df.groupBy(*key).agg(chosen.alias("__row"))
    return picked.select(*[F.col(c) if c in key else F.col("__row")[c].alias(c) for c in df.columns])
