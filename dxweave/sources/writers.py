"""File sinks.  Nothing overwrites: a target that exists is an error or an append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dxweave.operators.dedup import one_per_key
from dxweave.session import children
from dxweave.sources.keyed import KeyedTable


def write_table(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Delimited output, one header per part file; sorted by range when asked to."""
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def _index_log(spark: SparkSession, path: str, key: StructType) -> KeyedTable:
    """The keys of the log at ``path`` in hash buckets, brought up to date from the files that it does not cover yet.

    It lies in a folder of the log that readers of the log don't see.  Files that others add to the log are covered as well.
    """
    index, name = KeyedTable(f"{path}/_keys/table", [key[0].name]), f"{path}/_keys/files"
    batches = [int(n) for n in children(spark, name)]
    covered = {r[0] for n in batches for r in spark.read.schema("file string").parquet(f"{name}/{n}").collect()}
    files = [f for f in children(spark, path) if f[0] not in "_." and f not in covered]
    if files:
        number = max(batches, default=-1) + 1
        index.append(spark.read.schema(key).json([f"{path}/{f}" for f in files]), number)
        spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.mode("overwrite").parquet(f"{name}/{number}")
    return index


def append_new(df: DataFrame, path: str, key: str, order: str | None = None) -> None:
    """Append the rows whose key the JSON-lines log at ``path`` does not hold yet.

    Of several new rows with a key the first by ``order`` is written; without an order that is the smallest row.
    What is read follows the new rows, not the log: the files added since the last append, and of the log's keys the buckets
    to which new keys belong.  Rows without a key are not written.
    """
    spark = df.sparkSession
    fresh = one_per_key(df.dropna(subset=[key]), [key], order)
    known = _index_log(spark, path, df.select(key).schema).lookup(fresh)
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
    fresh.write.mode("append").json(path)


def write_reverse_report(report: DataFrame, path: str) -> None:
    """One JSON object per code, ``{"code": …, "terms": {term: count}}``, codes ascending."""
    lines = report.orderBy("code", "part").select(
        F.to_json(F.struct("code", "part", "terms")).alias("value")
    )
    lines.write.mode("errorifexists").text(path)
