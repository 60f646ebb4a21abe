"""Accounting of resolver calls: how many, with what usage, how often the cache helped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave.functions import text as X

COUNTERS = (
    "calls", "calls_with_usage", "calls_with_cached_tokens_field", "calls_with_cache_hit",
    "prompt_tokens", "completion_tokens", "total_tokens", "cached_tokens",
)
DETAILS = ("input_tokens_details", "prompt_tokens_details")


def usage_fields(usage: Column) -> Column:
    """Numbers of one usage document.  The first details object that has a
    ``cached_tokens`` field counts, even when its value is null."""
    document = F.try_parse_json(usage)

    def text(path: str) -> Column:
        return F.try_variant_get(document, path, "string")

    present = [
        F.try_variant_get(document, f"$.{d}.cached_tokens", "variant").isNotNull() for d in DETAILS
    ]
    values = [X.safe_int(text(f"$.{d}.cached_tokens")) for d in DETAILS]
    return F.struct(
        *[X.safe_int(text(f"$.{f}")).alias(f) for f in ("prompt_tokens", "completion_tokens", "total_tokens")],
        F.when(present[0], values[0]).when(present[1], values[1]).otherwise(F.lit(0)).cast("bigint").alias("cached_tokens"),
        (present[0] | present[1]).alias("field_present"),
    )


def call_counters(calls: DataFrame) -> DataFrame:
    """(label, …counters) of single calls; ``calls`` is (label, usage)."""
    seen = F.col("usage").isNotNull()
    u = calls.select("label", "usage", F.when(seen, usage_fields(F.col("usage"))).alias("u"))

    def number(name: str) -> Column:
        return F.coalesce(F.col(f"u.{name}"), F.lit(0)).cast("bigint").alias(name)

    def one_if(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0).cast("bigint")

    return u.select(
        "label",
        F.lit(1).cast("bigint").alias("calls"),
        one_if(seen).alias("calls_with_usage"),
        one_if(F.col("u.field_present")).alias("calls_with_cached_tokens_field"),
        one_if(F.col("u.cached_tokens") > 0).alias("calls_with_cache_hit"),
        *[number(n) for n in COUNTERS[4:]],
    )


def sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTERS]


def usage_summary(calls: DataFrame) -> DataFrame:
    """Counters per label and in total (``is_total`` = 1, label null), in one aggregate."""
    return (
        call_counters(calls)
        .rollup("label")
        .agg(F.grouping("label").cast("int").alias("is_total"), *sums())
        .select("label", "is_total", *COUNTERS)
    )
