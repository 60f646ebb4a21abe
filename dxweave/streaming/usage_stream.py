"""Live usage accounting over a growing call log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dxweave.operators.dedup import last_per_key
from dxweave.operators.usage import COUNTERS, call_counters, sums


def run_usage_stream(calls: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep totals per label in the state store; each batch writes the labels it changed.

    A batch owns the folder of its number and overwrites it, so a batch that is run again
    after a failure leaves one result.
    """
    totals = call_counters(calls).groupBy("label").agg(*sums())

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def current_totals(changes: DataFrame) -> DataFrame:
    """The latest state of every label from what the batches wrote."""
    return last_per_key(changes, ["label"], "batch").select(
        "label", *[F.col(c).cast("bigint").alias(c) for c in COUNTERS]
    )
