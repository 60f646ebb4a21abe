"""From ``documents`` to packed training sequences, in five stages of the operators in ``dxweave.llm``.

Each stage gets what its predecessor kept, written as Parquet and read again.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave.llm import near_duplicates, packing, quality, substrings, toxicity
from dxweave.llm.common import by_ids, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the model rejects go."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def no_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go.  Labels with remainder 1 stay unseen, as in the query."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.in_part("doc_id", 3))
    return toxicity.keep(docs, toxicity.train(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays."""
    gone = stored(near_duplicates.classes(docs).where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return by_ids(docs, gone, "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id holds too are cut out; ``n_chars`` follows the text."""
    return substrings.rewrite(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", no_toxicity),
    ("near duplicates", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", pack),
]

#: Models and token ids can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
