"""Replies that cost something: each question is asked once, also across failures and runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave.operators.dedup import one_per_key
from dxweave.session import children, materialize, remove
from dxweave.sources.keyed import KeyedTable

Resolver = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ReplyLog:
    """A log of replies in folder ``path``, one row for each question, in hash buckets of the question.

    Questions go to the resolver in tasks of at most ``per_task``.  A task's replies are in the journal as
    soon as it ends, whatever becomes of the others or of the job.  A task that fails asks its own questions
    again, with ``per_task`` 1 only the one it failed at; nothing else is asked twice.  Replies for which the SQL condition ``remember``
    does not hold are served once and forgotten, so failures are tried again in the next run.
    """

    path: str
    per_task: int = 32
    remember: str = "true"

    def through(self, resolver: Resolver) -> Resolver:
        """A resolver that asks ``resolver`` what the log does not know.  The columns of the questions are the key."""

        def serve(questions: DataFrame) -> DataFrame:
            return self._serve(resolver, questions)

        serve.is_table = True
        return serve

    def _journals(self, spark: SparkSession) -> list[str]:
        return [f"{self.path}/{n}" for n in children(spark, self.path) if n.startswith("journal-")]

    def _fold(self, spark: SparkSession, key: list[str]) -> None:
        """Moves the journals into the log, those of interrupted runs too."""
        table = KeyedTable(f"{self.path}/log", key)
        for journal in self._journals(spark):
            if any(name.startswith("part-") for name in children(spark, journal)):
                batch = max((part.last for part in table.parts(spark)), default=-1) + 1
                replies = spark.read.parquet(journal)
                table.append(replies.filter(F.coalesce(F.expr(self.remember), F.lit(False))), batch)
            remove(spark, journal)

    def _serve(self, resolver: Resolver, questions: DataFrame) -> DataFrame:
        spark, key = questions.sparkSession, questions.columns
        questions = materialize(questions.dropna().distinct(), "questions")
        table = KeyedTable(f"{self.path}/log", key)
        self._fold(spark, key)
        known = table.lookup(questions)
        unknown = questions if known is None else materialize(questions.join(known.select(*key), key, "left_anti"), "unknown")
        n = unknown.count()
        if not n and known is not None:
            return materialize(known, "replies")
        replies = resolver(unknown.repartition(max(1, -(-n // self.per_task))))
        journal = f"{self.path}/journal-{uuid.uuid4().hex}"
        # Version 2 of the committer moves a task's file to its place when the task ends.
        replies.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(journal)
        replies = one_per_key(spark.read.schema(replies.schema).parquet(journal), key)
        return materialize(replies if known is None else known.select(replies.columns).unionByName(replies), "replies")
