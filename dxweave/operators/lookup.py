"""Dictionary lookups and the context-dependent coding of risk items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X
from dxweave.operators import schema as S


def dictionary_lookup(terms: DataFrame, dictionary: DataFrame, key: str = "term") -> DataFrame:
    """Adds ``code``; a key the dictionary lacks gets an error text that names it.

    ``dictionary`` (term, code) has one row per term.  The join is left to the optimizer:
    a small dictionary is broadcast by its measured size, a large one is shuffled and a
    hot term is split by the skew-join rule.
    """
    table = dictionary.select(F.col("term").alias(key), F.col("code"))
    error = F.concat(F.lit(V.ERROR_NO_MAPPING), F.col(key), F.lit("'"))
    return terms.join(table, key, "left").withColumn("code", F.coalesce("code", error))


def context_text(*siblings: Column) -> Column:
    """Sibling cells joined without a separator: a keyword may match across the seam."""
    return F.concat(*[X.nullish_to_empty(c) for c in siblings])


def context_rule_code(token: Column, context: Column, rules: V.ContextRules) -> Column:
    """What the context decides about a token: the empty string drops it, null leaves it
    to the dictionary, anything else is its code."""
    (word_a, code_a), (word_b, code_b) = rules.override_a, rules.override_b
    has_a, has_b = context.contains(word_a), context.contains(word_b)
    excluded = token.isin(*rules.excluded_tokens) & X.contains_any(context, rules.exclusion_keywords)
    override = token == rules.override_token
    return (
        F.when(excluded, F.lit(""))
        .when(override & has_a & ~has_b, F.lit(code_a))
        .when(override & has_b & ~has_a, F.lit(code_b))
    )


def code_risk_items(
    df: DataFrame,
    dictionary: DataFrame,
    rules: V.ContextRules = V.ContextRules(),
    id_column: str = "record_id",
    risk_column: str = V.RISK_COLUMN,
    context_columns: tuple[str, str] = (V.INDICATION_COLUMN, V.COMPLICATION_COLUMN),
) -> DataFrame:
    """Adds the code cell of the risk column; a blank risk cell gives the empty string."""
    table = S.backfill(df, [risk_column, *context_columns])
    tokens = table.select(
        F.col(id_column).alias("record_id"),
        context_text(*[F.col(c) for c in context_columns]).alias("context"),
        F.posexplode(X.split_pipe(F.col(risk_column))).alias("pos", "token"),
    )
    judged = tokens.select(
        "record_id", "pos", "token",
        context_rule_code(F.col("token"), F.col("context"), rules).alias("decided"),
    ).filter(F.coalesce(F.col("decided"), F.lit("-")) != "")
    coded = dictionary_lookup(judged, dictionary, "token").select(
        "record_id", "pos", F.coalesce("decided", "code").alias("code")
    )
    pieces = coded.select(F.col("record_id").alias(id_column), F.struct("pos", "code").alias("e"))
    per_record = pieces.repartition(id_column).groupBy(id_column).agg(
        F.sort_array(F.collect_list("e")).alias("__codes")
    )
    cell = F.array_join(F.transform("__codes", lambda e: e["code"]), "|")
    return (
        table.join(per_record, id_column, "left")
        .withColumn(risk_column + V.CODE_SUFFIX, F.coalesce(cell, F.lit("")))
        .drop("__codes")
    )


def assert_same_height(before: DataFrame, after: DataFrame) -> None:
    """Fail when a step changed the number of rows."""
    expected, got = before.count(), after.count()
    if expected != got:
        raise ValueError(f"row count changed from {expected} to {got}")
