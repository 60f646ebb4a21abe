"""The coding cascade over distinct terms.

Order: cached result, exact rule, rule verdict, split into sub-terms; each sub-term:
rule verdict, candidate search, selection.  The steps that need judgement are resolvers,
functions from a table of distinct terms to a table of replies.  ``recorded`` serves
replies from a table; a caller may pass one built on ``mapInPandas`` instead, best behind
a ``ReplyLog``, which asks no question twice.

Every term is looked up once, however often it occurs, and all lookups are joins with
one row per key on the right, so no join multiplies rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X
from dxweave.operators import schema as S
from dxweave.operators.dedup import one_per_key
from dxweave.session import materialize

Resolver = Callable[[DataFrame], DataFrame]


def recorded(replies: DataFrame, order: str | None = None) -> Resolver:
    """Resolver that serves (term, reply) rows recorded earlier.

    Of several replies to a question the first by the column ``order`` counts, else the smallest.
    """

    def serve(terms: DataFrame) -> DataFrame:
        if order is None:
            return replies
        key = [c for c in terms.columns if c in replies.columns]
        return one_per_key(replies, key, order).drop(order)

    serve.is_table = serve.is_recorded = True
    return serve


def _asked(resolver: Resolver, questions: DataFrame, purpose: str) -> DataFrame:
    """The replies of a resolver, one for each question; of several the smallest.

    What reads its input is asked once: its replies go to the shared folder.
    """
    replies = resolver(questions)
    if getattr(resolver, "is_unique", False):
        return replies
    return one_per_key(replies if getattr(resolver, "is_table", False) else materialize(replies, purpose), questions.columns)


@dataclass(frozen=True)
class Resolvers:
    """``verdicts`` and ``splits`` map (term) to (term, reply).  ``candidates`` maps
    (sub_term) to (sub_term, candidates[, error]); ``selections`` maps (term, sub_term)
    to (term, sub_term, reply).  Without ``verdicts`` there are no rules to judge by;
    without ``selections`` the first candidate is taken."""

    splits: Resolver
    candidates: Resolver
    verdicts: Resolver | None = None
    selections: Resolver | None = None


def _stored(resolver: Resolver | None, purpose: str, *key: str) -> Resolver | None:
    """A recorded resolver whose replies, one for each question, lie in the shared folder; others stay as they are."""
    if not getattr(resolver, "is_recorded", False):
        return resolver
    # Recorded replies depend on the columns of the questions only.
    nothing = SparkSession.active().createDataFrame([], ", ".join(f"{c} string" for c in key))
    replies = materialize(one_per_key(resolver(nothing), key), purpose)

    def serve(terms: DataFrame) -> DataFrame:
        return replies

    serve.is_table = serve.is_unique = True
    return serve


def stored(resolvers: Resolvers) -> Resolvers:
    """``resolvers`` for many calls of ``code_terms``: recorded replies are reduced to one for each question now, not in each call."""
    return Resolvers(
        splits=_stored(resolvers.splits, "splits", "term"),
        candidates=_stored(resolvers.candidates, "candidates", "sub_term"),
        verdicts=_stored(resolvers.verdicts, "verdicts", "term"),
        selections=_stored(resolvers.selections, "selections", "term", "sub_term"),
    )


def _column(df: DataFrame, name: str, key: str, column: str, new: str) -> DataFrame:
    return df.select(F.col(name).alias(key), F.col(column).alias(new))


def code_terms(
    terms: DataFrame,
    resolvers: Resolvers,
    cache: DataFrame | None = None,
    rules: DataFrame | None = None,
) -> DataFrame:
    """(term, code, stage) for the distinct terms of ``terms``.

    ``cache`` and ``rules`` are (term, code).  ``stage`` tells what decided: ``cache``,
    ``rule``, ``verdict``, ``search`` or ``error``; a term that splits into nothing has a
    null code.  A resolver sees only the terms the earlier stages left open.
    """
    known = terms.select("term").filter(F.col("term").isNotNull()).distinct()
    for table, name in ((cache, "cached"), (rules, "ruled")):
        if table is None:
            known = known.withColumn(name, F.lit(None).cast("string"))
        else:
            known = known.join(_column(table, "term", "term", "code", name), "term", "left")
    known = known.withColumn("ruled", F.when(F.col("ruled") != "", F.col("ruled")))
    still_open = F.col("cached").isNull() & F.col("ruled").isNull()
    if resolvers.verdicts is None:
        known = known.withColumn("judged", F.lit(None).cast("string"))
    else:
        replies = _asked(resolvers.verdicts, known.filter(still_open).select("term"), "verdicts")
        known = known.join(_column(replies, "term", "term", "reply", "reply"), "term", "left")
        known = known.withColumn("judged", X.verdict_code(F.col("reply"))).drop("reply")
    known = known.withColumn("settled", F.coalesce("cached", "ruled", "judged"))

    splits = _asked(resolvers.splits, known.filter(F.col("settled").isNull()).select("term"), "splits")
    known = known.join(_column(splits, "term", "term", "reply", "split_reply"), "term", "left")
    known = known.withColumn("subs", F.when(F.col("settled").isNull(), X.split_terms(F.col("split_reply"))))
    parts = known.select(
        "term", "cached", "ruled", "judged", "settled",
        (F.col("settled").isNull() & F.col("subs").isNull()).alias("unsplit"),
        F.posexplode_outer("subs").alias("pos", "sub"),
    )
    # A settled term has no sub-term; its own text keeps the join keys spread.
    parts = parts.withColumn("sub_key", F.coalesce("sub", "term"))
    open_subs = parts.filter(F.col("sub").isNotNull())
    if resolvers.verdicts is None:
        parts = parts.withColumn("sub_judged", F.lit(None).cast("string"))
    else:
        replies = _asked(resolvers.verdicts, open_subs.select(F.col("sub").alias("term")).distinct(), "verdicts")
        parts = parts.join(_column(replies, "term", "sub_key", "reply", "sub_reply"), "sub_key", "left")
        parts = parts.withColumn("sub_judged", X.verdict_code(F.col("sub_reply"))).drop("sub_reply")
    open_subs = parts.filter(F.col("sub").isNotNull() & F.col("sub_judged").isNull())
    found = _asked(resolvers.candidates, open_subs.select(F.col("sub").alias("sub_term")).distinct(), "candidates")
    failure = F.col("error") if "error" in found.columns else F.lit(None)
    found = found.select(
        F.col("sub_term").alias("sub_key"), "candidates", failure.cast("string").alias("failure")
    )
    parts = parts.join(found, "sub_key", "left")
    if resolvers.selections is None:
        choice = F.get("candidates", F.lit(0))["code"]
    else:
        pairs = open_subs.select("term", F.col("sub").alias("sub_term")).distinct()
        chosen = _asked(resolvers.selections, pairs, "selections").select(
            "term", F.col("sub_term").alias("sub_key"), F.col("reply").alias("choice_reply")
        )
        parts = parts.join(chosen, ["term", "sub_key"], "left")
        choice = X.selected_code(F.col("choice_reply"))

    def error(text) -> Column:
        return F.concat(F.lit("ERROR: "), text if not isinstance(text, str) else F.lit(text))

    searched = (
        F.when(F.col("failure").isNotNull(), error(F.col("failure")))
        .when(F.coalesce(F.size("candidates") > 0, F.lit(False)), F.coalesce(choice, error(V.ERROR_SELECTION)))
        .otherwise(error(V.ERROR_NO_CANDIDATES))
    )
    sub_code = F.when(F.col("sub").isNotNull(), F.coalesce(F.col("sub_judged"), searched))
    # One row per sub-term of a single term: a handful.
    per_term = parts.withColumn("sub_code", sub_code).groupBy("term").agg(
        *[F.max(c).alias(c) for c in ("cached", "ruled", "judged", "settled", "unsplit")],
        F.sort_array(F.collect_list(F.struct("pos", "sub_code"))).alias("found"),
    )
    codes = F.filter(F.transform("found", lambda e: e["sub_code"]), lambda c: c.isNotNull())
    code = F.coalesce(
        "settled",
        F.when(F.col("unsplit"), error(V.ERROR_SPLIT)),
        X.join_pipe(codes),
    )
    stage = (
        F.when(F.col("cached").isNotNull(), "cache")
        .when(F.col("ruled").isNotNull(), "rule")
        .when(F.col("judged").isNotNull(), "verdict")
        .when(F.col("unsplit"), "error")
        .otherwise("search")
    )
    return per_term.select("term", code.alias("code"), stage.alias("stage"))


def cache_additions(coded: DataFrame) -> DataFrame:
    """(term, code) worth remembering: new results without an error."""
    fresh = coded.filter((F.col("stage") != "cache") & F.col("code").isNotNull())
    return fresh.filter(~F.col("code").contains("ERROR:")).select("term", "code")


def code_table(
    df: DataFrame,
    columns: Sequence[str],
    resolvers: Resolvers,
    cache: DataFrame | None = None,
    rules: DataFrame | None = None,
    id_column: str = "record_id",
    once: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(table with a code cell beside each term column, results per distinct term).

    With ``once`` the results are written to the shared folder, and the table is built from there.
    """
    terms = S.terms_long(df, columns, id_column)
    coded = code_terms(terms, resolvers, cache, rules)
    if once:
        coded = materialize(coded, "coded")
    placed = terms.join(coded.select("term", "code"), "term", "left")
    return S.attach_cells(df, placed, columns, id_column), coded


def rule_set_version(lines: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Eight hex digits that change with any rule of a set, per rule set.

    ``lines`` is (…key, line, term, code).  Every line gives a number, the first 15 hex digits of the md5
    of its place and sentence; the version is the md5 of how many lines there are and of their sum.
    Both are combined before the shuffle, so a set has the same version in one piece or in many.
    """
    sentence = F.format_string("%d- Rule: If input implies '%s', map to '%s'", F.col("line").cast("bigint"), "term", "code")
    number = F.conv(F.left(F.md5(sentence.cast("binary")), F.lit(15)), 16, 10).cast("decimal(20,0)")
    sets = lines.withColumn("number", number).groupBy(*key).agg(F.count("*").alias("n"), F.sum("number").alias("total"))
    whole = F.concat_ws(":", F.col("n").cast("string"), F.col("total").cast("string"))
    return sets.select(*key, F.left(F.md5(whole.cast("binary")), F.lit(8)).alias("version"))


def cache_name(model: str, version: str | None) -> str:
    """Name under which results are cached: they hold for one model and one rule set."""
    return f"diagnosis_term_cache__{X.safe_name(model)}__{version or 'no_rules'}"
