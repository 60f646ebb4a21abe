"""Prevalence of codes and code groups over records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X
from dxweave.session import materialize


def record_codes(columns: Sequence[str], exclude_null_words: bool = False) -> Column:
    """Distinct codes of a record over its code columns, error texts left out."""

    def usable(c: Column) -> Column:
        keep = (c != "") & ~X.is_error_code(c)
        return keep & ~X.is_missing_code(c) if exclude_null_words else keep

    def codes(name: str) -> Column:
        parts = F.split(F.coalesce(F.col(name), F.lit("")), r"\|")
        return F.filter(F.transform(parts, X.ws_trim), usable)

    return F.array_distinct(F.flatten(F.array(*[codes(c) for c in columns])))


def relabel(items: Column, rule: tuple[str, str, str] | None, parity: Column | None) -> Column:
    """Give one code one of two labels, by whether the parity column says ``0``."""
    if rule is None:
        return items
    code, at_zero, otherwise = rule
    is_zero = F.lit(False) if parity is None else X.ws_trim(F.coalesce(parity, F.lit(""))) == "0"
    label = F.when(is_zero, at_zero).otherwise(otherwise)
    return F.array_distinct(F.transform(items, lambda c: F.when(c == code, label).otherwise(c)))


def group_of(code: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    """First group, in declared order, with a member that is a prefix of the code."""

    def member(prefixes: Sequence[str]) -> Column:
        return reduce(lambda a, b: a | b, [code.startswith(p) for p in prefixes], F.lit(False))

    chain = F
    for label, prefixes in groups.items():
        chain = chain.when(member(prefixes), label)
    return chain.otherwise(F.lit(None)) if groups else F.lit(None).cast("string")


def prefix_groups(codes: DataFrame, rules: DataFrame) -> DataFrame:
    """``codes`` (code) with the group of the best rule of ``rules`` (rank, prefix, label).

    For rule tables too long for an expression: a code meets a rule through one of its
    own prefixes, so this is an equi-join; the lowest rank wins.
    """
    distinct = codes.select("code").distinct()
    prefixes = distinct.select(
        "code",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.char_length("code"), F.lit(1))),
                lambda n: F.left(F.col("code"), n),
            )
        ).alias("prefix"),
    )
    best = (
        prefixes.join(rules, "prefix")
        .groupBy("code")
        .agg(F.min_by("label", "rank").alias("label"))
    )
    return distinct.join(best, "code", "left")


def prevalence(
    df: DataFrame,
    columns: Sequence[str],
    pack: V.CodeGroups = V.CodeGroups(),
    parity_column: str | None = V.PARITY_COLUMN,
    enable_groups: bool = False,
    keep_individual: bool = True,
    only_ungrouped: bool = False,
    exclude_null_words: bool = False,
) -> DataFrame:
    """Occurrences, patients and prevalence of each counted item; a patient is a record.

    The items of a record form a set built inside its row, so one combined count per item
    is both numbers, and the input is read once.  The denominator is every record, also those without a code.
    """
    parity = F.col(parity_column) if parity_column in df.columns else None
    base = df.select(
        relabel(record_codes(columns, exclude_null_words), pack.relabel, parity).alias("details")
    )
    tagged = base.select(
        F.transform(
            "details", lambda c: F.struct(c.alias("code"), group_of(c, pack.groups).alias("label"))
        ).alias("tagged")
    )
    grouped = F.filter(F.transform("tagged", lambda t: t["label"]), lambda g: g.isNotNull())
    details = F.col("tagged")
    if only_ungrouped:
        details = F.filter(details, lambda t: t["label"].isNull())
    nothing = F.array().cast("array<string>")
    items = F.array_union(
        grouped if enable_groups else nothing,
        F.transform(details, lambda t: t["code"]) if keep_individual else nothing,
    )
    # A marker with each record counts the records in the same pass; one row for each item is left after that.
    entry = lambda item, total: F.struct(item.alias("item"), F.lit(total).alias("total"))
    none = F.lit(None).cast("string")
    marked = F.array_append(F.transform(items, lambda i: entry(i, False)), entry(none, True))
    counts = tagged.select(F.inline(marked)).groupBy("item", "total").agg(F.count("*").alias("n"))
    counts = materialize(counts, "prevalence")
    records = counts.where("total").agg(F.max("n")).scalar()
    return counts.where(~F.col("total")).select(
        F.col("item").alias("ICD11_Code_Or_Group"),
        F.col("n").alias("Total_Occurrences"),
        F.col("n").alias("Patient_Count"),
        X.percent_text(F.col("n") / records * 100).alias("Prevalence"),
    )


def ordered_prevalence(statistics: DataFrame) -> DataFrame:
    return statistics.orderBy(F.desc("Patient_Count"), "ICD11_Code_Or_Group")
