"""Applying repair rules, replacing codes everywhere, and finding samples.

Decisions where the written rules leave room: ``exact`` rules go before ``contains``
rules and within a kind the earlier line wins; codes are compared as whole pieces; a rule
without ``wrong_code`` fills a missing code only; where a cell has no code at all, terms
that no rule fills get the piece ``None`` so that the lists stay aligned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave.functions import text as X
from dxweave.operators import pairs as P
from dxweave.operators import schema as S
from dxweave.operators.dedup import first_per_key
from dxweave.session import materialize

UNFILLED = "None"

def load_rules(rules: DataFrame, allow_empty_correct: bool = False) -> DataFrame:
    """The rules in force.  ``rules`` carries its line number as ``rule_no``."""

    def text(name: str) -> Column:
        return X.ws_trim(F.coalesce(F.col(name), F.lit(""))).alias(name)

    scope = X.ws_trim(F.coalesce(F.col("column_scope"), F.lit("")))
    valid = rules.select(
        "rule_no",
        F.upper(text("enabled")).alias("enabled"),
        F.lower(text("term_match_mode")).alias("mode"),
        X.normalize_term(F.col("term_keyword")).alias("keyword"),
        text("wrong_code"),
        text("correct_code"),
        F.when(scope != "", scope).otherwise("ALL").alias("scope"),
    ).filter(
        (F.col("enabled") == "Y") & (F.col("keyword") != "") & F.col("mode").isin("exact", "contains")
    )
    if not allow_empty_correct:
        valid = valid.filter(F.col("correct_code") != "")
    return valid.drop("enabled")


def slots(annotated: DataFrame) -> DataFrame:
    """Places a rule can act on in annotated cells: aligned pairs, and the terms of cells without codes."""
    paired = F.transform(
        F.arrays_zip("aligned", "codes"),
        lambda z: F.struct(
            z["aligned"]["term"].alias("term"),
            F.when(z["aligned"]["reason"].isNull(), z["aligned"]["norm"]).alias("norm"),
            z["codes"].alias("code"),
        ),
    )
    uncoded = F.transform(
        F.col("clean"), lambda e: F.struct(e["term"], e["norm"], F.lit("").alias("code"))
    )
    entries = F.when(F.size("codes") == 0, uncoded).when(F.col("aligned").isNotNull(), paired)
    rows = annotated.select("record_id", "col_ord", "column", F.posexplode(entries).alias("pos", "e"))
    return rows.select(
        "record_id", "col_ord", "column", "pos",
        F.col("e.term").alias("term"), F.col("e.norm").alias("norm"), F.col("e.code").alias("code"),
    ).filter(F.col("norm").isNotNull())


#: Length of the pieces by which keywords are found; shorter keywords are pieces themselves.
ANCHOR = 3


def _pieces(text: Column) -> Column:
    """All different pieces of ``text`` with 1 to ``ANCHOR`` characters."""

    def of(size: Column) -> Column:
        last = F.char_length(text) - size + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, size))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[of(F.lit(n)) for n in range(1, ANCHOR + 1)])))


def anchored(terms: DataFrame, keywords: DataFrame) -> DataFrame:
    """(norm, keyword) for each keyword that may occur in a term: the term holds the keyword's rarest piece.

    A term is cut once, whatever the lengths of the keywords.  Pieces of a keyword are as long as ``ANCHOR``,
    those of a shorter one as long as it is; how rare they are is counted over all terms.
    """
    size = F.least(F.char_length("keyword"), F.lit(ANCHOR))
    held = terms.select("norm").distinct().select("norm", F.explode(_pieces(F.col("norm"))).alias("piece"))
    pieces = keywords.distinct().select("keyword", F.explode(F.filter(_pieces(F.col("keyword")), lambda p: F.char_length(p) == size)).alias("piece"))
    counted = held.join(pieces.select("piece").distinct(), "piece").groupBy("piece").agg(F.count("*").alias("n"))
    weighed = pieces.join(counted, "piece", "left").groupBy("keyword").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("rarest"))
    anchors = weighed.filter("rarest.n > 0").select("keyword", F.col("rarest.piece").alias("piece"))
    return held.join(anchors, "piece").select("norm", "keyword")


def match_rules(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule for each (norm, code, column) that has one.

    Both kinds of rules are equi-joins.  A ``contains`` rule meets a term through the rarest piece of its
    keyword, so no rule is ever compared with a term it shares nothing with.
    """
    missing = X.is_missing_code(F.col("code"))
    # A missing code answers to rules that name its spelling and to rules that name none.
    by_code = keys.distinct().withColumn(
        "wrong_code",
        F.explode(
            F.when(missing, F.array_distinct(F.array(F.col("code"), F.lit("")))).otherwise(
                F.array("code")
            )
        ),
    )
    fields = ["wrong_code", "keyword", "scope", "rule_no", "correct_code"]
    # Of rules that ask for the same the first counts anyway: one row for each before any join.
    rules = first_per_key(rules.select("mode", *fields), ["mode", "wrong_code", "keyword", "scope"], "rule_no")
    exact = rules.filter(F.col("mode") == "exact").select(*fields)
    contains = rules.filter(F.col("mode") == "contains").select(*fields)
    found = anchored(keys, contains.select("keyword")).filter(F.contains("norm", "keyword"))
    by_keyword = by_code.join(found, "norm")
    hits = (
        by_code.withColumn("keyword", F.col("norm"))
        .join(exact, ["wrong_code", "keyword"])
        .withColumn("rank", F.lit(0))
        .unionByName(
            by_keyword.join(contains, ["wrong_code", "keyword"]).withColumn("rank", F.lit(1))
        )
        .filter((F.col("scope") == "ALL") | (F.col("scope") == F.col("column")))
    )
    return (
        hits.groupBy("norm", "code", "column")
        .agg(F.min(F.struct("rank", "rule_no", "correct_code")).alias("rule"))
        .select("norm", "code", "column", F.col("rule.rule_no").alias("rule_no"),
                F.col("rule.correct_code").alias("new_code"))
    )


def rule_changes(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """The repair report: one row per changed code.

    Places are written to the shared folder once; the rules are matched with what is different among them and their matches
    written too, so that places are not shuffled where few matches reach them.
    """
    return changes_of(slots(P.annotate_cells(cells)), rules)


def changes_of(places: DataFrame, rules: DataFrame) -> DataFrame:
    places = materialize(places, "places")
    keys = materialize(places.select("norm", "code", "column").distinct(), "keys")
    matched = materialize(match_rules(keys, rules), "matched")
    changed = places.join(matched, ["norm", "code", "column"]).filter(F.col("code") != F.col("new_code"))
    return changed.select(
        "record_id", "col_ord", "column", "pos", "term",
        F.col("code").alias("old_code"), "new_code", "rule_no",
        F.lit("RULE_UPDATED").alias("status"),
    )


def change_summary(changes: DataFrame) -> DataFrame:
    return changes.groupBy("rule_no", "status").agg(F.count("*").alias("modifications"))


def _with_changes(df: DataFrame, changes: DataFrame, id_column: str) -> DataFrame:
    """Attach to each record the list of its changes; few records have any."""
    per_record = changes.groupBy(F.col("record_id").alias(id_column)).agg(
        F.collect_list(F.struct("col_ord", "pos", "new_code")).alias("__changes")
    )
    return df.join(per_record, id_column, "left")


def _replaced(codes: Column, col_ord: int) -> Column:
    """``codes`` with the changes for one column applied."""
    mine = F.filter(F.col("__changes"), lambda e: e["col_ord"] == col_ord)
    at = F.map_from_entries(F.transform(mine, lambda e: F.struct(e["pos"], e["new_code"])))
    return F.transform(codes, lambda c, i: F.coalesce(F.element_at(at, i), c))


def apply_changes(
    df: DataFrame,
    changes: DataFrame,
    pairs: Sequence[tuple[str, str]],
    id_column: str = "record_id",
    drop_noise: bool = False,
) -> DataFrame:
    """Rewrite the code cells of a wide table; with ``drop_noise`` also remove noise terms
    (and the codes that face them) from cells whose lists are aligned."""
    out = _with_changes(df, changes, id_column)
    for i, (term_column, code_column) in enumerate(pairs):
        # Working columns have names of their own: inside a lambda, a name that the same
        # projection redefines would mean the new column.
        judged = F.transform(
            X.split_pipe(F.col(term_column)),
            lambda t: F.struct(t.alias("term"), X.noise_reason(X.normalize_trimmed(t)).isNull().alias("ok")),
        )
        mine = F.filter(F.col("__changes"), lambda e: e["col_ord"] == i)
        hit = F.coalesce(F.size(mine) > 0, F.lit(False))

        def rewritten(old: Column, clean: Column) -> Column:
            unfilled = F.transform(clean, lambda e: F.lit(UNFILLED))
            return _replaced(F.when(F.size(old) > 0, old).otherwise(unfilled), i)

        if not drop_noise:
            # Cells without a change are left alone, and nothing is computed for them.
            clean = F.filter(judged, lambda e: e["ok"])
            codes = X.let(X.split_pipe(F.col(code_column)), lambda old: X.join_pipe(rewritten(old, clean)))
            out = out.withColumn(code_column, F.when(hit, codes).otherwise(F.col(code_column)))
            continue
        out = out.withColumns({"__judged": judged, "__old": X.split_pipe(F.col(code_column)), "__hit": hit})
        out = out.withColumn("__clean", F.filter("__judged", lambda e: e["ok"]))
        out = out.withColumn(
            "__new", F.when(F.col("__hit"), rewritten(F.col("__old"), F.col("__clean"))).otherwise(F.col("__old"))
        )
        facing = F.filter(F.arrays_zip("__judged", "__new"), lambda z: z["__judged"]["ok"])
        equal = F.size("__judged") == F.size("__old")
        clean_fits = (F.size("__old") == 0) | (F.size("__clean") == F.size("__old"))
        codes = F.when(
            equal, X.join_pipe(F.transform(facing, lambda z: z["__new"]))
        ).otherwise(X.join_pipe(F.col("__new")))
        terms = F.when(
            equal | clean_fits, X.join_pipe(F.transform("__clean", lambda e: e["term"]))
        ).otherwise(F.col(term_column))
        out = out.withColumns({"__codes": codes, "__terms": terms})
        out = out.withColumns({term_column: F.col("__terms"), code_column: F.col("__codes")})
        out = out.drop("__judged", "__old", "__hit", "__clean", "__new", "__codes", "__terms")
    return out.drop("__changes")


def repair(
    df: DataFrame,
    rules: DataFrame,
    id_column: str = "record_id",
    drop_noise: bool = False,
    allow_empty_correct: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(repaired table, report) for a wide table with term/code column pairs."""
    pairs = S.code_pairs(df.columns)
    changes = rule_changes(S.pair_cells(df, pairs, id_column), load_rules(rules, allow_empty_correct))
    return apply_changes(df, changes, pairs, id_column, drop_noise), changes


# -- one code everywhere ------------------------------------------------------


def replace_code(df: DataFrame, columns: Sequence[str], old: str, new: str) -> DataFrame:
    """Replace one code in every cell, whatever the term: a projection, no shuffle.

    Cells that do not hold the code stay as they are, spacing included.
    """

    def swapped(cell: Column) -> Column:
        codes = F.transform(X.split_pipe(cell), lambda c: F.when(c == old, F.lit(new)).otherwise(c))
        named = F.exists(X.split_pipe(cell), lambda c: c == old)
        return F.when(F.coalesce(named, F.lit(False)), F.array_join(codes, "|")).otherwise(cell)

    return df.withColumns({c: swapped(F.col(c)) for c in columns})


def replace_codes(
    df: DataFrame, columns: Sequence[str], mapping: DataFrame, id_column: str = "record_id"
) -> DataFrame:
    """Replace codes by a table (old_code, new_code[, line]).

    Of several rows for a code the last line counts, without lines the smallest new code.  Only the pieces the table names are brought together again, per record; everything
    else stays in the rows it came in.
    """
    cells = [
        F.struct(F.lit(i).alias("col_ord"), X.split_pipe(F.col(c)).alias("codes"))
        for i, c in enumerate(columns)
    ]
    pieces = df.select(F.col(id_column).alias("record_id"), F.inline(F.array(*cells))).select(
        "record_id", "col_ord", F.posexplode("codes").alias("pos", "old_code")
    )
    chosen = F.max_by("new_code", "line") if "line" in mapping.columns else F.min("new_code")
    mapping = mapping.filter(F.col("old_code").isNotNull()).groupBy("old_code").agg(chosen.alias("new_code"))
    changes = pieces.join(mapping, "old_code")
    out = _with_changes(df, changes, id_column)
    rewritten = {}
    for i, c in enumerate(columns):
        mine = F.filter(F.col("__changes"), lambda e: e["col_ord"] == i)
        new = F.array_join(_replaced(X.split_pipe(F.col(c)), i), "|")
        rewritten[c] = F.when(F.coalesce(F.size(mine) > 0, F.lit(False)), new).otherwise(F.col(c))
    return out.withColumns(rewritten).drop("__changes")


# -- samples ------------------------------------------------------------------


def find_samples(
    cells: DataFrame,
    code: str | None = None,
    keyword: str | None = None,
    code_contains: bool = False,
) -> DataFrame:
    """Cells with a given code, a given word in a term, or both; a filter, no shuffle."""
    found = cells
    if code is not None:
        test = (lambda c: c.contains(code)) if code_contains else (lambda c: c == code)
        found = found.filter(F.exists("codes", test))
    if keyword is not None:
        found = found.filter(F.exists("terms", lambda t: t.contains(keyword)))
    return found.select(
        "record_id", "uuid", "admission_date", "column",
        F.array_join("terms", "|").alias("terms"), F.array_join("codes", "|").alias("codes"),
    )
