"""Data-quality rules over term/code cells: seven kinds of flags and a rule template."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X
from dxweave.operators import pairs as P
from dxweave.session import materialize

FLAG_COLUMNS = (
    "row_index", "uuid", "admission_date", "column", "issue_type", "detail", "term_value",
    "normalized_term", "code_value", "recommended_code", "recommended_code_frequency",
)
# Flags come in input order; conflicts follow, by first sight of the term, then the code.
FLAG_ORDER = ("phase", "o1", "o2", "o3", "o4", "o5", "o6")


def _long(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def _flag(kind, detail, term, norm, code, step, at, recommended=None, frequency=None) -> Column:
    return F.struct(
        F.lit(kind).alias("issue_type"),
        detail.alias("detail"),
        term.alias("term_value"),
        norm.cast("string").alias("normalized_term"),
        code.alias("code_value"),
        F.lit(recommended).cast("string").alias("recommended_code"),
        F.lit(frequency).cast("bigint").alias("recommended_code_frequency"),
        _long(step).alias("o3"),
        _long(at).alias("o4"),
    )


def cell_flags(annotated: DataFrame) -> DataFrame:
    """Noise, missing code, missing term and length mismatch.

    All flags of a cell are built as one array and exploded once: no shuffle, one scan.
    """
    n_terms, codes, clean = F.size("judged"), F.col("codes"), F.col("clean")
    nothing, empty = F.lit(None), F.lit("")
    none = F.array().cast(
        "array<struct<issue_type:string,detail:string,term_value:string,normalized_term:string,"
        "code_value:string,recommended_code:string,recommended_code_frequency:bigint,"
        "o3:bigint,o4:bigint>>"
    )

    def noise(entries: Column, step: int, code_at) -> Column:
        bad = F.filter(entries, lambda e: e["reason"].isNotNull())
        return F.transform(
            bad,
            lambda e: _flag(
                "NOISE_TERM", e["reason"], e["term"], e["norm"], code_at(e), step, e["at"], "", 0
            ),
        )

    clean_terms = F.array_join(F.transform(clean, lambda e: e["term"]), "|")
    code_text = F.array_join(codes, "|")
    early = F.when(
        F.col("prefiltered") & (n_terms > 0), noise(F.col("judged"), 0, lambda e: empty)
    ).when(~F.col("prefiltered"), noise(F.col("judged"), 1, lambda e: F.get(codes, e["at"])))
    lengths = F.concat(
        F.lit("terms="), F.size(clean).cast("string"), F.lit(", codes="), F.size(codes).cast("string")
    )
    whole = (
        F.when(
            (F.size(codes) == 0) & (F.size(clean) > 0),
            F.array(_flag("MISSING_CODE", F.lit(V.DETAIL_MISSING_CODE), clean_terms, nothing, empty, 1, 0)),
        )
        .when(
            (n_terms == 0) & (F.size(codes) > 0),
            F.array(_flag("MISSING_TERM", F.lit(V.DETAIL_MISSING_TERM), empty, nothing, code_text, 1, 0)),
        )
        .when(
            (F.size(codes) > 0) & F.col("aligned").isNull(),
            F.array(_flag("TERM_CODE_LENGTH_MISMATCH", lengths, clean_terms, nothing, code_text, 1, 0)),
        )
    )
    flags = F.concat(F.coalesce(early, none), F.coalesce(whole, none))
    rows = annotated.select("record_id", "uuid", "admission_date", "col_ord", "column", F.inline(flags))
    return rows.select(
        F.col("record_id").cast("bigint").alias("row_index"),
        "uuid", "admission_date", "column", "issue_type", "detail", "term_value",
        "normalized_term", "code_value", "recommended_code", "recommended_code_frequency",
        _long(0).alias("phase"),
        F.col("record_id").cast("bigint").alias("o1"),
        F.col("col_ord").cast("bigint").alias("o2"),
        "o3", "o4", _long(0).alias("o5"), _long(0).alias("o6"),
    )


def code_flags(recommended: DataFrame) -> DataFrame:
    """Error codes and empty codes, with the recommendation made for each."""
    is_error = X.is_error_code(F.col("code"))
    return recommended.select(
        F.col("record_id").cast("bigint").alias("row_index"),
        "uuid", "admission_date", "column",
        F.when(is_error, "ERROR_CODE").otherwise("EMPTY_OR_NONE_CODE").alias("issue_type"),
        F.when(is_error, V.DETAIL_ERROR_CODE).otherwise(V.DETAIL_EMPTY_CODE).alias("detail"),
        F.col("term").alias("term_value"),
        F.col("norm").alias("normalized_term"),
        F.col("code").alias("code_value"),
        "recommended_code", "recommended_code_frequency",
        _long(0).alias("phase"),
        F.col("record_id").cast("bigint").alias("o1"),
        F.col("col_ord").cast("bigint").alias("o2"),
        _long(1).alias("o3"),
        F.col("pos").cast("bigint").alias("o4"),
        _long(0).alias("o5"), _long(0).alias("o6"),
    )


def conflict_flags(pairs: DataFrame) -> DataFrame:
    """One flag per minority code of a term that was given more than one code."""
    codes, winners = P.majority(pairs)
    rows = codes.join(winners.filter(F.col("n_codes") > 1), "norm").filter(
        F.col("code") != F.col("major_code")
    )
    return rows.select(
        _long(None).alias("row_index"),
        F.lit("").alias("uuid"), F.lit("").alias("admission_date"), F.lit("ALL").alias("column"),
        F.lit("TERM_MULTI_CODE").alias("issue_type"),
        F.format_string(
            V.DETAIL_MULTI_CODE, "norm", "major_code", "major_n", "code", "n"
        ).alias("detail"),
        F.col("display").alias("term_value"),
        F.col("norm").alias("normalized_term"),
        F.col("code").alias("code_value"),
        F.col("major_code").alias("recommended_code"),
        F.col("major_n").alias("recommended_code_frequency"),
        _long(1).alias("phase"),
        *[
            _long(F.col(source)[name]).alias(f"o{i}")
            for i, (source, name) in enumerate(
                [(s, n) for s in ("term_first", "first") for n in P.PLACE], start=1
            )
        ],
    )


def asked_pairs(pairs: DataFrame, mode: str = "asof", chunk_records: int = 1 << 20) -> DataFrame:
    """Pairs without a usable code and the code recommended for them.

    ``asof`` looks at earlier pairs only; ``global`` at the whole input, which is cheaper.
    """
    if mode == "asof":
        return P.running_recommendation(pairs, chunk_records)
    asking = pairs.filter(F.col("reason").isNull() & ~X.is_usable_code(F.col("code")))
    return asking.drop("reason").join(P.global_recommendation(pairs), "norm", "left").withColumns(
        {
            "recommended_code": F.coalesce("recommended_code", F.lit("")),
            "recommended_code_frequency": F.coalesce("recommended_code_frequency", _long(0)),
        }
    )


@dataclass(frozen=True)
class Inspection:
    """The outputs of one inspection; each is lazy."""

    flags: DataFrame
    stats: DataFrame
    reverse: DataFrame
    template: DataFrame


def all_flags(cells: DataFrame, mode: str = "asof", chunk_records: int = 1 << 20) -> DataFrame:
    """Every flag of the input with the columns that order them.

    The judged cells are written once to the shared folder; every kind of flag reads them from there.
    """
    return flags_of(stored_cells(cells), mode, chunk_records)


def stored_cells(cells: DataFrame) -> DataFrame:
    """Annotated cells, of which the terms with their judgement and the codes lie in the shared folder."""
    return P.lined_up(materialize(P.judge_cells(cells).drop("terms"), "judged"))


def flags_of(annotated: DataFrame, mode: str = "asof", chunk_records: int = 1 << 20) -> DataFrame:
    pairs = P.cell_pairs(annotated)
    return (
        cell_flags(annotated)
        .unionByName(code_flags(asked_pairs(pairs, mode, chunk_records)))
        .unionByName(conflict_flags(pairs))
    )


def ordered_flags(flags: DataFrame) -> DataFrame:
    """The flags in order.  They are stored first: a sort reads its input twice, to find its borders and to sort."""
    return materialize(flags, "flags").orderBy(*FLAG_ORDER).select(*FLAG_COLUMNS)


def flag_summary(flags: DataFrame) -> DataFrame:
    return flags.groupBy("issue_type").agg(F.count("*").alias("n_flags"))


def rule_template(flags: DataFrame) -> DataFrame:
    """A repair rule per flagged (term, code), taken from its first flag."""
    kinds = ("ERROR_CODE", "EMPTY_OR_NONE_CODE", "TERM_MULTI_CODE")
    term = F.when(F.col("normalized_term") != "", F.col("normalized_term")).otherwise(F.col("term_value"))
    first = F.struct(*FLAG_ORDER, "issue_type", F.coalesce("recommended_code", F.lit("")).alias("code"))
    chosen = (
        flags.filter(F.col("issue_type").isin(*kinds))
        .withColumn("term_keyword", term)
        .filter(F.col("term_keyword") != "")
        .groupBy("term_keyword", F.col("code_value").alias("wrong_code"))
        .agg(F.min(first).alias("f"))
    )
    return chosen.select(
        F.lit("Y").alias("enabled"),
        F.lit("exact").alias("term_match_mode"),
        "term_keyword",
        "wrong_code",
        F.col("f.code").alias("correct_code"),
        F.lit("ALL").alias("column_scope"),
        F.col("f.issue_type").alias("note"),
    )


def write_template(template: DataFrame, path: str) -> None:
    """Write the rules for editing; a template without a rule gets one example row."""
    template.write.mode("errorifexists").option("header", True).csv(path)
    spark = template.sparkSession
    if spark.read.schema(template.schema).option("header", True).csv(path).isEmpty():
        keyword, wrong, correct, note = V.TEMPLATE_PLACEHOLDER
        row = ("Y", "exact", keyword, wrong, correct, "ALL", note)
        example = spark.createDataFrame([row], template.schema)
        example.write.mode("append").option("header", True).csv(path)


def inspect(cells: DataFrame, mode: str = "asof", chunk_records: int = 1 << 20) -> Inspection:
    """The whole inspection of a pair-cell relation (``schema.pair_cells``)."""
    annotated = stored_cells(cells)
    flags = flags_of(annotated, mode, chunk_records)
    pairs = P.cell_pairs(annotated)
    return Inspection(
        flags=flags,
        stats=P.term_code_stats(pairs),
        reverse=P.reverse_map(pairs),
        template=rule_template(flags),
    )
