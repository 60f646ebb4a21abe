"""File sources.

Delimited tables are read as strings only.  ``multi_line`` keeps quoted line breaks; files are read in splits either way.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X
from dxweave.operators.dedup import last_per_key
from dxweave.operators.schema import with_row_ordinal
from dxweave.sources.quoted import read_quoted


def _csv(spark: SparkSession, header: bool, multi_line: bool):
    return (
        spark.read.option("header", header)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("encoding", "UTF-8")
    )


def read_table(
    spark: SparkSession,
    path: str | list[str],
    dialect: str = "pandas",
    multi_line: bool = False,
    ordinal: str | None = None,
) -> DataFrame:
    """All-string CSV with a header; the NA spellings of the dialect become null.

    Quoted line breaks need ``multi_line``, which reads the files twice more (see ``sources.quoted``).
    ``ordinal`` names an extra column with the 0-based row number.
    """
    df = _csv(spark, True, multi_line).csv(path)  # with multi_line only asked for its column names
    if multi_line:
        names = df.columns
        df = read_quoted(spark, path, names, True, ordinal or "__number").select(*([ordinal] if ordinal else []), *[f"`{c}`" for c in names])
    elif ordinal:
        df = with_row_ordinal(df, ordinal)
    names = [c for c in df.columns if c != ordinal]
    return df.withColumns(
        {c: X.null_if_in(F.col(f"`{c}`"), V.NA_SPELLINGS[dialect]) for c in names}
    )


def _two_columns(spark: SparkSession, path: str) -> DataFrame:
    return read_quoted(spark, path, ["term", "code"], False, "line").select(
        "line",
        X.ws_trim(F.col("term")).alias("term"),
        X.ws_trim(F.col("code")).alias("code"),
    )


def _entries(rows: DataFrame) -> DataFrame:
    return rows.filter((F.col("term") != "") & (F.col("code") != ""))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(term, code) from a two-column file without a header; the last duplicate wins."""
    entries = _entries(_two_columns(spark, path))
    return last_per_key(entries, ["term"], "line").select("term", "code")


def read_rule_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, term, code) of every usable rule, duplicates included.

    The first row is a header only when its second field names a code.  A file that is
    not there gives no rules.
    """
    try:
        rows = _two_columns(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "line bigint, term string, code string")
    names_code = F.lower("code").contains("code") | F.col("code").contains("编码")
    return _entries(rows.filter(~((F.col("line") == 0) & F.coalesce(names_code, F.lit(False)))))


def exact_rules(lines: DataFrame) -> DataFrame:
    """(term, code) lookup table of a rule file; the last duplicate wins."""
    return last_per_key(lines, ["term"], "line").select("term", "code")


def read_log(spark: SparkSession, path: str | list[str], key: str, value_type: str = "string") -> DataFrame:
    """(key, value) from JSON lines ``{key: …, value: …}``; the last line of a key wins.

    Lines that do not parse or lack one of the two fields are skipped.  A null value
    erases earlier ones: the key then has no entry.
    """
    name, field = ("key", "value") if key == "key" else (key, "results")
    lines = with_row_ordinal(spark.read.text(path), "line")
    return latest_entries(lines, name, field, value_type)


def latest_entries(lines: DataFrame, name: str, field: str, value_type: str) -> DataFrame:
    names = F.json_object_keys("value")
    parsed = lines.filter(F.array_contains(names, name) & F.array_contains(names, field)).select(
        "line", F.from_json("value", f"`{name}` string, `{field}` {value_type}").alias("j")
    )
    entries = parsed.select(
        "line", F.col("j")[name].alias("key"), F.col("j")[field].alias("value")
    ).filter(F.col("key").isNotNull())
    # Map values are boxed in a struct: max_by needs no ordering on what it returns.
    return last_per_key(entries, ["key"], "line").filter(F.col("value").isNotNull()).select("key", "value")

