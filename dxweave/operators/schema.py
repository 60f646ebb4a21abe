"""Column discovery, row ordinals and the step between wide and long layout."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X

_NUMBERED = re.compile(r"diagnosis(\d+)", re.IGNORECASE)


def numbered_columns(columns: Sequence[str]) -> list[str]:
    """``diagnosis<N>`` columns in numeric order, whatever their letter case."""
    found = [(int(m.group(1)), c) for c in columns if (m := _NUMBERED.fullmatch(c))]
    return [c for _, c in sorted(found, key=lambda pair: pair[0])]


def term_columns(columns: Sequence[str], manual: str | None = None) -> list[str]:
    """Columns to code: the manual list, else ``diagnosis<N>``, else the legacy pair."""
    if manual and manual.strip():
        wanted = [name.strip() for name in manual.split(",")]
        chosen = [name for name in wanted if name in columns]
    else:
        legacy = (V.INDICATION_COLUMN, V.COMPLICATION_COLUMN)
        chosen = numbered_columns(columns) or [c for c in legacy if c in columns]
    if not chosen:
        raise ValueError(f"no term column among {list(columns)}")
    return chosen


def code_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(term column, code column) pairs; any numbered pair hides the legacy pairs."""
    legacy = (V.COMPLICATION_COLUMN, V.INDICATION_COLUMN, V.RISK_COLUMN)
    for names in (numbered_columns(columns), [c for c in legacy if c in columns]):
        pairs = [(c, c + V.CODE_SUFFIX) for c in names if c + V.CODE_SUFFIX in columns]
        if pairs:
            return pairs
    raise ValueError(f"no term/code column pair among {list(columns)}")


def code_columns(columns: Sequence[str], originals: Sequence[str]) -> list[str]:
    return [c + V.CODE_SUFFIX for c in originals if c + V.CODE_SUFFIX in columns]


def backfill(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add each absent column as the empty string."""
    return df.withColumns({c: F.lit("") for c in required if c not in df.columns})


def with_row_ordinal(df: DataFrame, name: str = "record_id") -> DataFrame:
    """0-based row number of a DataFrame read from files, in (file, offset) order.

    Rows are counted per input split; the running offset is taken over one row per split
    and joined back, so no row passes through a global sort.
    """
    tagged = df.select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__seq"),
        "*",
    )
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        tagged.groupBy("__file", "__block")
        .agg(F.min("__seq").alias("__first"), F.count("*").alias("__rows"))
        .withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .drop("__rows")
    )
    numbered = tagged.join(splits, ["__file", "__block"]).withColumn(
        name, (F.col("__offset") + F.col("__seq") - F.col("__first")).cast("bigint")
    )
    return numbered.select(name, *[c for c in df.columns if c != name])


def cells_long(df: DataFrame, columns: Sequence[str], id_column: str = "record_id") -> DataFrame:
    """Wide to long over term columns: one row per record and column."""
    entries = [
        F.struct(F.lit(i).alias("col_ord"), F.lit(c).alias("column"), F.col(c).alias("cell"))
        for i, c in enumerate(columns)
    ]
    return df.select(F.col(id_column).alias("record_id"), F.inline(F.array(*entries)))


def terms_long(df: DataFrame, columns: Sequence[str], id_column: str = "record_id") -> DataFrame:
    """Wide to long over terms: (record_id, col_ord, column, pos, term)."""
    cells = cells_long(df, columns, id_column)
    return cells.select(
        "record_id", "col_ord", "column", F.posexplode(X.split_pipe(F.col("cell"))).alias("pos", "term")
    )


def pair_cells(
    df: DataFrame, pairs: Sequence[tuple[str, str]], id_column: str = "record_id"
) -> DataFrame:
    """Wide to long over term/code pairs, lists decoded.

    Cells that are empty on both sides stay: to filter on the decoded lists would decode
    every cell twice, and no rule finds anything in them.
    """

    def passed(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit("")

    entries = [
        F.struct(
            F.lit(i).alias("col_ord"),
            F.lit(t).alias("column"),
            F.col(t).alias("term_cell"),
            F.col(c).alias("code_cell"),
        )
        for i, (t, c) in enumerate(pairs)
    ]
    cells = df.select(
        F.col(id_column).alias("record_id"),
        passed("uuid").alias("uuid"),
        passed("admission_date").alias("admission_date"),
        F.inline(F.array(*entries)),
    )
    return cells.select(
        "record_id", "uuid", "admission_date", "col_ord", "column",
        X.split_pipe(F.col("term_cell")).alias("terms"),
        X.split_pipe(F.col("code_cell")).alias("codes"),
    )


def attach_cells(
    df: DataFrame,
    coded: DataFrame,
    columns: Sequence[str],
    id_column: str = "record_id",
    suffix: str = V.CODE_SUFFIX,
) -> DataFrame:
    """Long back to wide: ``coded`` (record_id, col_ord, pos, code) becomes one code cell
    per term column.

    A record without a row in ``coded`` keeps what its own cells say: null for a blank
    cell, the empty string for one that holds only separators.  One shuffle brings the
    codes of a record together; a record is a row of the input, so it is bounded.
    """
    pieces = coded.select(
        F.col("record_id").alias(id_column), F.struct("col_ord", "pos", "code").alias("e")
    )
    # Nothing can be combined before the shuffle, so the rows go straight to it.
    per_record = pieces.repartition(id_column).groupBy(id_column).agg(
        F.sort_array(F.collect_list("e")).alias("__codes")
    )

    def cell(i: int, column: str) -> Column:
        mine = F.filter(F.col("__codes"), lambda e: (e["col_ord"] == i) & e["code"].isNotNull())
        joined = F.array_join(F.transform(mine, lambda e: e["code"]), "|")
        blank = X.ws_trim(F.coalesce(F.col(column), F.lit(""))) == ""
        return F.when(~blank, F.coalesce(joined, F.lit("")))

    joined = df.join(per_record, id_column, "left")
    return joined.withColumns({c + suffix: cell(i, c) for i, c in enumerate(columns)}).drop("__codes")
