"""Cleaning a whole table: which column gets which cleaner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import cleaners as C
from dxweave.functions import text as X
from dxweave.operators import schema as S

# Per profile: cleaners of the fixed columns, of the numbered columns, and what counts as
# an empty cell.
PROFILES = {
    "current": (
        {
            V.INDICATION_COLUMN: "diagnosis",
            V.COMPLICATION_COLUMN: "diagnosis",
            V.RISK_COLUMN: "risk",
        },
        "diagnosis",
        V.CELL_PLACEHOLDERS,
    ),
    "archived": (
        {
            V.INDICATION_COLUMN: "indication",
            V.RISK_COLUMN: "risk",
            V.COMPLICATION_COLUMN: "complication",
        },
        "diagnosis_plain",
        V.ARCHIVED_CELL_PLACEHOLDERS,
    ),
    # The stand-alone cleaners of one column, each with its own empty cells.
    "risks": ({V.RISK_COLUMN: "risk"}, None, V.RISK_CELL_PLACEHOLDERS),
    "indications": ({V.INDICATION_COLUMN: "indication"}, None, V.INDICATION_CELL_PLACEHOLDERS),
}


def clean_columns(df: DataFrame, chosen: dict[str, C.Cleaner], placeholders: Sequence[str]) -> DataFrame:
    """Apply a cleaner per column; cells equal to a placeholder, and null cells, are null."""
    return df.withColumns(
        {c: cleaner(X.null_if_in(F.col(c), placeholders)) for c, cleaner in chosen.items()}
    )


def clean_table(
    df: DataFrame, profile: str = "current", overrides: dict[str, C.Cleaner] | None = None
) -> DataFrame:
    """Clean every column the profile knows; absent ones are skipped, the rest passes."""
    fixed, numbered, placeholders = PROFILES[profile]
    chosen = {c: C.CLEANERS[name] for c, name in fixed.items() if c in df.columns}
    if numbered:
        chosen |= {c: C.CLEANERS[numbered] for c in S.numbered_columns(df.columns)}
    return clean_columns(df, chosen | (overrides or {}), placeholders)
