"""Inspect, repair, inspect again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxweave.operators import inspection as I
from dxweave.operators import repair as R
from dxweave.operators import schema as S
from dxweave.session import materialize


def numbered_rules(template: DataFrame) -> DataFrame:
    """A generated template as a rule table.  Its keys are unique, so any order will do."""
    return template.withColumn("rule_no", F.monotonically_increasing_id())


def audit(df: DataFrame, id_column: str = "record_id", mode: str = "global") -> tuple[DataFrame, list[int]]:
    """Apply the rules each inspection recommends until one changes nothing.

    Returns the repaired table and the number of changes per round.  The input and every round are
    written to the shared folder, so the plan does not grow with the rounds, and the cells of a round
    are judged once for its flags and its changes.  If a set of
    changes comes again, rules undo each other and no round would be the last: an error.
    """
    changes_per_round: list[int] = []
    seen: set[tuple] = set()
    pairs = S.code_pairs(df.columns)
    df = materialize(df, "audited")
    while True:
        annotated = I.stored_cells(S.pair_cells(df, pairs, id_column))
        template = materialize(I.rule_template(I.flags_of(annotated, mode)), "template")
        rules = R.load_rules(numbered_rules(template))
        changes = materialize(R.changes_of(R.slots(annotated), rules), "changes")
        row = F.xxhash64("record_id", "col_ord", "pos", "old_code", "new_code").cast("decimal(38,0)")
        n, mark = changes.agg(F.count("*"), F.sum(row)).first()
        changes_per_round.append(n)
        if not n:
            return df, changes_per_round
        if (n, mark) in seen:
            raise ValueError(f"the same {n} changes come again after {len(changes_per_round)} rounds: rules undo each other")
        seen.add((n, mark))
        df = materialize(R.apply_changes(df, changes, pairs, id_column), "repaired")
