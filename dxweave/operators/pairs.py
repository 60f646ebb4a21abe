"""Term/code pairs and the statistics over them.

A row is placed by ``(record_id, col_ord, pos)``: input row, column, position in the
cell.  ``record_id`` is an integer; ``with_row_ordinal`` makes one where there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import text as X
from dxweave.session import materialize

PLACE = ("record_id", "col_ord", "pos")


def place() -> Column:
    return F.struct(*PLACE)


def _earliness(first: Column) -> Column:
    """Larger for an earlier place, so that ``max`` breaks ties towards the first seen."""
    return F.struct(*[(-first[c]).alias(c) for c in PLACE])


def ranked(n: Column, first: Column, value: Column) -> Column:
    """Struct whose maximum is the most frequent value, ties to the first seen."""
    return F.struct(n.alias("n"), _earliness(first).alias("earliness"), value.alias("value"))


# -- cells and pairs ----------------------------------------------------------


def annotate_cells(cells: DataFrame) -> DataFrame:
    """Judge the terms of each cell and line them up with its codes."""
    return lined_up(judge_cells(cells))


def judge_cells(cells: DataFrame) -> DataFrame:
    """Adds ``judged`` (term, norm, reason, at): the costly part, worth keeping where cells are read more than once."""
    norms = F.transform(
        F.col("terms"),
        lambda t, i: F.struct(t.alias("term"), X.normalize_trimmed(t).alias("norm"), i.alias("at")),
    )
    judged = F.transform(
        F.col("norms"),
        lambda e: F.struct(
            e["term"].alias("term"),
            e["norm"].alias("norm"),
            X.noise_reason(e["norm"]).alias("reason"),
            e["at"].alias("at"),
        ),
    )
    return cells.withColumn("norms", norms).withColumn("judged", judged).drop("norms")


def lined_up(judged: DataFrame) -> DataFrame:
    """Adds ``clean`` (the judged entries that are not noise), ``aligned`` (the entries that face a code,
    null when the cell cannot be paired) and ``prefiltered``: noise is removed up front only where
    the raw lengths differ.
    """
    return (
        judged.withColumns(
            {
                "clean": F.filter(F.col("judged"), lambda e: e["reason"].isNull()),
                "prefiltered": F.size("judged") != F.size("codes"),
            }
        )
        .withColumn(
            "aligned",
            F.when(~F.col("prefiltered"), F.col("judged")).when(
                F.size("clean") == F.size("codes"), F.col("clean")
            ),
        )
    )


def cell_pairs(annotated: DataFrame) -> DataFrame:
    """One row per aligned (term, code), noise terms included (``reason`` is set)."""
    zipped = F.arrays_zip("aligned", "codes")
    # A cell that cannot be paired has a null list here and so gives no row.
    rows = annotated.select(
        "record_id", "uuid", "admission_date", "col_ord", "column",
        F.posexplode(zipped).alias("pos", "pair"),
    )
    return rows.select(
        "record_id", "uuid", "admission_date", "col_ord", "column", "pos",
        F.col("pair.aligned.term").alias("term"),
        F.col("pair.aligned.norm").alias("norm"),
        F.col("pair.aligned.reason").alias("reason"),
        F.col("pair.codes").alias("code"),
    )


def usable_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("reason").isNull() & X.is_usable_code(F.col("code")))


#: Records of a chunk in which a place is one number.
CHUNK_BITS = 20
_COLUMN_BITS, _POS_BITS = 16, 27


def _chunk() -> Column:
    return F.shiftright(F.col("record_id").cast("bigint"), CHUNK_BITS)


def _packed_place() -> Column:
    """The place as one number that orders places within a chunk; records without an id are a chunk of their own."""
    record = F.coalesce(F.col("record_id").cast("bigint"), F.lit(0).cast("bigint")).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    column, pos = F.col("col_ord").cast("bigint"), F.col("pos").cast("bigint")
    packed = F.shiftleft(record, _COLUMN_BITS + _POS_BITS) + F.shiftleft(column, _POS_BITS) + pos
    fits = column.between(0, (1 << _COLUMN_BITS) - 1) & pos.between(0, (1 << _POS_BITS) - 1)
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("a record of more columns, or a cell of more terms, than a place has room for")).cast("bigint"))


def _unpacked(chunk: Column, packed: Column, types: dict[str, str]) -> Column:
    record = F.shiftleft(chunk, CHUNK_BITS) + F.shiftright(packed, _COLUMN_BITS + _POS_BITS)
    column = F.shiftright(packed, _POS_BITS).bitwiseAND(F.lit((1 << _COLUMN_BITS) - 1))
    values = zip(PLACE, (record, column, packed.bitwiseAND(F.lit((1 << _POS_BITS) - 1))), strict=True)
    return F.struct(*[value.cast(types[name]).alias(name) for name, value in values])


def _counted(pairs: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, first): how often each key occurs and its first place.

    A struct in an aggregate means sorting all rows. Numbers are aggregated by hash, so places are compared as
    numbers within chunks of records and as structs between chunks.
    """
    types = dict(pairs.dtypes)
    in_chunks = pairs.groupBy(*keys, _chunk().alias("__chunk")).agg(F.count("*").alias("n"), F.min(_packed_place()).alias("at"))
    first = _unpacked(F.col("__chunk"), F.col("at"), types)
    return in_chunks.groupBy(*keys).agg(F.sum("n").alias("n"), F.min(first).alias("first"))


# -- frequencies --------------------------------------------------------------


def term_code_stats(pairs: DataFrame) -> DataFrame:
    """Frequency of each (normalised term, code) over usable pairs."""
    return (
        usable_pairs(pairs)
        .groupBy(F.col("norm").alias("normalized_term"), "code")
        .agg(F.count("*").alias("frequency"))
    )


def ordered_stats(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc("frequency"), "normalized_term", "code")


def reverse_map(pairs: DataFrame) -> DataFrame:
    """(code, term, n): codes ascending, within a code the most frequent term first."""
    stats = term_code_stats(pairs)
    renamed = stats.select("code", F.col("normalized_term").alias("term"), F.col("frequency").alias("n"))
    return renamed.orderBy("code", F.desc("n"), "term")


def reverse_report(pairs: DataFrame, parts: int = 16) -> DataFrame:
    """(code, part, terms): the terms of a code as maps from term to count.

    The terms of every code are spread over the same number of parts by their md5, so the form of a report
    does not depend on its size; ``parts`` is at most 256.  A part without terms has no row.
    """
    stats = term_code_stats(pairs)
    entry = F.struct((-F.col("frequency")).alias("k"), F.col("normalized_term").alias("t"))
    byte = F.conv(F.left(F.md5(F.col("normalized_term").cast("binary")), F.lit(2)), 16, 10).cast("bigint")
    return (
        stats.withColumn("part", F.pmod(byte, F.lit(parts)))
        .groupBy("code", "part")
        .agg(F.sort_array(F.collect_list(entry)).alias("e"))
        .select(
            "code",
            "part",
            F.map_from_entries(
                F.transform("e", lambda x: F.struct(x["t"], (-x["k"]).alias("n")))
            ).alias("terms"),
        )
    )


def majority(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The codes of each term, and per term the winner and the usual spelling.

    Returns ``(codes, winners)``: ``codes`` (norm, code, n, first) and ``winners`` (norm,
    n_codes, major_code, major_n, term_first, display).  Raw pairs are reduced once, to
    (term, spelling, code) counts, kept in the shared folder; everything else works on those.
    """
    fine = materialize(_counted(usable_pairs(pairs), "norm", "code", "term"), "counted")
    total = [F.sum("n").alias("n"), F.min("first").alias("first")]
    codes = fine.groupBy("norm", "code").agg(*total)
    spellings = fine.groupBy("norm", "term").agg(*total)
    winners = codes.groupBy("norm").agg(
        F.max(ranked(F.col("n"), F.col("first"), F.col("code"))).alias("top"),
        F.count("*").alias("n_codes"),
        F.min("first").alias("term_first"),
    )
    display = spellings.groupBy("norm").agg(
        F.max(ranked(F.col("n"), F.col("first"), F.col("term")))["value"].alias("display")
    )
    winners = winners.select(
        "norm", "n_codes", "term_first",
        F.col("top.value").alias("major_code"), F.col("top.n").alias("major_n"),
    )
    return codes, winners.join(display, "norm")


def global_recommendation(pairs: DataFrame) -> DataFrame:
    """(norm, recommended_code, recommended_code_frequency) over the whole input."""
    codes = _counted(usable_pairs(pairs), "norm", "code")
    top = codes.groupBy("norm").agg(
        F.max(ranked(F.col("n"), F.col("first"), F.col("code"))).alias("top")
    )
    return top.select(
        "norm",
        F.col("top.value").alias("recommended_code"),
        F.col("top.n").alias("recommended_code_frequency"),
    )


# -- the most common code so far ----------------------------------------------

#: Pairs that a task of the second pass sorts, about; a term's pairs of one chunk stay together.
PAIRS_PER_TASK = 1 << 19


def running_recommendation(pairs: DataFrame, chunk_records: int = 1 << 20) -> DataFrame:
    """Adds to each pair without a usable code the most common usable code of the same
    term among *earlier* pairs and its count; ``("", 0)`` when there is none.

    One window per term would put a frequent term into a single task.  Records are cut
    into chunks of consecutive ids instead.  A first pass counts per (term, chunk, code),
    combined before the shuffle; running totals over those counts give what each chunk
    starts from.  The second pass sorts pairs within (term, chunk), a group bounded by
    the chunk size, behind the rows that carry the past.
    """
    judged = pairs.filter(F.col("reason").isNull()).withColumns(
        {
            "chunk": F.floor(F.col("record_id") / chunk_records),
            "usable": X.is_usable_code(F.col("code")),
        }
    )
    counts = _counted(judged, "norm", "chunk", "code").select(
        "norm", "chunk", "code", F.col("n").alias("here"), F.col("first").alias("first_here"),
        X.is_usable_code(F.col("code")).alias("usable"),
    )
    so_far = Window.partitionBy("norm", "code").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    history = materialize(
        counts.withColumns(
            {"upto": F.sum("here").over(so_far), "first": F.min("first_here").over(so_far)}
        ),
        "history",
    )
    # As many tasks as keep what a task sorts at a bounded number of pairs.
    spark = pairs.sparkSession
    n = history.agg(F.sum("here")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PAIRS_PER_TASK))
    # Two kinds of rows open a chunk: the past of each code that occurs in it, and the
    # winner over all earlier chunks, whose code need not occur in it.
    past = history.filter(F.col("usable") & (F.col("upto") > F.col("here"))).select(
        "norm", "chunk", "code", (F.col("upto") - F.col("here")).alias("weight"), "first"
    )
    before = Window.partitionBy("norm").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    standing = F.when(F.col("usable"), ranked(F.col("upto"), F.col("first"), F.col("code")))
    winner = (
        history.groupBy("norm", "chunk")
        .agg(F.max(standing).alias("best"), F.max(~F.col("usable")).alias("asks"))
        .withColumn("best", F.max("best").over(before))
        .filter(F.col("asks") & F.col("best").isNotNull())
        .select("norm", "chunk", "best")
    )
    details = judged.select(
        "norm", "chunk", "code",
        F.when(F.col("usable"), F.lit(1).cast("bigint")).alias("weight"),
        place().alias("at"),
        F.when(
            ~F.col("usable"), F.struct("uuid", "admission_date", "column", "term", "code")
        ).alias("ask"),
    )
    everything = (
        details.unionByName(past, allowMissingColumns=True)
        .unionByName(winner, allowMissingColumns=True)
        .repartition(tasks, "norm", "chunk")
    )
    upto_now = (Window.unboundedPreceding, Window.currentRow)
    by_code = Window.partitionBy("norm", "chunk", "code").orderBy("at").rowsBetween(*upto_now)
    in_chunk = Window.partitionBy("norm", "chunk").orderBy("at").rowsBetween(*upto_now)
    candidate = F.when(
        F.col("weight").isNotNull(),
        ranked(F.sum("weight").over(by_code), F.min(F.coalesce("first", "at")).over(by_code), F.col("code")),
    ).otherwise(F.col("best"))
    answered = (
        everything.withColumn("candidate", candidate)
        .withColumn("top", F.max("candidate").over(in_chunk))
        .filter(F.col("ask").isNotNull())
    )
    return answered.select(
        F.col("at.record_id"), F.col("at.col_ord"), F.col("at.pos"),
        F.col("ask.uuid"), F.col("ask.admission_date"), F.col("ask.column"),
        F.col("ask.term"), "norm", F.col("ask.code"),
        F.coalesce(F.col("top.value"), F.lit("")).alias("recommended_code"),
        F.coalesce(F.col("top.n"), F.lit(0)).cast("bigint").alias("recommended_code_frequency"),
    )
