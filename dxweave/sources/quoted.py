"""Delimited text with quoted line breaks, read by many tasks a file.

A line break ends a record only outside quotes, and whether a place is inside quotes depends on everything before it.  A
line, though, is one of few functions: it maps the state at its start (inside quotes or not) to the state at its end.  The
lines of a split compose to one such function, so one pass finds, for each split and either start, where it ends
and how many records begin in it.  Going through the splits of the files in order gives every split its
start state and the number of its first record; a second pass cuts the records.  A record that reaches over a split border leaves
a fragment on either side, and only fragments are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave.session import known_to_workers

_SPLIT = "file string, block long"
_BOM = "﻿"


def open_after(line: str, inside: bool) -> bool:
    """Whether ``line`` ends inside quotes, if it begins inside them or not.

    A quote opens a field only at its start; a doubled one inside quotes is a character.  What follows a closing quote up to
    the next comma belongs to the field as it is.
    """
    place = 0
    if not inside:
        if line[:1] == '"':
            place, inside = 1, True
        else:
            inside, place = _next_field(line, 0)
    while inside:
        quote = line.find('"', place)
        if quote < 0:
            return True
        if line[quote + 1 : quote + 2] == '"':
            place = quote + 2
        else:
            inside, place = _next_field(line, quote + 1)
    return False


def _next_field(line: str, place: int) -> tuple[bool, int]:
    """Whether a later field begins with a quote, and the place after it."""
    comma = line.find(',"', place)
    return comma >= 0, comma + 2


def _states(lines: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
    """State at the start of each line, and after the last.  Lines without a quote don't change it."""
    out = np.empty(len(lines), bool)
    done = 0
    for i in np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist():
        out[done : i + 1] = inside
        inside, done = open_after(lines[i].as_py(), inside), i + 1
    out[done:] = inside
    return out, inside


def _filled(lines: pa.Array) -> np.ndarray:
    """Lines that make a record where one can begin: an empty one does not."""
    return (pc.binary_length(pc.utf8_rtrim(lines, "\r")).to_numpy(zero_copy_only=False)) > 0


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[pa.Array]]]:
    """The lines of each split, which come one after another."""

    def runs() -> Iterator[tuple[tuple[str, int], pa.Array]]:
        for batch in batches:
            file, block = batch.column(1), batch.column(2)
            n = batch.num_rows
            if not n:
                continue
            cut = np.ones(n, bool)
            cut[1:] = np.asarray(pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])))
            starts = np.flatnonzero(cut).tolist()
            for a, b in zip(starts, [*starts[1:], n]):
                yield (file[a].as_py(), block[a].as_py()), batch.column(0)[a:b]

    for split, parts in groupby(runs(), key=lambda r: r[0]):
        yield split, (lines for _, lines in parts)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split and either start state: the state after it, and the records that begin in it."""
    for (file, block), parts in _by_split(batches):
        ends, counts = [False, True], [0, 0]
        for lines in parts:
            filled = _filled(lines)
            for k in (0, 1):
                states, ends[k] = _states(lines, ends[k])
                counts[k] += int((filled & ~states).sum())
        yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "ends": [ends], "counts": [counts]})


def _cutter(splits: dict[tuple[str, int], tuple[bool, int, bool, bool]], whole: bool):
    """Cuts the lines of each split to records (``whole``), or to the fragments of records that reach over its borders.

    ``splits`` has the state at the start, the number of the first record, whether that is a header, and whether the
    record that is open at the start is one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, parts in _by_split(batches):
            inside, number, header, open_header = splits[split]
            waiting: list[str] = []  # lines of the record that is not at its end
            foreign = inside  # it began in an earlier split
            first = split[1] == 0

            own = number

            def titled(at: int, foreign: bool) -> bool:
                return open_header if foreign else header and at == own

            for lines in parts:
                if first:
                    lines, first = pa.concat_arrays([pa.array([lines[0].as_py().removeprefix(_BOM)], lines.type), lines[1:]]), False
                states, after = _states(lines, inside)
                begins = ~states & _filled(lines)
                ends = ~np.append(states[1:], after)
                alone = begins & ends
                if whole and alone.any():
                    numbers = number + np.cumsum(begins)[alone] - 1
                    yield _rows(numbers, (numbers == own) & header, lines.filter(pa.array(alone)), split[1])
                made = []
                for i in np.flatnonzero(states | (begins & ~ends)).tolist():
                    if begins[i]:
                        waiting, foreign = [], False
                    waiting.append(lines[i].as_py())
                    if ends[i] and whole != foreign:
                        at = number + int(begins[: i + 1].sum()) - 1
                        made.append((at, titled(at, foreign), "\n".join(waiting)))
                    if ends[i]:
                        waiting = []
                number += int(begins.sum())
                inside = after
                if made:
                    yield _rows(*map(list, zip(*made)), split[1])
            if inside and not whole:
                yield _rows([number - 1], [titled(number - 1, foreign)], ["\n".join(waiting)], split[1])

    return run


def _rows(number, header, record, block: int) -> pa.RecordBatch:
    n = len(record)
    columns = [pa.array(number, pa.int64()), pa.array(header, pa.bool_()), pa.array(record).cast(pa.string()), pa.array([block] * n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["number", "header", "record", "block"])


def records(spark: SparkSession, path: str | Sequence[str], header: bool) -> DataFrame:
    """(number, record): the raw records of the files in (file, place) order, numbered from 0; empty lines are none.

    With ``header`` the first record of each file is left out.  A task reads a split of a file.  The driver gets four numbers for each
    split and sends them to the tasks.  Records end with a line feed, with or without a carriage return before it.  A quote that is never
    closed reaches to the end of its file, without the file's last line feed.
    """
    known_to_workers(spark)
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.option("lineSep", "\n").text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    found = lines.mapInArrow(_functions, _SPLIT + ", ends array<boolean>, counts array<long>").collect()
    splits, inside, number, file = {}, False, 0, None
    for r in sorted(found, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, inside, title, open_title = r["file"], False, header, False
        splits[r["file"], r["block"]] = (inside, number - title, title, open_title)
        begun = r["counts"][inside]
        if begun:
            number, open_title, title = number + begun - title, title and begun == 1, False
        inside = r["ends"][inside]
    shape = "number long, header boolean, record string, block long"
    whole = lines.mapInArrow(_cutter(splits, True), shape).select("number", "header", "record")
    parts = lines.mapInArrow(_cutter(splits, False), shape)
    joined = parts.groupBy("number", "header").agg(F.sort_array(F.collect_list(F.struct("block", "record"))).alias("parts"))
    stitched = joined.select("number", "header", F.array_join(F.col("parts")["record"], "\n").alias("record"))
    return whole.unionByName(stitched).filter(~F.col("header")).select("number", F.regexp_replace("record", "\r$", "").alias("record"))


def read_quoted(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], header: bool, ordinal: str) -> DataFrame:
    """All-string columns ``names`` and the 0-based record number ``ordinal``, parsed as Spark parses a delimited line."""
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    cut = records(spark, path, header).select(F.col("number").alias(ordinal), F.from_csv("record", schema, options).alias("__row"))
    return cut.select(ordinal, *[F.col("__row").getField(n).alias(n) for n in names])
