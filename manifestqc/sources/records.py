"""Lines of text files as records, where a quoted cell may span separators, lines and input splits.

A cell is quoted if it opens with ``"`` and its closing ``"`` (quotes inside are
doubled) stands before a separator or the end of a line.  An opening quote without such
a closing one is text, and its line a record of its own: an unclosed quote never
swallows what follows it.

A line is a map of two states, outside and inside a quoted cell: lines without
quotes map each to itself, and a line that is reached inside either closes the cell,
passes it on, or shows that its opening quote was text.  Input splits are read in parts of at most
``2 ** PART_BITS`` lines, so that a worker never holds a whole split.  Maps of lines compose to a map of their
part, and maps of parts, one row each, are composed by a prefix scan over the
table of parts.  Each part then knows its first state and record number, and its
lines are cut independently; only lines of records that span several are grouped.
Parts without quotes that start outside are never passed to Python.

The lines themselves stay where they are, in the order they were numbered in: the table of parts is broadcast to them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from manifestqc.session import materialize

QUOTE = '"'
CLOSES, BREAKS, PASSES = 1, -1, 0
PART_BITS = 14
PART = ["_file", "_block", "_part"]


def _quoted_end(text: str, at: int, sep: str) -> tuple[int, bool]:
    """From inside a quoted cell: the place after its closing quote and whether that quote stands where it may; -1 if there is none."""
    while (at := text.find(QUOTE, at)) >= 0:
        if text.startswith(QUOTE, at + 1):
            at += 2
            continue
        return at + 1, at + 1 == len(text) or text.startswith(sep, at + 1)
    return -1, False


def cells_of(text: str, sep: str = "\t") -> tuple[list[str], bool]:
    """Cells of a record, and whether a cell opens with a quote that nothing closes (such a cell is text up to the next separator)."""
    cells, at, broken = [], 0, False
    while True:
        if text.startswith(QUOTE, at):
            end, closed = _quoted_end(text, at + 1, sep)
            if closed:
                cells.append(text[at + 1:end - 1].replace(QUOTE + QUOTE, QUOTE))
                if end == len(text):
                    return cells, broken
                at = end + len(sep)
                continue
            broken = True
        end = text.find(sep, at)
        cells.append(text[at:] if end < 0 else text[at:end])
        if end < 0:
            return cells, broken
        at = end + len(sep)


def _left_open(text: str, at: int, sep: str) -> bool:
    """Whether a line read from the start of a cell ends inside a quoted one."""
    while True:
        if text.startswith(QUOTE, at):
            end, closed = _quoted_end(text, at + 1, sep)
            if end < 0:
                return True
            if closed:
                if end == len(text):
                    return False
                at = end + len(sep)
                continue
        end = text.find(sep, at)
        if end < 0:
            return False
        at = end + len(sep)


class Line(NamedTuple):
    """What a line with quotes does: is it left open when it starts a record; what it does to a cell that is open; is it left open then."""
    opens: bool
    meets: int
    reopens: bool


def line_map(text: str, sep: str = "\t") -> Line:
    opens = _left_open(text, 0, sep)
    end, closed = _quoted_end(text, 0, sep)
    if end < 0:
        return Line(opens, PASSES, True)
    if not closed:
        return Line(opens, BREAKS, opens)
    return Line(opens, CLOSES, end < len(text) and _left_open(text, end + len(sep), sep))


class _Split:
    """Lines of one part: which are blank, and what those with quotes do."""

    def __init__(self, values: pa.ChunkedArray, sep: str):
        trimmed = pc.replace_substring_regex(values, "\r$", "")
        self.filled = pc.not_equal(trimmed, "").to_numpy(zero_copy_only=False).astype(bool)
        self.at = np.flatnonzero(pc.match_substring(trimmed, QUOTE).to_numpy(zero_copy_only=False).astype(bool))
        self.maps = [line_map(t, sep) for t in trimmed.take(pa.array(self.at)).to_pylist()]

    def summary(self, inside: bool) -> tuple[bool, int, int]:
        """From the given first state: the last state, the records, and the lines after a quote left open (records if it is text)."""
        before = np.concatenate([[0], np.cumsum(self.filled)])
        records = waiting = done = 0
        for i, m in zip(self.at.tolist(), self.maps):
            plain = int(before[i] - before[done])
            done = i + 1
            if not inside:
                records, inside, waiting = records + plain + 1, m.opens, 0
            elif m.meets == PASSES:
                waiting += plain + 1
            elif m.meets == CLOSES:
                inside, waiting = m.reopens, 0
            else:
                records, inside, waiting = records + waiting + plain + 1, m.opens, 0
        plain = int(before[-1] - before[done])
        return (True, records, waiting + plain) if inside else (False, records + plain, 0)

    def first_meeting(self) -> int:
        return next((m.meets for m in self.maps if m.meets), 0)

    def cut(self, inside: bool, last_valid: bool) -> tuple[np.ndarray, np.ndarray, bool]:
        """For each line, whether it starts a record and whether it goes on with the one before (neither: a blank line); whether the last record goes on."""
        more = np.zeros(len(self.filled), bool)
        opened = 0  # first line that belongs to the open cell if it closes
        for i, m in zip(self.at.tolist(), self.maps):
            if not inside:
                inside, opened = m.opens, i + 1
            elif m.meets == CLOSES:
                more[opened:i + 1] = True
                inside, opened = m.reopens, i + 1
            elif m.meets == BREAKS:
                inside, opened = m.opens, i + 1
        if inside and last_valid:
            more[opened:] = True
        return self.filled & ~more, more, inside and last_valid


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split and a number that counts the lines of a task; a line ends with a line feed."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid"))


def _parted(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_part", F.shiftright("_mid", PART_BITS))


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one part (equal ``first_line``), each as one table; a part is bounded, a split need not be."""
    held: list[pa.RecordBatch] = []
    part = line = -1
    for batch in batches:
        if not batch.num_rows:
            continue
        firsts, lines = (batch.column(c).to_numpy() for c in ("first_line", "_mid"))
        if lines[0] <= line or (np.diff(lines) <= 0).any():
            raise RuntimeError("lines are not in the order they were numbered in")
        line = int(lines[-1])
        cuts = [0, *(np.flatnonzero(np.diff(firsts)) + 1).tolist(), len(firsts)]
        for start, end in zip(cuts, cuts[1:]):
            if firsts[start] != part and held:
                yield pa.Table.from_batches(held)
                held = []
            part = int(firsts[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


_SPLITS = "first_line long, end_out boolean, records_out long, waiting_out long, end_in boolean, records_in long, waiting_in long, meets int"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _mapped_splits(lines: DataFrame, quoted: DataFrame, sep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_part(batches):
            part = _Split(rows.column("value"), sep)
            row = [rows.column("first_line")[0].as_py(), *part.summary(False), *part.summary(True), part.first_meeting()]
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], _names(_SPLITS))

    of_part = _parted(lines).join(F.broadcast(quoted.select(*PART, "first_line")), PART)
    return of_part.select("first_line", "_mid", "value").mapInArrow(run, _SPLITS)


def plain_splits(lines: DataFrame) -> tuple[DataFrame, bool, bool]:
    """Per part its first line, its filled lines and whether it has to be scanned (quotes, blank lines); whether any part holds quotes, or has to be scanned."""
    filled = ~F.col("value").isin("", "\r")
    has_quote = F.contains("value", F.lit(QUOTE))
    plain = materialize(_parted(lines).groupBy(*PART).agg(F.min("_mid").alias("first_line"), F.count_if(filled).alias("filled"), F.max(has_quote).alias("quoted"),
                                                          F.max(has_quote | ~filled).alias("scanned")))
    quoted, scanned = plain.agg(F.max("quoted"), F.max("scanned")).first()
    return plain, bool(quoted), bool(scanned)


def _first_of_file() -> Column:
    return F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_part")) == 1


def counted_splits(plain: DataFrame) -> DataFrame:
    """``split_table`` where no part has to be scanned: running sums over one row per part."""
    before = Window.orderBy(*PART).rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("_file")
    splits = plain.withColumn("first_record", F.coalesce(F.sum("filled").over(before), F.lit(0)))
    splits = splits.withColumn("file_first", F.min("first_record").over(file)).withColumn("head", _first_of_file().cast("int"))
    return splits.select(*PART, "first_line", F.lit(False).alias("scanned"), F.lit(False).alias("inside"), "first_record", "file_first",
                         F.sum("head").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("heads"))


def split_table(lines: DataFrame, plain: DataFrame, quoted: bool, sep: str) -> DataFrame:
    """One row per part: first state (``inside``), whether an open cell at its start and end closes, and the number of its first record.

    A prefix scan composes the parts' maps: with P the parity of swapping maps so far and
    c the value of the last constant map combined with the parity then, the state is P xor c.
    """
    if not quoted:
        nothing = {"end_out": F.lit(False), "end_in": F.lit(True), "records_out": F.col("filled"), "waiting_out": F.lit(0), "records_in": F.lit(0),
                   "waiting_in": F.col("filled"), "meets": F.lit(PASSES)}
        maps = plain.withColumns(nothing)
    else:
        maps = plain.join(_mapped_splits(lines, plain.where("quoted"), sep), "first_line", "left").select(
            *PART, "first_line", "scanned", F.coalesce("end_out", F.lit(False)).alias("end_out"), F.coalesce("end_in", F.lit(True)).alias("end_in"),
            F.coalesce("records_out", "filled").alias("records_out"), F.coalesce("waiting_out", F.lit(0)).alias("waiting_out"),
            F.coalesce("records_in", F.lit(0)).alias("records_in"), F.coalesce("waiting_in", "filled").alias("waiting_in"), F.coalesce("meets", F.lit(0)).alias("meets"))
    file = Window.partitionBy("_file").orderBy("_block", "_part")
    so_far = file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = F.col("end_out") & ~F.col("end_in")
    parity = (F.sum(swaps.cast("int")).over(so_far) % 2).alias("parity")
    maps = maps.withColumn("parity", parity)
    constant = F.when(F.col("end_out") == F.col("end_in"), (F.col("end_out").cast("int") + F.col("parity")) % 2)
    after = (F.col("parity") + F.coalesce(F.last(constant, ignorenulls=True).over(so_far), F.lit(0))) % 2 == 1
    back = Window.partitionBy("_file").orderBy(F.desc("_block"), F.desc("_part")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    coming = F.last(F.when(F.col("meets") != 0, F.col("meets")), ignorenulls=True).over(back)  # from here on; a frame that ends here is added to, row by row
    maps = maps.withColumn("after", after).withColumn("closes", F.coalesce(coming == CLOSES, F.lit(False)))
    maps = (maps.withColumn("raw", F.lag("after", 1, False).over(file)).withColumn("last_valid", F.lead("closes", 1, False).over(file)))
    open_end = F.when(F.col("raw"), F.col("end_in")).otherwise(F.col("end_out")) & ~F.col("last_valid")
    records = (F.when(F.col("raw"), F.col("records_in")).otherwise(F.col("records_out"))
               + F.when(open_end, F.when(F.col("raw"), F.col("waiting_in")).otherwise(F.col("waiting_out"))).otherwise(0))
    maps = maps.withColumn("records", records).withColumn("inside", F.col("raw") & F.col("closes"))
    before = Window.orderBy(*PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    maps = maps.withColumn("first_record", F.coalesce(F.sum("records").over(before), F.lit(0)))
    whole = Window.partitionBy("_file")
    maps = maps.withColumn("file_first", F.min("first_record").over(whole)).withColumn("file_records", F.sum("records").over(whole))
    heads = F.when(_first_of_file() & (F.col("file_records") > 0), 1).otherwise(0)
    maps = maps.withColumn("head", heads).withColumn("heads", F.sum("head").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return materialize(maps.select(*PART, "first_line", "scanned", "inside", "last_valid", "first_record", "file_first", "heads"))


_CUT = "_block long, _mid long, value string, record long, shared boolean, file_first long, heads long"


def records(lines: DataFrame, splits: DataFrame, sep: str, scanned: bool) -> DataFrame:
    """(record, text, file_first, heads): every record, numbered from 0 over all files in order.

    In parts without quotes and blank lines the number of a line is plain arithmetic; ``scanned``: there are others.
    """
    known = _parted(lines).join(F.broadcast(splits), PART)
    plain = known.where(~F.col("scanned") & ~F.col("inside")).select("value", (F.col("first_record") + F.col("_mid") - F.col("first_line")).alias("record"), "file_first", "heads")
    alone = plain.select("record", F.col("value").alias("text"), "file_first", "heads")
    if scanned:
        within = known.where(~F.col("scanned") & F.col("inside")).withColumns({"record": F.col("first_record") - 1, "shared": F.lit(True)})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _by_part(batches):
                inside, valid, first = (rows.column(c)[0].as_py() for c in ("inside", "last_valid", "first_record"))
                starts, more, goes_on = _Split(rows.column("value"), sep).cut(inside, valid)
                keep = np.flatnonzero(starts | more)
                here = more[keep]
                table = rows.take(pa.array(keep))
                table = table.append_column("record", pa.array((first + np.cumsum(starts) - 1)[keep])).append_column("shared", pa.array(here | np.append(here[1:], goes_on)[:len(here)]))
                yield from table.select(_names(_CUT)).combine_chunks().to_batches()

        cut = known.where("scanned").select("first_line", "_block", "_mid", "value", "inside", "last_valid", "first_record", "file_first", "heads").mapInArrow(run, _CUT)
        every = within.select(_names(_CUT)).unionByName(cut)
        lines_of = F.transform(F.array_sort(F.collect_list(F.struct("_block", "_mid", "value"))), lambda x: x["value"])
        spread = every.where("shared").groupBy("record", "file_first").agg(F.array_join(lines_of, "\n").alias("text"), F.max("heads").alias("heads"))
        alone = alone.unionByName(every.where("not shared").select("record", F.col("value").alias("text"), "file_first", "heads")).unionByName(spread)
    return alone.withColumn("text", F.regexp_replace("text", "\r\\z", ""))


_PARSED = "cells array<string>, broken boolean"


def parsed(text: Column, sep: str, quoted: bool = True) -> Column:
    """Struct (cells, broken) of a record's text; records without quotes are split without Python."""
    plain = F.struct(F.split(text, re.escape(sep), -1).alias("cells"), F.lit(False).alias("broken"))
    if not quoted:
        return plain

    @F.pandas_udf(_PARSED)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if t is None else cells_of(t, sep) for t in texts], columns=["cells", "broken"])

    held = F.contains(text, F.lit(QUOTE))
    found = run(F.when(held, text))
    return F.when(held, F.struct(found["cells"].alias("cells"), found["broken"].alias("broken"))).otherwise(plain)
