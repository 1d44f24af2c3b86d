"""Manifest tables in and out.

Reading goes through the text source plus ``from_csv`` instead of the CSV
source, because the CSV source drops lines made of tabs only and cannot report
how many cells a line had.  Every data line keeps its 0-based position
``_row`` (file order, then line order) and its cell count ``_width``.

Cells may be quoted with ``"`` and then hold separators, doubled quotes and line
breaks, in headers too (without breaks).  Other readers of such tables often take every
line as a row, so the writer refuses line breaks unless it is told to quote them
(``breaks="quote"``) or to encode them (``breaks="encode"``, undone by the
reader's option of the same name).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from manifestqc.functions.blank import DEFAULT_NA_TOKENS, apply_na_tokens
from manifestqc.operators.rows import in_ranges
from manifestqc.session import materialize, sparing_disk
from manifestqc.sources.files import is_folder, listed
from manifestqc.sources.records import cells_of, counted_splits, parsed, plain_splits, read_lines, records, split_table

ROW = "_row"
WIDTH = "_width"
OPEN_QUOTE = "_open_quote"
ACCEPTED_SUFFIXES = (".txt", ".tsv", ".tab")


class UnsupportedFormat(ValueError):
    pass


def check_format(path: str, spark: SparkSession | None = None) -> None:
    """Tab-delimited text only: ``.txt``/``.tsv``/``.tab`` files or a directory
    of them.  ``.csv`` is refused (a comma table read as tab-delimited would be
    one column wide); spreadsheets must be converted first."""
    base = path.rstrip("/")
    if "*" in base or (is_folder(spark, base) if spark else os.path.isdir(base)):
        return
    ext = os.path.splitext(base.rsplit("/", 1)[-1])[1].lower()
    if ext in ACCEPTED_SUFFIXES or ext == "":
        return  # a named text file, or a folder written by a job (no suffix)
    if ext in (".xls", ".xlsx"):
        raise UnsupportedFormat(f"spreadsheet input is not read here, convert to tab-delimited text: {path}")
    raise UnsupportedFormat(f"unsupported manifest format {ext or '(none)'}: {path}")


def _header_names(cells: Sequence[str]) -> list[str]:
    """Header cells as column names: blanks become ``_c<i>``, repeats get ``_<n>``."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, raw in enumerate(cells):
        name = raw.strip().lstrip("\ufeff") if raw is not None else ""
        if not name:
            name = f"_c{i}"
        if name in seen:
            seen[name] += 1
            name = f"{name}_{seen[name]}"
        else:
            seen[name] = 0
        out.append(name)
    return out


def read_manifest(spark: SparkSession, path: str, sep: str = "\t",
                  na_tokens: Iterable[str] | str = (), header: Sequence[str] | None = None,
                  check: bool = True, breaks: str = "none", open_quotes: bool = False) -> DataFrame:
    """Read a tab-delimited manifest; all columns ``StringType``.

    * Fully empty lines are skipped; lines of separators only are kept as
      all-null rows.
    * Short lines are padded with null, cells beyond the header are dropped
      (alignment is kept) and ``_width`` records the cell count for the
      ``row_width`` rule.
    * ``na_tokens``: cells equal to one of them become null; ``"default"``
      selects the common reader token list.  Empty cells are always null.
    * With several files (e.g. a written directory) every file's first line is
      its header (unless ``header`` names the columns); headers that differ are
      an error, as the cells would land in the wrong columns.
    * Quoted cells may hold separators, doubled quotes and line breaks, across
      input splits too.  An opening quote that nothing closes is text and ends no
      other cell or line (``sources.records``); ``open_quotes=True`` adds ``_open_quote``, which
      marks such rows for the ``open_quote`` rule.
    * ``breaks="encode"`` undoes the writer's encoding of line breaks.

    The lines are checkpointed once, so that offsets and rows come from one cut
    of the input.  ``_row`` needs no sort: one row per part of an input split says how many
    records start in it, a running sum over that table gives each part's first number,
    and inside a part lines are counted.  The header is the first record of each file.
    """
    if check:
        check_format(path, spark)
    lines = materialize(read_lines(spark, path))
    plain, quoted, scanned = plain_splits(lines)
    splits = split_table(lines, plain, quoted, sep) if scanned else counted_splits(plain)
    if header is None:
        # A header is the first record of its file and ends in the file's first split.
        heads = [r["text"] for r in records(lines.where("_block = 0"), splits, sep, scanned)
                 .where("record = file_first").select(F.regexp_replace("text", "^\ufeff", "").alias("text")).distinct().take(2)]
        if not heads:
            raise ValueError(f"empty manifest: {path}")
        if len(heads) > 1:
            raise ValueError(f"the files of {path} have different headers: {heads[0]!r} and {heads[1]!r}")
        if "\r" in heads[0]:
            raise ValueError(f"the lines of {path} end with carriage returns alone; convert them to line feeds")
        cells, broken = cells_of(heads[0], sep)
        if broken:
            raise ValueError(f"the header of {path} has a quote that is not closed")
        names = _header_names(cells)
        data = records(lines, splits, sep, scanned).where("record <> file_first").withColumn(ROW, F.col("record") - F.col("heads"))
    else:
        names = list(header)
        data = records(lines, splits, sep, scanned).withColumn(ROW, F.col("record"))
    rows = data.select(parsed(F.col("text"), sep, quoted).alias("_p"), F.col(ROW).cast("long").alias(ROW))
    tokens = DEFAULT_NA_TOKENS if na_tokens == "default" else tuple(na_tokens)
    cells = {n: F.nullif(F.get("_p.cells", F.lit(i)), F.lit("")) for i, n in enumerate(names)}
    if breaks == "encode":
        cells = {n: _decoded(c) for n, c in cells.items()}
    cols = [(apply_na_tokens(c, tokens) if tokens else c).alias(n) for n, c in cells.items()]
    extra = [F.col("_p.broken").alias(OPEN_QUOTE)] if open_quotes else []
    return rows.select(*cols, ROW, F.size("_p.cells").cast("long").alias(WIDTH), *extra)


def _encoded(c: Column) -> Column:
    """Backslashes doubled, then line feeds and carriage returns as ``\\n`` and ``\\r``."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _decoded(c: Column) -> Column:
    """Undoes ``_encoded``: cut at doubled backslashes, so that the text between holds escapes only."""
    parts = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\")


def write_manifest(df: DataFrame, out_dir: str, sep: str = "\t", order_col: str | None = ROW,
                   mode: str = "overwrite", drop: Sequence[str] = (ROW, WIDTH, OPEN_QUOTE), breaks: str = "refuse") -> None:
    """Write a manifest as tab-delimited text with a header, in row order.

    Ranges of the order column + per-partition sort keep the
    global order across part files without a single-partition sort; the bounds come from that column alone.  Empty
    strings are written empty (not ``""``), whitespace is kept.  A cell with a
    line break is an error, or with ``breaks="encode"`` written in escapes, or
    with ``breaks="quote"`` written as it is in a quoted cell."""
    if breaks not in ("refuse", "encode", "quote"):
        raise ValueError("breaks must be 'refuse', 'encode' or 'quote'")
    with sparing_disk(df.sparkSession):
        _write_ordered(df, out_dir, sep, order_col, mode, drop, breaks)


def _write_ordered(df: DataFrame, out_dir: str, sep: str, order_col: str | None, mode: str, drop: Sequence[str], breaks: str) -> None:
    out = df
    if order_col and order_col in df.columns:
        out = in_ranges(out, order_col)
    keep = [c for c in out.columns if c not in drop]
    text = [c for c, t in out.select(*keep).dtypes if t == "string"]
    if breaks == "encode":
        out = out.withColumns({c: _encoded(F.col(f"`{c}`")) for c in text})
    elif text and breaks == "refuse":
        broken = F.lit("a cell holds a line break; write it with breaks='encode'")
        out = out.withColumns({c: F.when(F.col(f"`{c}`").rlike("[\\r\\n]"), F.raise_error(broken)).otherwise(F.col(f"`{c}`")) for c in text})
    (out.select(*keep).write.mode(mode)
        .option("sep", sep).option("header", True).option("emptyValue", "")
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(out_dir))


def write_list(df: DataFrame, column: str, out_dir: str, mode: str = "overwrite") -> None:
    """One value per line, sorted (upload lists, failed lists)."""
    (df.select(F.col(column).cast("string").alias("value"))
       .repartitionByRange("value").sortWithinPartitions("value")
       .write.mode(mode).text(out_dir))


SEQUENCE_GLOB = "*.{fastq,fq,fastq.gz,fq.gz}"


def list_files(spark: SparkSession, directory: str, recursive: bool = True,
               glob: str = SEQUENCE_GLOB) -> DataFrame:
    """Sequence files under a folder: ``(path, name, length)``.

    The folders are expanded level by level in tasks (``sources.files.listed``): names that
    start with ``_`` or ``.`` are found and no file index is held by the driver.  ``glob`` names files with
    ``*``, ``?``, ``[...]`` and ``{a,b}``.  It serves to find new files to pair; whether a referenced file
    exists is asked of the file itself (``existing_files``).  Local paths have no scheme, as in manifests."""
    name = F.substring_index("path", "/", -1)
    return listed(spark, directory, recursive).where(name.rlike(glob_pattern(glob))).select("path", name.alias("name"), "length")


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression over a whole name."""
    out, depth, i = "", 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        elif c == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            body = glob[i + 1:end].replace("\\", "\\\\").replace("[", "\\[")
            out += "[" + ("^" + body[1:] if body[0] in "!^" else body) + "]"
            i = end
        else:
            out += re.escape(c)
        i += 1
    return f"(?s)^{out}\\z"
