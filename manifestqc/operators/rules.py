"""Column rules over a manifest: fill, ensure, vocabulary, synonyms, dates,
places, coordinates, and the row rules that only report.

Every transform is one ``select``/``withColumns`` over all touched columns so
the plan stays a single projection inside whole-stage codegen.  Vocabulary
membership uses ``isin`` with a literal list (an ``InSet`` hash lookup for
lists over 10 values); the vocabulary is configuration and is never joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from manifestqc.functions.blank import is_blank, is_blank_trimmed, not_blank, strip_ws
from manifestqc.functions.dates import normalize_date
from manifestqc.functions.geo import normalize_geo, normalize_latlon
from manifestqc.functions.text import LAYOUT_SYNONYMS, SOURCE_SYNONYMS, canonicalize
from manifestqc.functions.vocab import VALID_OPTIONS
from manifestqc.operators.issues import driver_issues, empty_issues, issues

ROW = "_row"


def _key_col(df: DataFrame, key: str | None) -> Column:
    return F.col(key) if key and key in df.columns else F.lit(None).cast("string")


def _row_col(df: DataFrame) -> Column:
    return F.col(ROW) if ROW in df.columns else F.lit(None).cast("long")


# --------------------------------------------------------------------- fill --
def fill_defaults(df: DataFrame, fields: Sequence[str], defaults: Mapping[str, str]) -> DataFrame:
    """Blank (null or '') cells of the listed fields take the field default,
    only when the column exists and a default exists."""
    todo = {f: F.when(is_blank(F.col(f)), F.lit(defaults[f])).otherwise(F.col(f))
            for f in fields if f in df.columns and f in defaults}
    return df.withColumns(todo) if todo else df


def fill_from_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """Blank ``target`` cells take the value of ``source`` in the same row."""
    if target not in df.columns or source not in df.columns:
        return df
    return df.withColumn(target, F.when(is_blank(F.col(target)), F.col(source)).otherwise(F.col(target)))


def fill_map_flag(df: DataFrame, values: Mapping[str, str], flag: str = "_fixed") -> DataFrame:
    """Fill blanks of several columns from a constant map and flag the rows
    that had at least one blank among them."""
    present = [c for c in values if c in df.columns]
    touched = reduce(lambda a, b: a | b, [is_blank(F.col(c)) for c in present], F.lit(False))
    out = df.withColumn(flag, touched)
    return fill_defaults(out, present, values)


def blank_counts(df: DataFrame, fields: Sequence[str], trimmed: bool = False) -> DataFrame:
    """``(col, n_blank)`` for the listed existing fields, one aggregate pass."""
    test = is_blank_trimmed if trimmed else is_blank
    present = [f for f in fields if f in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "col string, n_blank long")
    wide = df.agg(*[F.count_if(test(F.col(f))).cast("long").alias(f"n{i}") for i, f in enumerate(present)])
    pairs = ", ".join(f"'{f}', n{i}" for i, f in enumerate(present))
    return wide.selectExpr(f"stack({len(present)}, {pairs}) as (col, n_blank)")


def fill_counts(df: DataFrame, fields: Sequence[str], defaults: Mapping[str, str]) -> DataFrame:
    """``(col, n_blank_before, n_blank_after, n_filled)`` of filling the listed
    existing fields from ``defaults``, in one aggregate pass."""
    present = [f for f in fields if f in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "col string, n_blank_before long, n_blank_after long, n_filled long")
    blank = {f: is_blank(F.col(f)) for f in present}
    still = {f: blank[f] & F.lit(not defaults.get(f)) for f in present}  # no default, or a blank one
    wide = df.agg(*[F.count_if(c).cast("long").alias(f"{n}{i}") for n, cs in (("b", blank), ("a", still)) for i, c in enumerate(cs.values())])
    rows = ", ".join(f"'{f}', b{i}, a{i}" for i, f in enumerate(present))
    return wide.selectExpr(f"stack({len(present)}, {rows}) as (col, n_blank_before, n_blank_after)") \
        .withColumn("n_filled", F.col("n_blank_before") - F.col("n_blank_after"))


# ------------------------------------------------------------------- schema --
def ensure_columns(df: DataFrame, columns: Sequence[str], defaults: Mapping[str, str]) -> DataFrame:
    """Append missing columns (in the given order) holding the default or ''."""
    missing = {c: F.lit(defaults.get(c, "")) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def project_to_schema(df: DataFrame, fields: Sequence[str], defaults: Mapping[str, str],
                      keep: Sequence[str] = (ROW,)) -> DataFrame:
    """Exactly ``fields`` (copied when present, else default, else '') plus
    the ``keep`` helper columns that exist."""
    cols = [F.col(f) if f in df.columns else F.lit(defaults.get(f, "")).alias(f) for f in fields]
    cols += [F.col(k) for k in keep if k in df.columns and k not in fields]
    return df.select(*cols)


def constant_columns(df: DataFrame, values: Mapping[str, str], overwrite: bool = True) -> DataFrame:
    """Add constant columns (``contact_<k>``, ids, descriptions)."""
    todo = {k: F.lit(v) for k, v in values.items() if overwrite or k not in df.columns}
    return df.withColumns(todo) if todo else df


def contact_columns(contact: Mapping[str, str] | None) -> dict[str, str]:
    return {f"contact_{k}": v for k, v in (contact or {}).items()}


# --------------------------------------------------------------- vocabulary --
def enforce_vocab(df: DataFrame, options: Mapping[str, Iterable[str]] = VALID_OPTIONS,
                  defaults: Mapping[str, str] | None = None) -> DataFrame:
    """A non-blank value outside its field's vocabulary becomes the field
    default when there is one, else stays.  Case-sensitive."""
    defaults = defaults or {}
    todo = {field: enforced(F.col(field), options[field], defaults[field])
            for field in options if field in df.columns and field in defaults}
    return df.withColumns(todo) if todo else df


def vocab_bad(c: Column, vals: Iterable[str]) -> Column:
    """A non-blank value outside the vocabulary."""
    return not_blank(c) & ~c.isin(*list(dict.fromkeys(vals)))


def enforced(c: Column, vals: Iterable[str], default: str | None) -> Column:
    """The value after vocabulary enforcement (default replaces a bad value)."""
    if default is None:
        return c
    return F.when(vocab_bad(c, vals), F.lit(default)).otherwise(c)


def vocab_cells(df: DataFrame, options: Mapping[str, Iterable[str]], key: str | None = None) -> DataFrame:
    """Long form ``(key, _row, field, value)`` of the constrained columns."""
    fields = [f for f in options if f in df.columns]
    if not fields:
        return df.sparkSession.createDataFrame([], "key string, _row long, field string, value string")
    base = df.select(_key_col(df, key).alias("key"), _row_col(df).alias(ROW),
                     *[F.col(f).cast("string").alias(f) for f in fields])
    return base.unpivot(["key", ROW], fields, "field", "value")


def vocab_violation_cells(df: DataFrame, options: Mapping[str, Iterable[str]] = VALID_OPTIONS,
                          key: str | None = None) -> DataFrame:
    """Cells with a non-blank value outside the vocabulary:
    ``(key, _row, field, value)``.  Membership is an ``isin`` per field (a
    hash-set lookup inside codegen) and only offending cells are emitted, in
    one scan: no unpivot of every cell, no join."""
    fields = [f for f in options if f in df.columns]
    if not fields:
        return df.sparkSession.createDataFrame([], "key string, _row long, field string, value string")
    items = [F.when(vocab_bad(F.col(f), options[f]),
                    F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")))
             for f in fields]
    hits = df.select(_key_col(df, key).cast("string").alias("key"), _row_col(df).alias(ROW),
                     F.explode(F.array(*items)).alias("_c")).filter(F.col("_c").isNotNull())
    return hits.select("key", ROW, F.col("_c.field").alias("field"), F.col("_c.value").alias("value"))


def vocab_violations(df: DataFrame, options: Mapping[str, Iterable[str]] = VALID_OPTIONS) -> DataFrame:
    """``(field, value, n_rows)`` per distinct offending value."""
    return (vocab_violation_cells(df, options)
            .groupBy("field", "value").agg(F.count(F.lit(1)).cast("long").alias("n_rows")))


# ----------------------------------------------------------------- synonyms --
def canonical_layout(df: DataFrame, column: str = "library_layout",
                     synonyms: Mapping[str, Sequence[str]] = LAYOUT_SYNONYMS) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, canonicalize(F.col(column), synonyms))


def canonical_source(df: DataFrame, column: str = "sample_source",
                     synonyms: Mapping[str, Sequence[str]] = SOURCE_SYNONYMS) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, canonicalize(F.col(column), synonyms))


# ------------------------------------------------------- dates, place, coords --
def _trimmed(df: DataFrame, c: Column) -> tuple[DataFrame, str]:
    """``df`` with the trimmed value in a column of its own: in the rules it would be trimmed again wherever they name it."""
    name = "_trimmed"
    while name in df.columns:
        name += "_"
    return df.withColumn(name, strip_ws(c)), name


def date_column(df: DataFrame, column: str = "collection_date", default: str | None = None) -> DataFrame:
    """Fill exact blanks with the default (when given), then normalise every
    value that is neither the default nor whitespace-only."""
    if column not in df.columns:
        return df
    c = F.col(column)
    filled = F.when(is_blank(c), F.lit(default)).otherwise(c) if default is not None else c
    out, name = _trimmed(df, filled)
    t = F.col(name)
    guard = filled.isNull() | (t == "")
    if default is not None:
        guard = guard | (filled == F.lit(default))
    return out.withColumn(column, F.when(guard, filled).otherwise(normalize_date(filled, trimmed=t))).drop(name)


def date_column_strict(df: DataFrame, column: str = "collection_date") -> DataFrame:
    """Every value normalised; blank or unrecognised -> ``not collected``."""
    if column not in df.columns:
        return df
    out, t = _trimmed(df, F.col(column))
    return out.withColumn(column, normalize_date(F.col(column), strict=True, trimmed=F.col(t))).drop(t)


def geo_column(df: DataFrame, column: str = "geo_loc_name") -> DataFrame:
    if column not in df.columns:
        return df
    out, t = _trimmed(df, F.col(column))
    return out.withColumn(column, normalize_geo(F.col(column), F.col(t))).drop(t)


def latlon_column(df: DataFrame, column: str = "lat_lon") -> DataFrame:
    if column not in df.columns:
        return df
    out, t = _trimmed(df, F.col(column))
    return out.withColumn(column, normalize_latlon(F.col(column), F.col(t))).drop(t)


# ------------------------------------------------------------ report rules --
# Row-level rules are specs (condition, column, value, message); any number of
# them is evaluated in ONE pass: each row yields an array with one slot per
# rule (null when the rule does not fire), exploded and filtered.  The input
# is scanned once however many rules there are.
class RuleSpec:
    __slots__ = ("rule", "cond", "col", "value", "message", "severity")

    def __init__(self, rule: str, cond: Column, col: str | None, value: Column, message,
                 severity: str = "warning"):
        self.rule, self.cond, self.col, self.value = rule, cond, col, value
        self.message = message if isinstance(message, Column) else F.lit(message)
        self.severity = severity


def row_issues(df: DataFrame, specs: Sequence[RuleSpec], tbl: str, key: str | None = "sample_name") -> DataFrame:
    """Issues of all ``specs`` over ``df`` in one scan (one ``explode``)."""
    if not specs:
        return empty_issues(df.sparkSession)
    items = [F.when(s.cond, F.struct(
        F.lit(s.rule).alias("rule"), F.lit(s.col).cast("string").alias("col"),
        s.value.cast("string").alias("value"), s.message.cast("string").alias("message"),
        F.lit(s.severity).alias("severity"))) for s in specs]
    # explode the fixed-size array and drop the rules that did not fire: both
    # stay inside whole-stage codegen (array_compact would add a lambda)
    hits = df.select(_key_col(df, key).cast("string").alias("_k"), _row_col(df).alias("_r"),
                     F.explode(F.array(*items)).alias("_i")).filter(F.col("_i").isNotNull())
    return hits.select(F.col("_i.rule").alias("rule"), F.lit(tbl).alias("tbl"), F.col("_i.col").alias("col"),
                       F.col("_k").alias("key"), F.col("_r").alias("row"), F.col("_i.value").alias("value"),
                       F.col("_i.message").alias("message"), F.col("_i.severity").alias("severity"))


def vocab_specs(values: Mapping[str, Column], options: Mapping[str, Iterable[str]] = VALID_OPTIONS,
                defaults: Mapping[str, str] | None = None) -> list[RuleSpec]:
    """One spec per constrained field present in ``values`` (field -> Column)."""
    defaults = defaults or {}
    out = []
    for field, vals in options.items():
        if field in values:
            d = defaults.get(field)
            msg = f"not in vocabulary, replaced by {d}" if d is not None else "not in vocabulary, no default"
            out.append(RuleSpec("vocabulary", vocab_bad(values[field], vals), field, values[field], msg))
    return out


def layout_mate_spec(layout: Column, mate: Column, layout_col: str = "library_layout") -> RuleSpec:
    """``paired`` without a second file, ``single`` with one (warning)."""
    paired_bad = (layout == "paired") & is_blank(mate)
    single_bad = (layout == "single") & ~is_blank(mate)
    msg = F.when(paired_bad, F.lit("paired layout without a second file")) \
           .otherwise(F.lit("single layout with a second file"))
    return RuleSpec("layout_mate", paired_bad | single_bad, layout_col, mate, msg)


def host_spec(source: Column, host: Column, host_col: str = "host") -> RuleSpec:
    """``host-associated`` with a blank host (warning)."""
    return RuleSpec("host", (source == "host-associated") & is_blank(host), host_col, source,
                    "host-associated sample without host")


def blank_date_spec(date: Column, column: str = "collection_date") -> RuleSpec:
    return RuleSpec("blank_date", is_blank(date), column, date, "empty collection date")


def vocab_issues(df: DataFrame, tbl: str, options: Mapping[str, Iterable[str]] = VALID_OPTIONS,
                 defaults: Mapping[str, str] | None = None, key: str | None = "sample_name") -> DataFrame:
    values = {c: F.col(c) for c in df.columns}
    return row_issues(df, vocab_specs(values, options, defaults), tbl, key)


def layout_mate_issues(df: DataFrame, tbl: str = "sample", key: str = "sample_name",
                       layout: str = "library_layout", mate: str = "filename2",
                       first: str = "filename") -> DataFrame:
    if not {layout, mate, first} <= set(df.columns):
        return empty_issues(df.sparkSession)
    return row_issues(df, [layout_mate_spec(F.col(layout), F.col(mate), layout)], tbl, key)


def host_issues(df: DataFrame, tbl: str = "project", key: str = "sample_name",
                source: str = "sample_source", host: str = "host") -> DataFrame:
    """Only when ``host`` exists."""
    if source not in df.columns or host not in df.columns:
        return empty_issues(df.sparkSession)
    return row_issues(df, [host_spec(F.col(source), F.col(host), host)], tbl, key)


def blank_date_issues(df: DataFrame, tbl: str = "project", key: str = "sample_name",
                      column: str = "collection_date") -> DataFrame:
    if column not in df.columns:
        return empty_issues(df.sparkSession)
    return row_issues(df, [blank_date_spec(F.col(column), column)], tbl, key)


def staged_values(df: DataFrame, fill_fields: Sequence[str], essential: Sequence[str],
                  defaults: Mapping[str, str]) -> dict[str, Column]:
    """Column expressions (over ``df``) of every column after fill + ensure,
    so rules on those values can run in the same scan as rules on raw values."""
    vals = {c: F.col(c) for c in df.columns}
    for f in fill_fields:
        if f in df.columns and f in defaults:
            vals[f] = F.when(is_blank(F.col(f)), F.lit(defaults[f])).otherwise(F.col(f))
    for c in essential:
        if c not in df.columns:
            vals[c] = F.lit(defaults.get(c, ""))
    return vals


def row_width_issues(df: DataFrame, n_columns: int, tbl: str, key: str = "sample_name",
                     width: str = "_width") -> DataFrame:
    """Lines with fewer (or more) cells than the header."""
    if width not in df.columns:
        return empty_issues(df.sparkSession)
    w = F.col(width)
    msg = F.when(w < n_columns, F.concat(F.lit("fewer cells than header: "), w.cast("string")))\
           .otherwise(F.concat(F.lit("more cells than header: "), w.cast("string")))
    return issues(df, w != F.lit(n_columns), "row_width", tbl, col=None, key=_key_col(df, key),
                  row=_row_col(df), value=w.cast("string"), message=msg, severity="warning")


def open_quote_issues(df: DataFrame, tbl: str, key: str = "sample_name", flag: str = "_open_quote") -> DataFrame:
    """Rows with a cell whose opening quote nothing closes (read as text, see ``sources.records``)."""
    if flag not in df.columns:
        return empty_issues(df.sparkSession)
    return issues(df, F.col(flag), "open_quote", tbl, key=_key_col(df, key), row=_row_col(df),
                  message="a quote is opened and not closed; the cell is read as text", severity="error")


def required_column_issues(df: DataFrame, required: Sequence[str], tbl: str) -> DataFrame:
    """Missing required columns: decided from the schema, no job."""
    rows = [("required_columns", tbl, c, None, None, None, "missing required column", "error")
            for c in required if c not in df.columns]
    return driver_issues(df.sparkSession, rows)
