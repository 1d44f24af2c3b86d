"""Reconciling manifests with files and with each other.

All of these are equi-joins or aggregates on a key; nothing emits pairs within
a group.  Hot keys are handled by partial aggregation (aggregates) and by AQE
skew-join splitting, which only matches a join whose sides are plain exchanges:
semi- and anti-joins therefore take the other side with its repeats (no
``distinct`` in between), and one-row-per-key aggregates are dealt out once
(``_dealt``) before they are joined back.  Broadcasts are left to the planner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from manifestqc.functions.blank import is_blank, is_blank_trimmed, not_blank, strip_ws
from manifestqc.functions.paths import basename, resolve_path
from manifestqc.functions.vocab import FILE_COLUMNS
from manifestqc.operators.issues import empty_issues, issues
from manifestqc.operators.rows import first_per_key, tail_rows

ROW = "_row"
HELPER_COLUMNS = ("_row", "_width", "_open_quote", "_fixed", "file_number")


def _existing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _row_col(df: DataFrame) -> Column:
    return F.col(ROW) if ROW in df.columns else F.lit(None).cast("long")


# ------------------------------------------------------------ file references --
def file_refs(df: DataFrame, key: str = "sample_name", file_columns: Sequence[str] = FILE_COLUMNS,
              base: str | Column | None = None, strip: bool = True) -> DataFrame:
    """One row per non-blank file cell: ``(key, _row, column, col_pos, file, path)``.
    ``path`` is the file resolved against ``base``."""
    cols = _existing(df, file_columns)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "key string, _row long, column string, col_pos int, file string, path string")
    pos = {c: i for i, c in enumerate(cols)}
    keyc = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")

    def cell(c: str) -> Column:
        v = F.col(c).cast("string")
        return (strip_ws(v) if strip else v).alias(c)

    # Cells are cleaned before the unpivot; above the Expand only plain
    # column references remain (no common subexpressions to factor out).
    wide = df.select(keyc.alias("key"), _row_col(df).alias(ROW), *[cell(c) for c in cols])
    long = wide.unpivot(["key", ROW], cols, "column", "file")
    if strip:
        long = long.filter(F.col("file").isNotNull() & (F.col("file") != ""))
    else:
        long = long.filter(~is_blank_trimmed(F.col("file")))
    col_pos = None
    for c, i in pos.items():
        col_pos = F.when(F.col("column") == c, F.lit(i)) if col_pos is None else col_pos.when(F.col("column") == c, F.lit(i))
    return long.select("key", ROW, "column", col_pos.alias("col_pos"), "file",
                       resolve_path(F.col("file"), base, strip=False).alias("path"))


def _dealt(per_key: DataFrame) -> DataFrame:
    """A one-row-per-key table dealt out evenly, so that the join above it shuffles it anew and can split hot keys."""
    return per_key.repartition(int(per_key.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _inventory_paths(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    return inventory.select(F.col(path_col).alias("path"))


def missing_files(refs: DataFrame, inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """References whose path is not in the inventory (an anti-join)."""
    return refs.join(_inventory_paths(inventory, path_col), "path", "left_anti")


def found_files(refs: DataFrame, inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """References whose path is in the inventory (a semi-join)."""
    return refs.join(_inventory_paths(inventory, path_col), "path", "left_semi")


def verify_files(refs: DataFrame, inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """References with a ``found`` flag: one left join gives both partitions."""
    inv = _dealt(_inventory_paths(inventory, path_col).distinct()).withColumn("found", F.lit(True))
    return refs.join(inv, "path", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def missing_by_sample(missing: DataFrame) -> DataFrame:
    """``(key, n_missing, first_missing, last_missing)`` per sample.  Whole
    counts, flat; the per-file detail stays in ``missing`` (no per-key list is
    collected, so a sample with millions of files costs nothing extra)."""
    return (missing.groupBy("key").agg(
        F.count(F.lit(1)).cast("long").alias("n_missing"),
        F.min("path").alias("first_missing"),
        F.max("path").alias("last_missing")))


def file_counts(verified: DataFrame) -> DataFrame:
    """One row: found, missing, samples with a missing file, all_exist."""
    return verified.agg(
        F.count_if(F.col("found")).cast("long").alias("n_found"),
        F.count_if(~F.col("found")).cast("long").alias("n_missing"),
        F.countDistinct(F.when(~F.col("found"), F.col("key"))).cast("long").alias("n_samples_missing"),
    ).withColumn("all_exist", F.col("n_missing") == 0)


def missing_file_issues(missing: DataFrame, tbl: str = "sample") -> DataFrame:
    return issues(missing, None, "missing_file", tbl, col=F.col("column"), key=F.col("key"),
                  row=F.col(ROW), value=F.col("path"), message="referenced file not found",
                  severity="error")


def remove_samples(df: DataFrame, bad_keys: DataFrame, key: str = "sample_name",
                   bad_key_col: str = "key") -> DataFrame:
    """Drop rows whose key is in ``bad_keys`` (null keys are never removed)."""
    if df is None or key not in df.columns:
        return df
    bad = bad_keys.select(F.col(bad_key_col).alias(key))
    return df.join(bad, key, "left_anti")


def derived_pair_paths(df: DataFrame, key: str, base: str = "", r1_suffix: str = "_R1.fastq.gz",
                       r2_suffix: str = "_R2.fastq.gz") -> DataFrame:
    """``(key, mate, path)`` for the two file names derived from each key."""
    prefix = F.lit(base.rstrip("/") + "/") if base else F.lit("")
    k = F.col(key)
    return (df.filter(F.col(key).isNotNull()).select(
        k.alias("key"),
        F.explode(F.array(
            F.struct(F.lit("R1").alias("mate"), F.concat(prefix, k, F.lit(r1_suffix)).alias("path")),
            F.struct(F.lit("R2").alias("mate"), F.concat(prefix, k, F.lit(r2_suffix)).alias("path")),
        )).alias("_p")).select("key", "_p.mate", "_p.path"))


def derived_files(df: DataFrame, key: str, inventory: DataFrame, **kw) -> DataFrame:
    """Found/missing counts of the derived R1/R2 names: one row."""
    paths = derived_pair_paths(df, key, **kw)
    v = verify_files(paths, inventory)
    return v.agg(F.count_if(F.col("found")).cast("long").alias("n_found"),
                 F.count_if(~F.col("found")).cast("long").alias("n_missing"),
                 F.count(F.lit(1)).cast("long").alias("n_expected"))


def complete_pair_keys(df: DataFrame, key: str, inventory: DataFrame, **kw) -> DataFrame:
    """Keys whose R1 and R2 both exist (semi-join, then a count per key)."""
    paths = derived_pair_paths(df, key, **kw).dropDuplicates(["key", "mate"])
    found = paths.join(_inventory_paths(inventory), "path", "left_semi")
    return _dealt(found.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 2).select("key"))


def keep_keys(df: DataFrame, keys: DataFrame, key: str = "sample_name", keys_col: str = "key") -> DataFrame:
    """Keep rows whose key is in ``keys`` (semi-join)."""
    return df.join(keys.select(F.col(keys_col).alias(key)), key, "left_semi")


# ------------------------------------------------------------ table vs table --
def filename_mismatch(sample: DataFrame, project: DataFrame, key: str = "sample_name",
                      file_columns: Sequence[str] = FILE_COLUMNS) -> DataFrame:
    """Samples in both tables whose same-named file cells (first row per
    sample) are both non-blank, differ, and differ in base name.
    ``(key, column, sample_file, project_file)``."""
    common = [c for c in _existing(sample, file_columns) if c in project.columns]
    if not common or key not in sample.columns or key not in project.columns:
        return sample.sparkSession.createDataFrame(
            [], "key string, column string, sample_file string, project_file string")

    def side(df: DataFrame, name: str) -> DataFrame:
        first = first_per_key(df.select(key, _row_col(df).alias(ROW), *common), key, ROW)
        long = first.select(F.col(key).alias("key"), *[F.col(c).cast("string") for c in common]) \
                    .unpivot(["key"], common, "column", name)
        return long.filter(~is_blank_trimmed(F.col(name))).withColumn(name, strip_ws(F.col(name)))

    joined = side(sample, "sample_file").join(side(project, "project_file"), ["key", "column"])
    return joined.filter((F.col("sample_file") != F.col("project_file"))
                         & (basename(F.col("sample_file")) != basename(F.col("project_file"))))


def key_summary(sample: DataFrame, project: DataFrame, key: str = "sample_name",
                file_columns: Sequence[str] = FILE_COLUMNS) -> DataFrame:
    """One row per non-null key of either table: ``(key, n_sample, n_project,
    sample_first, project_first)``, the last two holding the row position and
    the file cells that both tables have, of the key's first row.

    Both tables are stacked and aggregated once (partial aggregates before the
    one shuffle, so a hot key costs a row per task); duplicates, coverage and
    file-name mismatches are filters over the result."""
    common = [c for c in _existing(sample, file_columns) if c in project.columns]

    def side(df: DataFrame, of_sample: bool) -> DataFrame:
        first = F.struct(_row_col(df).alias(ROW), *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(common)])
        return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lit(of_sample).alias("_s"), first.alias("_first"))

    return side(sample, True).unionByName(side(project, False)).groupBy("key").agg(
        F.count_if(F.col("_s")).cast("long").alias("n_sample"),
        F.count_if(~F.col("_s")).cast("long").alias("n_project"),
        F.min(F.when(F.col("_s"), F.col("_first"))).alias("sample_first"),
        F.min(F.when(~F.col("_s"), F.col("_first"))).alias("project_first"))


def summary_coverage_issues(summary: DataFrame, key: str = "sample_name") -> DataFrame:
    """``key_coverage`` issues from ``key_summary``: keys of one table only."""
    only = F.when(F.col("n_sample") == 0, F.lit("project")).otherwise(F.lit("sample"))
    return issues(summary, (F.col("n_sample") == 0) | (F.col("n_project") == 0), "key_coverage", only, col=key, key=F.col("key"),
                  message=F.concat(F.lit("key only in the "), only, F.lit(" table")), severity="warning")


def summary_mismatches(summary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``filename_mismatch`` from ``key_summary``; ``columns`` are the file cells that both tables have, in its order."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"sample_first.f{i}").alias("a"), F.col(f"project_first.f{i}").alias("b"))
             for i, c in enumerate(columns)]
    if not cells:
        return summary.sparkSession.createDataFrame([], "key string, column string, sample_file string, project_file string")
    long = summary.filter((F.col("n_sample") > 0) & (F.col("n_project") > 0)).select("key", F.explode(F.array(*cells)).alias("c"))
    long = long.filter(~is_blank_trimmed(F.col("c.a")) & ~is_blank_trimmed(F.col("c.b"))).select(
        "key", "c.column", strip_ws(F.col("c.a")).alias("sample_file"), strip_ws(F.col("c.b")).alias("project_file"))
    return long.filter((F.col("sample_file") != F.col("project_file")) & (basename(F.col("sample_file")) != basename(F.col("project_file"))))


def summary_duplicate_issues(summary: DataFrame, sample: DataFrame, project: DataFrame, key: str = "sample_name") -> DataFrame:
    """``duplicate_keys`` issues of both tables in one join: their rows with the counts from ``key_summary`` (plain
    exchanges on both sides, so AQE splits a hot key)."""
    def rows(df: DataFrame, tbl: str) -> DataFrame:
        return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), _row_col(df).alias(ROW), F.lit(tbl).alias("tbl"))

    counts = summary.filter((F.col("n_sample") > 1) | (F.col("n_project") > 1)).select("key", "n_sample", "n_project")
    joined = rows(sample, "sample").unionByName(rows(project, "project")).join(counts, "key")
    n = F.when(F.col("tbl") == "sample", F.col("n_sample")).otherwise(F.col("n_project"))
    return _repeated(joined.withColumn("n_rows", n).filter(F.col("n_rows") > 1), F.col("tbl"), key)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull()).distinct()


def key_coverage(a: DataFrame, b: DataFrame, key: str = "sample_name",
                 a_name: str = "sample", b_name: str = "project") -> DataFrame:
    """Keys present in one table only, both directions in one full outer join:
    ``(key, only_in)``."""
    ka = distinct_keys(a, key).withColumn("_a", F.lit(True))
    kb = distinct_keys(b, key).withColumn("_b", F.lit(True))
    j = ka.join(kb, "key", "full_outer")
    return j.filter(F.col("_a").isNull() | F.col("_b").isNull()).select(
        "key", F.when(F.col("_a").isNull(), F.lit(b_name)).otherwise(F.lit(a_name)).alias("only_in"))


def common_keys(a: DataFrame, b: DataFrame, key: str = "sample_name") -> DataFrame:
    return distinct_keys(a, key).intersect(distinct_keys(b, key))


def keys_except(a: DataFrame, b: DataFrame, key: str = "sample_name") -> DataFrame:
    return distinct_keys(a, key).subtract(distinct_keys(b, key))


def duplicate_keys(df: DataFrame, key: str = "sample_name") -> DataFrame:
    """``(key, n_rows, first_row, last_row)`` for keys on more than one row.
    Null keys are ignored, ``''`` counts as a value."""
    return (df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.min(_row_col(df)).alias("first_row"),
        F.max(_row_col(df)).alias("last_row"),
    ).filter(F.col("n_rows") > 1))


def duplicate_rows(df: DataFrame, key: str = "sample_name", salt_buckets: int = 1) -> DataFrame:
    """Every row of a duplicated key: ``(key, _row, n_rows)``.  The per-key
    counts (one row per key) are dealt out and joined back, so AQE splits a hot key.  With
    ``salt_buckets > 1`` the join is salted explicitly (for plans without
    AQE): the row side takes ``hash(_row) mod n`` (deterministic, so a retried
    task gets the same salt) and the one-row-per-key side is replicated over
    the n salts, so a hot key spreads over n tasks."""
    dups = duplicate_keys(df, key).select("key", "n_rows")
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), _row_col(df).alias(ROW))
    if salt_buckets <= 1:
        return rows.join(_dealt(dups), "key")
    n = int(salt_buckets)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col(ROW)), F.lit(n)))
    salted_dups = dups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return salted_rows.join(salted_dups, ["key", "_salt"]).drop("_salt")


def duplicate_issues(df: DataFrame, tbl: str, key: str = "sample_name") -> DataFrame:
    if key not in df.columns:
        return empty_issues(df.sparkSession)
    return _repeated(duplicate_rows(df, key), tbl, key)


def _repeated(rows: DataFrame, tbl: str | Column, key: str) -> DataFrame:
    return issues(rows, None, "duplicate_keys", tbl, col=key, key=F.col("key"), row=F.col(ROW),
                  value=F.col("n_rows").cast("string"),
                  message=F.concat(F.lit("key occurs on "), F.col("n_rows").cast("string"), F.lit(" rows")),
                  severity="warning")


def _data_columns(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key and c not in HELPER_COLUMNS]


def missing_cells(df: DataFrame, key: str = "sample_name") -> DataFrame:
    """``(col, n_missing)``: blank cells on rows with a valid key (all such
    rows lie at or before the last valid key).  One aggregate pass."""
    cols = _data_columns(df, key)
    if key not in df.columns or not cols:
        return df.sparkSession.createDataFrame([], "col string, n_missing long")
    valid = not_blank(F.col(key))
    wide = df.agg(*[F.count_if(valid & is_blank(F.col(c))).cast("long").alias(f"m{i}")
                    for i, c in enumerate(cols)])
    pairs = ", ".join("'{}', m{}".format(c.replace("'", "\\'"), i) for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (col, n_missing)").filter("n_missing > 0")


def missing_cell_rows(df: DataFrame, key: str = "sample_name") -> DataFrame:
    """Long form ``(col, _row)`` of the blank cells counted by ``missing_cells``."""
    cols = _data_columns(df, key)
    valid = df.filter(not_blank(F.col(key)))
    long = valid.select(ROW, *[F.col(c).cast("string") for c in cols]).unpivot([ROW], cols, "col", "value")
    return long.filter(is_blank(F.col("value"))).select("col", ROW)


def tail_cells(df: DataFrame, key: str = "sample_name") -> DataFrame:
    """Non-blank cells below the last valid key: ``(col, _row, value)``."""
    cols = _data_columns(df, key)
    if key not in df.columns or not cols:
        return df.sparkSession.createDataFrame([], "col string, _row long, value string")
    tail = tail_rows(df, key)
    long = tail.select(ROW, *[F.col(c).cast("string") for c in cols]).unpivot([ROW], cols, "col", "value")
    return long.filter(not_blank(F.col("value")))


def tail_data(df: DataFrame, key: str = "sample_name") -> DataFrame:
    """``(col, n_rows, first_row, last_row)`` of data beyond the last valid key."""
    return tail_cells(df, key).groupBy("col").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.min(ROW).alias("first_row"), F.max(ROW).alias("last_row"))


def alignment_issues(df: DataFrame, tbl: str, key: str = "sample_name") -> DataFrame:
    if key not in df.columns:
        return empty_issues(df.sparkSession)
    t = tail_cells(df, key)
    tail_i = issues(t, None, "tail_data", tbl, col=F.col("col"), row=F.col(ROW), value=F.col("value"),
                    message="data below the last valid key is ignored", severity="warning")
    return tail_i.unionByName(missing_cell_issues(df, tbl, key))


def missing_cell_issues(df: DataFrame, tbl: str, key: str = "sample_name") -> DataFrame:
    if key not in df.columns:
        return empty_issues(df.sparkSession)
    m = missing_cells(df, key)
    return issues(m, None, "missing_cells", tbl, col=F.col("col"), value=F.col("n_missing").cast("string"),
                  message=F.concat(F.lit("blank on "), F.col("n_missing").cast("string"), F.lit(" keyed rows")),
                  severity="info")


def change_counts(before: DataFrame, after: DataFrame, columns: Sequence[str], row: str = ROW) -> DataFrame:
    """``(col, n_changed)`` per column between two versions joined on ``row``."""
    cols = [c for c in columns if c in before.columns and c in after.columns]
    b = before.select(row, *[F.col(c).cast("string").alias(f"b{i}") for i, c in enumerate(cols)])
    a = after.select(row, *[F.col(c).cast("string").alias(f"a{i}") for i, c in enumerate(cols)])
    j = b.join(a, row, "full_outer")
    wide = j.agg(*[F.count_if(~F.col(f"b{i}").eqNullSafe(F.col(f"a{i}"))).cast("long").alias(f"n{i}")
                   for i in range(len(cols))])
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (col, n_changed)")


def count_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``(n_a, n_b, equal)`` from two global counts (the second as a
    scalar subquery)."""
    nb = b.agg(F.count(F.lit(1)).cast("long")).scalar()
    return (a.agg(F.count(F.lit(1)).cast("long").alias("n_a"))
            .select("n_a", nb.alias("n_b"))
            .withColumn("equal", F.col("n_a") == F.col("n_b")))


def common_fields(a: DataFrame, b: DataFrame, key_a: str = "sample_name", key_b: str = "sample_name",
                  exclude: Sequence[str] = HELPER_COLUMNS) -> DataFrame:
    """Columns present in both tables (from the schemas) with the number of
    distinct non-null keys of each table: ``(col, n_keys_a, n_keys_b)``.
    The two counts are distinct aggregates run once as scalar subqueries."""
    cols = [c for c in a.columns if c in b.columns and c not in exclude]
    spark = a.sparkSession
    names = spark.createDataFrame([(c,) for c in cols], "col string")
    na = a.agg(F.countDistinct(F.col(key_a)).cast("long")).scalar()
    nb = b.agg(F.countDistinct(F.col(key_b)).cast("long")).scalar()
    return names.select("col", na.alias("n_keys_a"), nb.alias("n_keys_b"))
