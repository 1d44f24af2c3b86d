"""Row order without a single partition.

Spark rows have no order, so anything that depends on "row N" uses an explicit
order column.  ``dense_number`` gives 1..N (or 0..N-1) in that order without
``row_number()`` over an unpartitioned window (which plans
``Exchange SinglePartition``):

1. draw a bounded sample of keys (smallest hash, so it does not depend on the
   partitions), sort it in Spark and take B-1 of its keys as bounds;
2. a key is all order columns (and a hash of the row where they are not unique), so rows
   that tie on the first column, or on all, still fall into different ranges.  A row's range
   id is a pure function of its key (a balanced binary tree of comparisons with literal
   bounds in the order that Spark sorts by), so re-evaluation is deterministic;
3. count rows (or add up any sizes) per range and turn the B totals into start
   offsets with a running sum over that B-row table;
4. ``row_number`` (or a running sum) inside each range (the one shuffle of the data,
   each range to a task of its own: hashed ids would put several ranges into some tasks and none into others), then join the offsets on the range id (the data side is
   already partitioned by it; only the B-row side moves).

Order columns may be of any type that Spark sorts.  With ``unique=False`` only rows
that are equal in every column share a range whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from manifestqc.functions._col import as_col
from manifestqc.functions.blank import not_blank
from manifestqc.session import materialize

BUCKET = "_nb_bucket"


def _default_buckets(df: DataFrame) -> int:
    """One range per shuffle partition."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


SAMPLE_PER_RANGE = 64
TIE = "_nb_tie"


def _literal(value, kind: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.TimestampType):  # sampled as microseconds, see range_buckets
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.lit(value.isoformat()).cast(kind)
    return F.lit(value).cast(kind)


def _bucket_expr(key: Column, bounds: Sequence[Column]) -> Column:
    """Number of bounds that sort before the key, as a balanced CASE tree: O(log B) comparisons per row.

    Structs compare field by field in Spark's sort order, nulls first."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key > bounds[mid], tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds))


def _row_hash(df: DataFrame) -> Column:
    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if hashable(f.dataType) and f.name != TIE])


def range_buckets(df: DataFrame, order: str | Sequence[str], n_buckets: int | None = None, unique: bool = True) -> Column:
    """A Column giving a range id of the composite key ``order``, about equally many rows in each.

    Runs one job, which brings ``SAMPLE_PER_RANGE`` keys per range to the driver."""
    n = n_buckets or _default_buckets(df)
    order = [order] if isinstance(order, str) else list(order)
    if n <= 1:
        return F.lit(0)
    keys = [F.col(c) for c in order]
    exact = [F.unix_micros(c).alias(f"_nb_{i}") if isinstance(df.schema[o].dataType, T.TimestampType) else c.alias(f"_nb_{i}") for i, (o, c) in enumerate(zip(order, keys))]
    tie = [] if unique else [_row_hash(df).alias("_nb_hash")]
    names = [f"_nb_{i}" for i in range(len(order))] + ["_nb_hash"] * len(tie)
    sample = df.select(*exact, *tie).orderBy(F.xxhash64(*names), *names).limit(n * SAMPLE_PER_RANGE).orderBy(*names).collect()
    if len(sample) < 2:
        return F.lit(0)
    picked = [tuple(sample[len(sample) * i // n]) for i in range(1, n)]
    bounds = [b for i, b in enumerate(picked) if not i or b != picked[i - 1]]
    kinds = [df.schema[c].dataType for c in order] + [T.LongType()] * len(tie)
    fields = [f"k{i}" for i in range(len(kinds))]
    key = F.struct(*[c.alias(f) for c, f in zip([*keys, *tie], fields)])
    return _bucket_expr(key, [F.struct(*[_literal(v, k).alias(f) for v, k, f in zip(b, kinds, fields)]) for b in bounds])


def in_ranges(df: DataFrame, order_col: str) -> DataFrame:
    """Rows in the order of a column: its ranges go one to a task and are sorted there.

    ``repartitionByRange`` computes every column of every row for its sample, and again of the partitions that are larger than
    others; the sample of ``range_buckets`` reads what the order column needs."""
    return df.repartitionById(_default_buckets(df), range_buckets(df, order_col)).sortWithinPartitions(order_col)


def _as_double(df: DataFrame, col: str) -> Column:
    """A monotone double image of an orderable column."""
    dtype = dict(df.dtypes)[col]
    c = F.col(col)
    if dtype == "date":
        return F.unix_date(c).cast("double")
    if dtype == "timestamp":
        return F.unix_micros(c).cast("double")
    if dtype == "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


ROWS_PER_RANGE = 1_000_000


def uniform_buckets(df: DataFrame, order_col: str, rows_per_range: int = ROWS_PER_RANGE) -> Column:
    """Equal-width ranges over [min, max] of ``order_col``, about
    ``rows_per_range`` rows each when the values are spread evenly (row
    positions, sequence numbers, keys): extremes and count are scalar subqueries (no job
    runs here), plain arithmetic per row, and as many ranges as the data needs (no cap), but
    never fewer than the shuffle partitions (small inputs stay parallel)."""
    v = _as_double(df, order_col)
    stats = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(F.lit(1)).alias("n"))
    lo, hi, n = (stats.select(c).scalar() for c in ("lo", "hi", "n"))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = F.greatest(F.lit(1), F.least(n, F.greatest(F.lit(least), F.ceil(n / F.lit(int(rows_per_range))))))
    place = F.floor((v - lo) * ranges / (hi - lo + F.lit(1.0)))
    return F.coalesce(F.least(place, ranges - 1), F.lit(-1)).cast("long")  # rows without a value come first


def dense_number(df: DataFrame, order_col: str | Sequence[str], name: str = "_row", start: int = 0,
                 n_buckets: int | None = None, bucket: Column | None = None,
                 within: str | Sequence[str] | None = None, materialize_input: bool = False,
                 ranges: str = "quantile", rows_per_range: int = ROWS_PER_RANGE, unique: bool = True) -> DataFrame:
    """Add ``name`` = start, start+1, ... in ascending order of ``order_col``
    (one column or several, of any type that sorts; nulls first).  Where the columns together are
    not unique, ``unique=False`` orders ties by a hash of the row and spreads them over
    ranges too (that reads all columns in every pass).

    Ranges are cut on the whole key, so ties on the first column spread over
    ranges.  ``bucket`` may be given instead: any Column monotone in the order
    (e.g. the input split of a text file); ``within`` then names the order inside a
    bucket (default: the order columns).

    ``ranges="uniform"`` cuts equal-width ranges of the first column instead of sampled ones, for
    order columns spread evenly over their range (positions, sequence
    numbers): no sample, and the number of ranges grows with the data.

    The input is evaluated three times (sample, range counts, numbering);
    ``materialize_input`` checkpoints an expensive input first (reliable
    checkpoint in the shared checkpoint folder)."""
    numbered = _running(df, order_col, {name: F.lit(1)}, n_buckets, bucket, within, materialize_input, ranges, rows_per_range, unique)
    return numbered.withColumn(name, (F.col(name) + F.lit(start)).cast("long"))


def running_sums(df: DataFrame, order_col: str | Sequence[str], sums: Mapping[str, Column], n_buckets: int | None = None,
                 materialize_input: bool = False, ranges: str = "quantile", unique: bool = True) -> DataFrame:
    """Add, for each entry of ``sums``, the sum of that Column over all rows before a row, in the order of
    ``order_col``, without a window over the whole table (nulls count as 0)."""
    return _running(df, order_col, sums, n_buckets, None, None, materialize_input, ranges, ROWS_PER_RANGE, unique)


def _running(df: DataFrame, order_col: str | Sequence[str], sums: Mapping[str, Column], n_buckets: int | None, bucket: Column | None,
             within: str | Sequence[str] | None, materialize_input: bool, ranges: str, rows_per_range: int, unique: bool) -> DataFrame:
    if materialize_input:
        df = materialize(df)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    inside = within or order
    inside = [inside] if isinstance(inside, str) else list(inside)
    if bucket is not None:
        b = bucket
    elif ranges == "uniform":
        b = uniform_buckets(df, order[0], rows_per_range)
    else:
        b = range_buckets(df, order, n_buckets, unique)
    tasks = n_buckets or _default_buckets(df) if bucket is None and ranges != "uniform" else None
    parts = {f"_nb_v{i}": c for i, c in enumerate(sums.values())}
    tie = {} if unique else {TIE: _row_hash(df)}
    tagged = df.withColumns({BUCKET: b, **tie, **parts})
    totals = tagged.groupBy(BUCKET).agg(*[F.sum(v).alias(v) for v in parts])
    # Start offsets of the ranges: running sums over a table of one row per
    # range, so this window's single partition holds B rows only.
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(BUCKET, *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}_off") for v in parts])
    # Sums inside each range first (one shuffle of the data on the range id),
    # then the offsets join on the same key: the big side is already
    # partitioned by it, only the B-row side moves (AQE may broadcast it).
    w = Window.partitionBy(BUCKET).orderBy(*inside, *tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    apart = tagged.repartitionById(tasks, BUCKET) if tasks else tagged
    local = apart.withColumns({f"{v}_in": F.coalesce(F.sum(v).over(w), F.lit(0)) - F.coalesce(v, F.lit(0)) for v in parts})
    out = local.join(offsets, BUCKET).withColumns({name: F.col(f"{v}_in") + F.col(f"{v}_off") for name, v in zip(sums, parts)})
    return out.drop(BUCKET, TIE, *[x for v in parts for x in (v, f"{v}_in", f"{v}_off")])


def number_if_absent(df: DataFrame, name: str, order_col: str, start: int = 1) -> DataFrame:
    """Add a dense start..start+N-1 number in ``order_col`` order (a unique
    column) unless ``name`` already exists; see ``number_and_trim``."""
    return number_and_trim(df, None, name, order_col, start)


def intervals(df: DataFrame, order_col: str) -> DataFrame:
    """``(lo, hi, n)``: values of ``order_col`` that step by one as they lie in a partition.

    A value minus the place of its row is the same along such a run, so a run is one group with
    partial sums before the shuffle: a table in file order gives a handful of rows per partition."""
    placed = df.select(F.col(order_col).cast("long").alias("v")).withColumn("at", F.monotonically_increasing_id())
    return placed.groupBy((F.col("v") - F.col("at")).alias("run")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).drop("run")


def gap_free(df: DataFrame, order_col: str) -> Column:
    """Scalar subquery: whether ``order_col`` runs through whole numbers without gaps and repeats.

    Every group has to be an interval, their lengths have to add up to the whole range, and all but
    one have to begin where another ends; then none can overlap or leave a gap.  Values that are complete but out
    of order may be taken for broken, never the other way round."""
    runs = intervals(df, order_col)
    total = runs.agg(F.coalesce(F.sum("n") == F.max("hi") - F.min("lo") + 1, F.lit(True)).alias("adds_up"),
                     F.count_if((F.col("hi") - F.col("lo") + 1 != F.col("n")) | F.col("lo").isNull()).alias("broken"), F.count(F.lit(1)).alias("runs"))
    begins = runs.join(runs.select((F.col("hi") + 1).alias("lo")), "lo", "left_anti").agg(F.count(F.lit(1)).alias("k"))
    first = begins.select("k").scalar()
    return total.select((F.col("adds_up") & (F.col("broken") == 0) & (first == F.least(F.col("runs"), F.lit(1)))).alias("ok")).scalar()


def number_and_trim(df: DataFrame, key: str | None, name: str, order_col: str = "_row",
                    start: int = 1) -> DataFrame:
    """``name`` = start.. in ``order_col`` order unless it is there, and no rows after the last with a valid key.

    Where the order column is gap-free and free of repeats (``_row`` straight
    from the reader) the number is ``order - min + start``; otherwise
    ``dense_number`` over equal-width ranges.  Which of the two holds, the smallest position and the last
    valid row are scalar subqueries of one plan: no job runs while the frame is built, and rows of the branch that
    does not apply are dropped before its shuffle.  The number is given before the trim."""
    out = df
    if name not in df.columns:
        unbroken = gap_free(df, order_col)
        lo = df.agg(F.min(order_col).alias("lo")).scalar()
        plain = df.where(unbroken).withColumn(name, (F.col(order_col) - lo + F.lit(start)).cast("long"))
        out = plain.unionByName(dense_number(df.where(~unbroken), order_col, name=name, start=start, ranges="uniform"))
    if key:
        last = last_valid_row(df, key, order_col)
        out = out.filter(last.isNull() | (F.col(order_col) <= last))
    return out


def first_per_key(df: DataFrame, key: str, order_col: str = "_row") -> DataFrame:
    """First row (smallest ``order_col``) per non-null key.

    Written as a ``min(struct(order, *cols))`` aggregate: partial aggregation
    happens before the shuffle, so a hot key costs one row per map task."""
    others = [c for c in df.columns if c not in (key, order_col)]
    packed = F.min(F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in others])).alias("_first")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(packed)
        .select(key, F.col("_first._o").alias(order_col), *[F.col(f"_first.{c}").alias(c) for c in others])
    )


def last_valid_row(df: DataFrame, key: str, order_col: str = "_row") -> Column:
    """Scalar subquery: position of the last row with a non-blank key (null
    when none).  A global aggregate (partial per task, one final row) that the
    planner runs once and uses as a literal: no join."""
    return df.agg(F.max(F.when(not_blank(F.col(key)), F.col(order_col))).alias("_last")).scalar()


def trim_tail(df: DataFrame, key: str, order_col: str = "_row") -> DataFrame:
    """Keep rows up to the last row with a non-blank key; interior blank-key
    rows stay; when no key is valid everything is kept."""
    last = last_valid_row(df, key, order_col)
    return df.filter(last.isNull() | (F.col(order_col) <= last))


def tail_rows(df: DataFrame, key: str, order_col: str = "_row") -> DataFrame:
    """Rows after the last row with a non-blank key."""
    last = last_valid_row(df, key, order_col)
    return df.filter(last.isNotNull() & (F.col(order_col) > last))


def assign_batches(df: DataFrame, order_col: str | Sequence[str], batch_size: int | None = None, name: str = "batch",
                   seq_name: str = "seq", materialize_input: bool = False, ranges: str = "quantile",
                   max_bytes: int | None = None, size_col: str = "size", unique: bool = True) -> DataFrame:
    """Batches in ``order_col`` order, numbered from 1 without gaps, with ``seq`` 1..N.

    ``batch_size``: chunks of that many rows, ``batch`` = floor((seq-1)/size)+1.
    ``max_bytes``: a batch takes the rows whose first byte, counted over all rows before it, falls into the
    same ``max_bytes``; it holds less than ``max_bytes`` before its last row, and a
    row of its own size beyond that is no error.  Rows and bytes before a row come from
    one running sum over range totals.  Null sizes count as 0, negative ones are refused."""
    if (batch_size is None) == (max_bytes is None):
        raise ValueError("give batch_size or max_bytes")
    if (batch_size or max_bytes) < 1:
        raise ValueError("batch_size and max_bytes must be >= 1")
    if batch_size is not None:
        numbered = dense_number(df, order_col, name=seq_name, start=1, materialize_input=materialize_input, ranges=ranges, unique=unique)
        return numbered.withColumn(name, (F.floor((F.col(seq_name) - 1) / F.lit(batch_size)) + 1).cast("long"))
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    size = F.when(size < 0, F.raise_error(F.lit("a size is negative"))).otherwise(size).cast("long")
    placed = running_sums(df, order_col, {seq_name: F.lit(1).cast("long"), "_nb_bytes": size}, materialize_input=materialize_input, ranges=ranges, unique=unique)
    placed = placed.withColumns({seq_name: F.col(seq_name) + 1, "_nb_slot": F.expr(f"_nb_bytes div {int(max_bytes)}L")})
    if (df.agg(F.max(size)).first()[0] or 0) <= max_bytes:  # no slot can stay empty
        return placed.withColumn(name, F.col("_nb_slot") + 1).drop("_nb_bytes", "_nb_slot")
    # Rows beyond max_bytes leave slots empty: number the slots in use, one row each.
    placed = materialize(placed)
    used = dense_number(placed.groupBy("_nb_slot").agg(F.min(seq_name).alias("_nb_first")).select("_nb_slot"), "_nb_slot", name=name, start=1, materialize_input=True)
    return placed.join(used, "_nb_slot").drop("_nb_bytes", "_nb_slot")


def batch_count(n_items: Column, batch_size: int) -> Column:
    """ceil(n / size) as a Column."""
    return F.ceil(as_col(n_items) / F.lit(batch_size)).cast("long")
