"""Helpers shared by the operators: table access, text batches, word hashes, small bounded aggregates."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manifestqc.session import ensure_checkpoint_dir, materialize

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0xD1342543DE82EF95)
_LETTERS = np.random.default_rng(20240611).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.cumprod(np.full(64, _STEP, np.uint64))
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first bytes of eight
#: Bytes of a word that ``word_keys`` takes in eights, for all words at once.
IN_EIGHTS = 512
#: Bytes of words that ``hashed_runs`` takes together.
STRETCH = 1 << 16
#: What an earlier operator left in this worker; workers are reused, and ``hashed_runs`` frees it.
RELEASE: list = []
#: Byte classes for ``hashed_runs``: 0 stands between words.
WHITE_SPACE = np.ones(256, np.uint8)
WHITE_SPACE[[9, 10, 11, 12, 13, 32]] = 0


BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"


def lighter_batches(spark: SparkSession) -> None:
    """Arrow batches of fewer rows than Spark's default, as rows hold whole texts; a setting of the user's own stays."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lighter_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder the session names (see session.py)."""
    ensure_checkpoint_dir(df.sparkSession)
    lighter_batches(df.sparkSession)
    return materialize(df)


def text_slices(frames: Iterator[pd.DataFrame], column: str = "text", max_chars: int = 300_000) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Slices of Arrow batches holding about ``max_chars`` characters each (one row at least), null texts as empty."""
    for pdf in frames:
        texts = [t if isinstance(t, str) else "" for t in pdf[column].tolist()]
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= max_chars:
                yield pdf.iloc[start:i + 1], texts[start:i + 1]
                start, size = i + 1, 0
        if start < len(texts):
            yield pdf.iloc[start:], texts[start:]
        del pdf, texts
        trim()  # reused workers would keep the most that any batch took


def exact_ids(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with nullable id columns as text, for pandas: beside a null it would take longs as doubles, which change beyond 2^53."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def id_list(column: pd.Series) -> list[int | None]:
    """Ids of a column that ``exact_ids`` made."""
    return [int(x) if isinstance(x, str) else None for x in column.tolist()]


def id_array(ids: list) -> pd.arrays.IntegerArray:
    """Ids, some of them None, as nullable longs without a step over doubles."""
    missing = np.array([i is None for i in ids], bool)
    return pd.arrays.IntegerArray(np.array([0 if i is None else i for i in ids], np.int64), missing)


def give_back() -> None:
    """Returns freed memory to the system: workers are reused, and what an earlier operator freed stays in their heaps."""
    gc.collect()
    trim()


def trim() -> None:
    """Returns memory that is free already."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released() -> None:
    """Frees what an earlier operator left in this worker."""
    if RELEASE:
        RELEASE.pop()()
        give_back()


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer on uint64 arrays."""
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=1)
def _running_powers() -> tuple[np.ndarray, np.ndarray]:
    """_STEP to the power of place + 1, and its inverse (modulo 2^64) to the power of the place."""
    inverse = np.full(2 * STRETCH, pow(int(_STEP), -1, 1 << 64), np.uint64)
    inverse[0] = 1
    return np.cumprod(np.full(2 * STRETCH, _STEP, np.uint64)), np.cumprod(inverse)


def _places(b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each byte after its word's first one, and powers of _STEP for all of these."""
    global _powers
    off = starts[0]
    place = np.arange(len(b) - off, dtype=np.int32) - np.repeat((starts - off).astype(np.int32), np.diff(starts, append=len(b)))
    longest = int(place.max()) + 1
    if longest > len(_powers):
        _powers = np.cumprod(np.full(2 * longest, _STEP, np.uint64))
    return place, _powers


def _word_sums(b: np.ndarray, starts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The polynomial of each word, in stretches of words: powers by the place in the stretch, taken back to the place in the word."""
    up, down = _running_powers()
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.searchsorted(starts, np.arange(starts[0], len(b), STRETCH)))
    for i, z in zip(cuts, [*cuts[1:], len(starts)]):
        if i == z:
            continue
        part = b[starts[i]:starts[z] if z < len(starts) else len(b)]
        at = starts[i:z] - starts[i]
        if len(part) <= len(up):
            out[i:z] = np.add.reduceat(letters[part] * up[:len(part)], at) * down[at]
        else:  # a word longer than a stretch
            place, powers = _places(part, at)
            out[i:z] = np.add.reduceat(letters[part] * powers[place], at)
    return out


def hashed_runs(raw: bytes, classes: np.ndarray = WHITE_SPACE, lead: int = 0) -> tuple[np.ndarray, ...]:
    """64-bit hashes and first bytes of the words of a text, without a Python object per word.

    A word is a longest run of bytes of one class other than 0.  Its hash is a
    polynomial in its bytes, mixed.  With ``lead`` the hashes of the first
    ``lead`` bytes follow, 0 for words that are no longer than that.
    """
    released()
    b = np.frombuffer(raw, np.uint8)
    kind = classes[b]
    first = kind != 0
    first[1:] &= kind[1:] != kind[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return (none, starts, none) if lead else (none, starts)
    letters = np.where(classes != 0, _LETTERS, np.uint64(0))
    if not lead:
        return mix(_word_sums(b, starts, letters)), starts
    off = starts[0]
    place, powers = _places(b, starts)
    value = letters[b[off:]] * powers[place]
    hashes = mix(np.add.reduceat(value, starts - off))
    size = np.add.reduceat((kind[off:] != 0).astype(np.int64), starts - off)
    head = mix(np.add.reduceat(np.where(place < lead, value, np.uint64(0)), starts - off) + _STEP)
    return hashes, starts, np.where(size > lead, head, np.uint64(0))


def word_keys(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys and first bytes of the words between ASCII white space, from eight bytes of a word at a time.

    Cheaper than ``hashed_runs``, and other numbers.
    """
    released()
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = WHITE_SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))  # the eight bytes from each place on
    out = (eight[starts] & _FIRST[np.minimum(size, 8)]) * _STEP + size.astype(np.uint64)

    def carried(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(32))) * _MUL

    more, at = np.flatnonzero(size > 8), 8
    while len(more) and at < IN_EIGHTS:
        out[more] = carried(out[more]) + (eight[starts[more] + at] & _FIRST[np.minimum(size[more] - at, 8)])
        at += 8
        more = more[size[more] > at]
    for i in more.tolist():  # a very long word
        rest = np.frombuffer(raw, np.uint8, int(size[i]) - at, int(starts[i]) + at)
        out[i:i + 1] = carried(out[i:i + 1]) + (_LETTERS[rest] * np.cumprod(np.full(len(rest), _STEP, np.uint64))).sum(dtype=np.uint64)
    return mix(out), starts


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; the whole run when there are fewer; empty for no words."""
    if len(h) == 0:
        return h
    w = min(width, len(h))
    out = h[: len(h) - w + 1].copy()
    for k in range(1, w):
        out = out * _MUL + h[k: len(h) - w + 1 + k]
    return mix(out + np.uint64(w))


def bitmap(df: DataFrame, bit, log2_bits: int = 23) -> np.ndarray:
    """A filter of fixed size (1 MiB by default) of the bit numbers in a column, for a later scan.

    It lets through every value that has a row and some others, which an exact
    join has to remove; what reaches the driver is bounded by the filter's size.
    """
    words = (df.select(bit.alias("h")).groupBy(F.shiftright("h", 5).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 31 as int))")).alias("bits")).toPandas())
    out = np.zeros(1 << (log2_bits - 5), np.uint32)
    out[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def bit_number(hash64, log2_bits: int = 23):
    """The bit that a 64-bit hash column sets."""
    return F.pmod(hash64, F.lit(1 << log2_bits)).cast("int")


def in_bitmap(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    n = numbers.astype(np.int64)
    return (bits[n >> 5] >> (n & 31).astype(np.uint32)) & 1 == 1


def possible(wanted: DataFrame, bit):
    """Column function: whether a row with this bit number may be among ``wanted`` (whose bit numbers are ``bit``)."""
    held = wanted.sparkSession.sparkContext.broadcast(bitmap(wanted, bit))

    @F.pandas_udf("boolean")
    def run(numbers: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(held.value, numbers.to_numpy()))

    return run


def split_by_ids(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows whose doc_id is surely not in ``ids`` (doc_id, checkpointed), and the rest.

    Only the rest has to meet ``ids`` in a shuffle, so texts of documents that
    a decision does not touch stay where they are.
    """
    bit = bit_number(F.xxhash64("doc_id"))
    mark = "_possible"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.col("doc_id").isNotNull() & possible(ids, bit)(F.coalesce(bit, F.lit(0))))
    return marked.where(~F.col(mark)).drop(mark), marked.where(F.col(mark)).drop(mark)


def summed_bins(found: DataFrame, column: str, size: int, stretch: int = 1024) -> np.ndarray:
    """Sum over rows of an array<long> column of fixed size; ``size`` numbers reach the driver.

    Arrays travel in stretches, not a row a number: there is an array per task of the scan before.
    """
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in frames:
            for part, n in zip(pdf["part"].tolist(), pdf["n"]):
                sums[part] = sums[part] + n if part in sums else np.array(n, np.int64)
        if sums:
            yield pd.DataFrame({"part": list(sums), "n": list(sums.values())})

    out = np.zeros(size, np.int64)
    parts = F.transform(F.sequence(F.lit(0), F.lit((size - 1) // stretch)), lambda k: F.slice(column, k * stretch + 1, stretch))
    rows = (found.where(F.col(column).isNotNull()).select(F.posexplode(parts).alias("part", "n")).repartition(8, "part")
            .mapInPandas(add, "part int, n array<long>").toPandas())
    for part, n in zip(rows["part"].tolist(), rows["n"]):
        out[part * stretch:part * stretch + len(n)] = n
    return out
