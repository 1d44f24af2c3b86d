"""Training-order materialisation: token sequences in a keyed global order, as fixed-stride binary shards.

Documents become token ids with an end id; each task joins its documents to one
stream and cuts it into sequences of ``length`` ids, so only the last sequence
of a task is padded.  The sequences are stored once (compressed, with their task
and place in it); one count per task makes that a gapless number.  A keyed Feistel network over
the next even power of two, walked until it falls below the number of sequences,
permutes the numbers into global slots.  Slot ranges are the shards: each range
partition receives its rows, sorts them by slot and writes records of one fixed
size, so that any slot is found by arithmetic and reading is sequential and
resumable from any slot.

A record is the doc_id of its first id (8 bytes, the smallest value for null),
that id's place in the document and the number of ids (4 bytes each), and
``length`` ids padded with zeros, all little-endian; ids take two bytes where the
vocabulary allows.  Shards are written under a name of their own
and moved into place, so a repeated attempt replaces a shard by the same bytes.
The order depends on the key, the number of sequences and the input's task
layout, and is the same for every attempt.

Defined results: null and empty texts are the end id alone; repeated rows are in
the stream each on its own; a null doc_id comes back as null; an empty
table gives no shards and no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint, exact_ids, id_array, id_list, mix, text_slices
from manifestqc.llm.tokens import load, piece_ids, tokenizer_path
from manifestqc.sources.files import file_system

LENGTH = 2048
END_ID = 49407
SHARD_BYTES = 32 << 20
ROUNDS = 6
KEY = 0x5EED0F0DD5
NO_DOC = -(1 << 63)
SEQUENCES = "task int, place long, doc_id long, start long, ids binary"
MANIFEST = "shard long, first_slot long, n long, bytes long, crc32 long, path string"


def _round_keys(key: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 64) - 1))


def _network(x: np.ndarray, half: int, keys: np.ndarray, inverse: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for k in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (mix(left ^ k) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ k) & mask)
    return left << shift | right


def permute(numbers: np.ndarray, total: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """Keyed permutation of range(total), number by number; cycles are walked until they are back in the range."""
    out = np.asarray(numbers, np.uint64).copy()
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    keys = _round_keys(key)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = _network(out[todo], half, keys, inverse)
        todo = todo[out[todo] >= np.uint64(total)]
    return out.astype(np.int64)


def record_type(length: int, vocabulary: int) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("start", "<u4"), ("length", "<u4"), ("ids", "<u2" if vocabulary <= 1 << 16 else "<u4", (length,))])


def token_sequences(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    wide = load(path).get_vocab_size(with_added_tokens=True) > 1 << 16

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task = piece_ids(path, end_id).encode, TaskContext.get().partitionId()
        size, compress = 4 if wide else 2, zstandard.ZstdCompressor(level=3).compress
        stream = bytearray()  # what is not cut yet
        heads: list[tuple[int, int | None]] = []  # where in it each document starts; the first may start before it
        place = 0

        def cut(last: bool) -> pd.DataFrame:
            nonlocal place, heads
            rows, at, k = [], 0, 0
            while len(stream) - at >= size * length or last and at < len(stream):
                while k + 1 < len(heads) and heads[k + 1][0] <= at:
                    k += 1
                rows.append((task, place, heads[k][1], (at - heads[k][0]) // size, compress(bytes(stream[at:at + size * length]))))
                place += 1
                at += size * length
            while k + 1 < len(heads) and heads[k + 1][0] <= at:
                k += 1
            heads = [(start - at, doc) for start, doc in heads[k:]]
            del stream[:at]
            out = pd.DataFrame(rows, columns=["task", "place", "doc_id", "start", "ids"])
            return out.assign(doc_id=id_array([r[2] for r in rows]))

        for pdf, texts in text_slices(frames, max_chars=1_000_000):
            for doc_id, raw in zip(id_list(pdf["doc_id"]), encode(texts)):
                heads.append((len(stream), doc_id))
                stream += raw if wide else np.frombuffer(raw, "<u4").astype("<u2").tobytes()
            yield cut(False)
        yield cut(True)

    return exact_ids(docs.select("doc_id", "text"), "doc_id").mapInPandas(run, SEQUENCES)


def write_shards(docs: DataFrame, base: str, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, key: int = KEY, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the shards of ``docs`` under ``base``; checkpointed manifest, one row per shard."""
    spark, path = docs.sparkSession, path or tokenizer_path()
    kind = record_type(length, load(path).get_vocab_size(with_added_tokens=True))
    stored = f"{base}/sequences"
    token_sequences(docs, path, length, end_id).write.option("compression", "uncompressed").parquet(stored)
    sequences = spark.read.parquet(stored)
    counts = {r["task"]: r["n"] for r in sequences.groupBy("task").agg((F.max("place") + 1).alias("n")).collect()}  # one number per task
    total = sum(counts.values())
    if not total:
        return spark.createDataFrame([], MANIFEST)
    before = np.zeros(max(counts) + 1, np.int64)
    before[sorted(counts)] = np.cumsum([0] + [counts[t] for t in sorted(counts)])[:-1]
    held = spark.sparkContext.broadcast(before)
    per_shard = max(1, shard_bytes // kind.itemsize)
    shards = -(-total // per_shard)

    @F.pandas_udf("long")
    def slot_of(task: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series(permute(held.value[task.to_numpy()] + place.to_numpy(), total, key))

    slotted = sequences.withColumn("slot", slot_of("task", "place")).select("slot", F.coalesce("doc_id", F.lit(NO_DOC)).alias("doc_id"), "start", "ids")
    ranges = slotted.repartitionById(shards, F.expr(f"cast(slot div {per_shard} as int)")).sortWithinPartitions("slot")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = file_system(base)
        where.create_dir(f"{root}/shards", recursive=True)
        sink = first = None
        n = crc = 0
        size, expand = kind["ids"].base.itemsize, zstandard.ZstdDecompressor().decompress
        temporary = f"{root}/shards/.{uuid.uuid4().hex}"
        for pdf in frames:
            if not len(pdf):
                continue
            slots = pdf["slot"].to_numpy()
            if sink is None:
                first = int(slots[0])
                sink = where.open_output_stream(temporary, compression=None)
            if slots[0] != first + n or (np.diff(slots) != 1).any():
                raise ValueError(f"slots of the shard from {first} have a gap")
            block = np.zeros(len(pdf), kind)
            block["doc_id"] = pdf["doc_id"].to_numpy(np.int64)
            block["start"] = pdf["start"].to_numpy()
            raw = [expand(bytes(x)) for x in pdf["ids"]]
            block["length"] = [len(x) // size for x in raw]
            block["ids"] = np.frombuffer(b"".join(x.ljust(length * size, b"\0") for x in raw), kind["ids"].base).reshape(len(pdf), length)
            data = block.tobytes()
            sink.write(data)
            n, crc = n + len(pdf), zlib.crc32(data, crc)
        if sink is not None:
            sink.close()
            shard = first // per_shard
            final = f"{root}/shards/shard-{shard:08d}.bin"
            where.move(temporary, final)
            yield pd.DataFrame([(shard, first, n, n * kind.itemsize, crc, final)], columns=[c.split()[0] for c in MANIFEST.split(", ")])

    return checkpoint(ranges.mapInPandas(write, MANIFEST))


def locate(slot: int, per_shard: int, stride: int) -> tuple[int, int]:
    """Shard and byte offset of a slot."""
    return slot // per_shard, slot % per_shard * stride


READ = "slot long, doc_id long, start long, length long, ids_crc32 long, shard long, byte_offset long"


def read_shards(manifest: DataFrame, base: str, kind: np.dtype, from_slot: int = 0, with_ids: bool = False, block: int = 1024) -> DataFrame:
    """READ of every record from a slot on, shard by shard in slot order; the bytes have to match the manifest."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, _ = file_system(base)
        for pdf in frames:
            for shard, first, n, crc, path in zip(pdf["shard"], pdf["first_slot"], pdf["n"], pdf["crc32"], pdf["path"]):
                skip = max(0, from_slot - first)
                with where.open_input_file(path) as f:
                    if f.size() != n * kind.itemsize:
                        raise ValueError(f"{path} is not {n} records long")
                    f.seek(int(skip) * kind.itemsize)
                    seen, at = 0, int(skip)
                    while data := f.read(block * kind.itemsize):
                        seen = zlib.crc32(data, seen)
                        r = np.frombuffer(data, kind)
                        ids = [x[:k] for x, k in zip(r["ids"].astype("<u4"), r["length"])]
                        doc = pd.array(r["doc_id"], "Int64")
                        doc[r["doc_id"] == NO_DOC] = pd.NA
                        out = pd.DataFrame({"slot": first + np.arange(at, at + len(r)), "doc_id": doc, "start": r["start"].astype(np.int64), "length": r["length"].astype(np.int64),
                                            "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids], "shard": shard, "byte_offset": np.arange(at, at + len(r)) * kind.itemsize})
                        at += len(r)
                        yield out.assign(ids=ids) if with_ids else out
                if not skip and seen != crc:
                    raise ValueError(f"{path} does not match its checksum")

    parts = max(1, min(manifest.count(), 100_000))
    wanted = manifest.where(F.col("first_slot") + F.col("n") > from_slot)
    return wanted.repartition(parts, "shard").mapInPandas(run, READ + (", ids array<int>" if with_ids else ""))
