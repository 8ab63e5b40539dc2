"""Token ids of a corpus in training order, as shards of fixed-stride binary records.

Every scan task turns its documents into one stream of token ids, each document closed by the end token, and cuts it
into sequences; only the last sequence of a task may be short. The sequences get dense numbers (the counts of the tasks
before, plus the place in the task), and a keyed Feistel permutation with cycle-walking maps the numbers onto slots:
a bijection of [0, n) that needs no table. A shard holds a range of slots. One shuffle by shard and a sort by slot
write one file per shard, so that a trainer reads in order and resumes at any slot by a seek.

The sequences are written once, their ids as they are, compressed by the table's pages; through the shuffle each row's ids go
compressed by themselves.

Record: sequence number (8 bytes), token count (4), CRC-32 of the ids (4), ids (2 or 4 bytes each, little-endian, filled with
zeros up to the sequence length), two zero bytes. Spark's own text writer commits the files, with the zero bytes as
line separator, so a lost task leaves nothing behind and any file system of the cluster will do.

Null texts are documents of the end token only. No documents give no shards.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common as C
from .tokens import text_tokenizer, tokenizer_path

LENGTH, PER_SHARD, KEY, ROUNDS = 1024, 8192, 20_240_229, 4
HEADER, SEPARATOR = 16, b"\0\0"
SEQUENCES = "part int, place bigint, n_tokens int, crc bigint, ids binary"
PLACED = "slot bigint, sequence bigint, n_tokens int, crc bigint, ids binary"
GROUP_BYTES = 16 << 20  # of a row group of the sequences' table: what a writing task holds


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(31)


def permuted(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Image of each number under a keyed permutation of [0, n)."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    result = numbers.astype(np.uint64)
    todo = np.arange(len(result))
    while len(todo):
        left, right = result[todo] >> half, result[todo] & low
        for turn in range(ROUNDS):
            left, right = right, left ^ _mixed(right, key * ROUNDS + turn) & low
        result[todo] = left << half | right
        todo = todo[result[todo] >= n]  # walk on until inside
    return result.astype(np.int64)


def _cut(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    tokenizer, end, size = text_tokenizer(path), end_id.to_bytes(4, "little"), 4 * length
    part, place, rest = TaskContext.get().partitionId(), 0, b""

    def rows(stream: bytes, whole: bool) -> list[tuple]:
        nonlocal place, rest
        stop = len(stream) if whole else len(stream) // size * size
        made = []
        for at in range(0, stop, size):
            ids = np.frombuffer(stream[at:at + size], "<u4").astype(f"<u{width}")
            made.append((part, place, len(ids), zlib.crc32(ids), ids.tobytes()))
            place += 1
        rest = stream[stop:]
        return made

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], [x.split()[0] for x in SEQUENCES.split(", ")])

    for batch in batches:
        made = rows(rest + b"".join(ids + end for ids in tokenizer.ids_of(C.byte_texts(batch.column(0)))), whole=False)
        if made:
            yield batch_of(made)
    if rest:
        yield batch_of(rows(rest, whole=True))


def sequences(docs: DataFrame, text: str, path: str, length: int, end_id: int, width: int) -> tuple[DataFrame, int]:
    """(sequence, n_tokens, crc, ids) with dense numbers, and how many there are."""
    spark, at = docs.sparkSession, scratch_path(docs.sparkSession, "sequences")
    cut = docs.select(C.text_bytes(text)).mapInArrow(lambda batches: _cut(batches, path, length, end_id, width), SEQUENCES)
    cut.write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(at)
    cut = spark.read.schema(SEQUENCES).parquet(at)
    total, bases = 0, []
    for part, count in cut.groupBy("part").count().sort("part").collect():  # a row per scan task
        bases.append((part, total))
        total += count
    base = C.broadcast_checked(spark.createDataFrame(bases, "part int, base bigint"), 16)
    return cut.join(base, "part").select((F.col("base") + F.col("place")).alias("sequence"), "n_tokens", "crc", "ids"), total


def _placed(batches: Iterator[pa.RecordBatch], n: int, key: int) -> Iterator[pa.RecordBatch]:
    """Rows of sequences with their slots, ready to be shuffled."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        numbers = batch.column(0).to_numpy(zero_copy_only=False)
        ids = pa.array([squeeze.compress(x.as_buffer()) for x in batch.column(3)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(permuted(numbers, n, key)), *batch.columns[:3], ids], [x.split()[0] for x in PLACED.split(", ")])


def _records(batches: Iterator[pa.RecordBatch], stride: int) -> Iterator[pa.RecordBatch]:
    """Record bytes, without the separator that the writer adds."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
        made = [(number.to_bytes(8, "little") + size.to_bytes(4, "little") + crc.to_bytes(4, "little")
                 + expand.decompress(ids)).ljust(stride - len(SEPARATOR), b"\0")
                for number, size, crc, ids in rows]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])


def write_shards(docs: DataFrame, target: str, text: str = "text", path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD,
                 key: int = KEY, end_id: int | None = None) -> dict:
    """Write the shards and a manifest below `target`, a folder that all workers share; returns the manifest."""
    path = path or tokenizer_path()
    model = text_tokenizer(path).model
    end = model.token_to_id("<|endoftext|>") if end_id is None else end_id
    width = 2 if model.get_vocab_size() <= 1 << 16 else 4
    stride = HEADER + length * width + len(SEPARATOR)
    cut, total = sequences(docs, text, path, length, end, width)
    n_shards = -(-total // per_shard)
    manifest = {"sequences": total, "length": length, "width": width, "stride": stride, "per_shard": per_shard, "shards": n_shards, "key": key}
    if n_shards:
        placed = cut.mapInArrow(lambda batches: _placed(batches, total, key), PLACED)
        dealt = placed.repartitionById(n_shards, (F.col("slot") / per_shard).cast("int")).sortWithinPartitions("slot")
        records = dealt.select("sequence", "n_tokens", "crc", "ids").mapInArrow(lambda batches: _records(batches, stride), "value binary")
        # a string column may hold any bytes; the writer copies them
        records.select(F.col("value").cast("string")).write.option("lineSep", SEPARATOR.decode()).option("compression", "none").text(f"{target}/shards")
    docs.sparkSession.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{target}/manifest")
    return manifest


def _parsed(batches: Iterator[pa.RecordBatch], manifest: dict, first: int, end: int) -> Iterator[pa.RecordBatch]:
    stride, width = manifest["stride"], manifest["width"]
    for batch in batches:
        for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, start = memoryview(content.as_buffer()), shard * manifest["per_shard"]
            if len(data) % stride:
                raise ValueError(f"shard {shard} is cut off")
            rows = []
            for k in range(max(0, first - start), min(len(data) // stride, end - start)):
                at = k * stride
                size = int.from_bytes(data[at + 8:at + 12], "little")
                ids = bytes(data[at + HEADER:at + HEADER + size * width])
                if zlib.crc32(ids) != int.from_bytes(data[at + 12:at + 16], "little"):
                    raise ValueError(f"shard {shard} is damaged at record {k}")
                rows.append((start + k, shard, at, int.from_bytes(data[at:at + 8], "little"), size, ids))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 ["slot", "shard", "byte_offset", "sequence", "n_tokens", "ids"])


def read_shards(spark: SparkSession, target: str, first: int = 0, count: int | None = None) -> DataFrame:
    """Records of slots from `first` on: slot, shard, byte_offset, sequence, n_tokens, ids. Damage raises an error."""
    manifest = json.loads(spark.read.text(f"{target}/manifest").first()[0])
    end = manifest["sequences"] if count is None else first + count
    schema = "slot bigint, shard int, byte_offset bigint, sequence bigint, n_tokens int, ids binary"
    if not manifest["shards"]:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load(f"{target}/shards")
    shard = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int")
    wanted = files.where(shard.between(first // manifest["per_shard"], (end - 1) // manifest["per_shard"])).select(shard.alias("shard"), "content")
    return wanted.mapInArrow(lambda batches: _parsed(batches, manifest, first, end), schema)


def training_order(docs: DataFrame, target: str, **options) -> DataFrame:
    """Write the shards, then one row per written record: slot, shard, byte_offset, sequence, n_tokens, ids_crc32."""
    write_shards(docs, target, **options)
    written = read_shards(docs.sparkSession, target)
    return written.select("slot", "shard", "byte_offset", "sequence", "n_tokens", F.crc32("ids").alias("ids_crc32"))
