"""Removal of repeated substrings with suffix arrays at content-chosen places.

Every byte goes that is covered by a string of LENGTH bytes which also starts anywhere else. Of each window of that
length one place is its anchor: the place, of those whose GRAM fits into the window, with the smallest hash of its
GRAM. So equal windows have equal grams at the same distance from their starts, and only places with a gram that
repeats can be in a repeated window; one place in about seventy is an anchor.

1. Texts are written once; of equal texts one stands for all. Anchors are counted by gram; those whose gram stands alone go.
2. An anchor's context is the bytes of all windows that it can be the anchor of. A context that stands twice repeats as a
   whole. Where contexts of a gram differ and one stands alone, their bytes are fetched, once each.
3. In each bucket of such contexts the suffixes from the anchors on, and the reversed prefixes, are sorted (suffix_sort), with what
   neighbours share. A window that starts d bytes before the anchor repeats when another context shares d bytes on the left
   and LENGTH - d on the right, which is having the same rank interval in both orders.
4. The repeated intervals of a text are joined and cut out.

A bucket with more than LARGEST contexts is split in two: windows that reach far to the left of the anchor, and the
others, which reach far to the right. Either half has a longer string in common, which becomes its key, and
so on down to single windows, whose contexts repeat without a look. So no bucket is gathered that is larger, and no pair is lost.

Null texts are empty. Ids may be null or repeated; each row counts for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, scratch_path
from . import common as C
from .suffix_sort import as_words, neighbours_share, sort_groups

LENGTH, GRAM = 200, 51
REACH = LENGTH - GRAM  # most bytes of a window before its anchor
LARGEST, BATCH = 20_000, 50_000
LOW = np.uint64((1 << 28) - 1)
FACTOR = 0x2545F4914F6CDD1D
MIX = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 24  # longer texts are hashed in overlapping pieces
CONTEXT = T.StructType().add("gram", T.LongType()).add("context", T.LongType()).add("at", T.LongType())
SPANS = "row bigint, start bigint, end bigint"


def _powers(n: int, factor: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


class Powers:
    """Powers of the hash's factor and of its inverse, grown when needed."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> None:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(2 * n, FACTOR), _powers(2 * n, pow(FACTOR, -1, 1 << 64))


def _anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    Powers.to(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * Powers.up[:n], out=total[1:])
    h = (total[GRAM:] - total[:-GRAM]) * Powers.down[:n - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(29)
    places, width = len(h), REACH + 1
    key = np.full(-(-places // width) * width, ~np.uint64(0))
    key[:places] = h & ~LOW | np.arange(places, dtype=np.uint64)
    rows = key.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:places - REACH], ahead[REACH:places])
    at = (least[np.append(True, least[1:] != least[:-1])] & LOW).astype(np.int64)
    return at, h[at].view(np.int64)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's anchors, ascending, and the hashes of their grams."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(data) <= PIECE:
        return _anchors(data)
    parts = [(at, *_anchors(data[at:at + PIECE + LENGTH - 1])) for at in range(0, len(data) - LENGTH + 1, PIECE)]
    at, first = np.unique(np.concatenate([start + found for start, found, _ in parts]), return_index=True)
    return at, np.concatenate([h for _, _, h in parts])[first]


def context(data: bytes, at: int) -> bytes:
    return data[max(0, at - REACH):at + LENGTH]


@F.arrow_udf(T.ArrayType(CONTEXT))
def _contexts(texts: pa.Array) -> pa.Array:
    sizes, columns = [0], ([], [], [])
    for data in C.byte_texts(texts):
        at, gram = anchors(data)
        sizes.append(len(at))
        columns[0].append(gram)
        # the place in a cut-off context is part of its identity
        columns[1].append(np.array([xxhash.xxh3_64_intdigest(context(data, a), min(a, REACH)) for a in at.tolist()], np.uint64).view(np.int64))
        columns[2].append(at)
    values = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in columns]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.StructArray.from_arrays(values, CONTEXT.names))


@F.arrow_udf(T.StructType().add("size", T.LongType()).add("sha", T.BinaryType()))
def _identity(texts: pa.Array) -> pa.Array:
    size, sha = zip(*((len(d), hashlib.sha256(d).digest()) for d in C.byte_texts(texts))) if len(texts) else ((), ())
    return pa.StructArray.from_arrays([pa.array(size, pa.int64()), pa.array(sha, pa.binary())], ["size", "sha"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted contexts of each text: (gram, row, at, single, ahead, bytes)."""
    names = ["gram", "row", "at", "single", "ahead", "bytes"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
    for batch in batches:
        made = []
        for row, data, wanted in zip(batch.column(0).to_pylist(), C.byte_texts(batch.column(1)), batch.column(2).to_pylist()):
            made += [(w["gram"], row, w["at"], w["single"], min(w["at"], REACH), context(data, w["at"])) for w in wanted]
            if len(made) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)


@F.arrow_udf(T.LongType())
def _core(key: pa.Array, low: pa.Array, high: pa.Array, ahead: pa.Array, data: pa.Array) -> pa.Array:
    """Key of the bucket of windows with `low` to `high` bytes before the anchor; null where the context has no such window."""
    made = []
    for k, x0, x1, a, d in zip(key.to_pylist(), low.to_pylist(), high.to_pylist(), ahead.to_pylist(), C.byte_texts(data)):
        core = d[a - x0:a + LENGTH - x1] if a >= x0 else b""
        made.append(int.from_bytes(xxhash.xxh3_64_digest(core, k & (1 << 32) - 1), "big", signed=True) if len(core) == LENGTH - x1 + x0 else None)
    return pa.array(made, pa.int64())


def buckets(fetched: DataFrame, largest: int) -> DataFrame:
    """Contexts with the key of their bucket and the range of bytes before the anchor that its windows have."""
    level, done, bucket = fetched.withColumns({"key": F.col("gram"), "low": F.lit(0), "high": F.lit(REACH)}), None, ["key", "low", "high"]
    while True:
        heavy = materialise(level.groupBy(*bucket).count().where((F.col("count") > largest) & (F.col("low") < F.col("high"))).select(*bucket), "heavy")
        if heavy.isEmpty():
            return level if done is None else done.unionByName(level)
        fine = level.join(heavy, bucket, "left_anti")
        done = fine if done is None else done.unionByName(fine)
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high").alias("high")))
        split = level.join(heavy, bucket, "left_semi").withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.low"), "high": F.col("half.high")}).drop("half")
        level = materialise(split.withColumn("key", _core("key", "low", "high", "ahead", "bytes")).where("key IS NOT NULL"), "halves")


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)


def _ranks(parts: list[bytes], width: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of strings by group, and the bytes each shares with the one before it."""
    words = as_words(_matrix(parts, width))
    order = sort_groups(words, group)
    return order, neighbours_share(words, order, group, np.fromiter(map(len, parts), np.int64, len(parts)))


def repeated(group: np.ndarray, ahead: np.ndarray, data: list[bytes], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Matrix of flags: does the window of each context that starts d bytes before the anchor stand in another context of its bucket."""
    n, size = len(data), np.fromiter(map(len, data), np.int64, len(data))
    right, share_right = _ranks([d[a:] for d, a in zip(data, ahead.tolist())], LENGTH, group)
    left, share_left = _ranks([d[:a][::-1] for d, a in zip(data, ahead.tolist())], REACH + 3, group)
    flags = np.zeros((n, REACH + 1), bool)
    of_right, of_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(REACH + 1):
        has = np.flatnonzero((ahead >= d) & (size - ahead >= LENGTH - d) & (low <= d) & (d <= high))
        if len(has) > 1:
            of_right[right], of_left[left] = np.cumsum(share_right < LENGTH - d), np.cumsum(share_left < d)
            interval = of_right[has] * (n + 1) + of_left[has]
            order = np.argsort(interval)
            same = interval[order][1:] == interval[order][:-1]
            flags[has[order[1:][same]], d] = True
            flags[has[order[:-1][same]], d] = True
    return flags


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans of single contexts. Rows (key, low, high, row, at, single, ahead, bytes) come sorted by bucket."""
    def spans(rows: pa.Table) -> pa.RecordBatch:
        key, low, high, row, at, single, ahead = (rows[i].to_numpy() for i in range(7))
        fresh = np.append(True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
        flags = repeated(np.cumsum(fresh), ahead, rows[7].to_pylist(), low, high)
        flags &= single[:, None]
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (who, first), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        return pa.RecordBatch.from_arrays([pa.array(row[who]), pa.array(at[who] - end + 1), pa.array(at[who] - first + LENGTH)], ["row", "start", "end"])

    def whole(rows: pa.Table) -> pa.RecordBatch:
        """A bucket of one window: all its members repeat."""
        rows = rows.filter(rows["single"])
        at = rows["at"].to_numpy() - rows["low"].to_numpy()
        return pa.RecordBatch.from_arrays([rows["row"].combine_chunks(), pa.array(at), pa.array(at + LENGTH)], ["row", "start", "end"])

    held: pa.Table | None = None
    many = 0  # rows seen of a bucket of one window
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows < BATCH:
            continue
        key, low, high = (held[i].to_numpy() for i in range(3))
        last = int(np.flatnonzero((key != key[-1]) | (low != low[-1]) | (high != high[-1])).max(initial=-1)) + 1
        if last:
            done = held.slice(0, last)
            if many:  # the first rows belong to the bucket whose others were taken already
                rest = int(np.flatnonzero((key != key[0]) | (low != low[0]) | (high != high[0]))[0])
                yield whole(done.slice(0, rest))
                done = done.slice(rest)
            if done.num_rows:
                yield spans(done)
            held, many = held.slice(last), 0
        if held.num_rows > 1 and low[-1] == high[-1] and held.num_rows >= BATCH:
            yield whole(held.slice(0, held.num_rows - 1))
            held, many = held.slice(held.num_rows - 1), many + held.num_rows
    if held is not None and held.num_rows:
        key, low, high = (held[i].to_numpy() for i in range(3))
        one = (key == key[0]) & (low == low[0]) & (high == high[0]) & (low == high)
        if many and one[0]:
            yield whole(held.filter(pa.array(one)))
            held = held.filter(pa.array(~one))
        if held.num_rows:
            yield spans(held)


@F.arrow_udf(T.StructType().add("n_removed", T.LongType()).add("n_spans", T.LongType()).add("sha", T.BinaryType()).add("kept", T.BinaryType()))
def _cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    rows = []
    for data, begin, end in zip(C.byte_texts(texts), starts.to_pylist(), ends.to_pylist()):
        kept, at, removed, spans = [], 0, 0, 0
        joined: list[list[int]] = []
        for a, b in sorted(zip(begin or [], end or [])):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        for a, b in joined:
            kept.append(data[at:a])
            at, removed, spans = b, removed + b - a, spans + 1
        kept.append(data[at:])
        rest = b"".join(kept)
        rows.append((removed, spans, hashlib.sha256(rest).digest(), rest))
    columns = zip(*rows) if rows else ((), (), (), ())
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["n_removed", "n_spans", "sha", "kept"])


def repeats(scan: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(row, start, end): spans of repeated strings in the texts that stand for all equal ones. scan: (row, doc_id, data, size, sha)."""
    stand = materialise(scan.where(F.col("size") >= LENGTH).groupBy("sha", "size").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
                        .select("row", "size", "copies"), "texts")
    texts = scan.select("row", "data").join(C.broadcast_checked(stand, 32), "row")
    each = texts.select("row", "size", F.least("copies", F.lit(2)).cast("byte").alias("copies"), F.explode(_contexts("data")).alias("c"))
    at = scratch_path(scan.sparkSession, "anchors")
    each.select(F.col("c.gram").alias("gram"), F.col("c.context").alias("context"), "row", F.col("c.at").cast("int").alias("at"),
                F.col("size").cast("int").alias("size"), "copies").write.option("compression", "zstd").parquet(at)
    found = scan.sparkSession.read.parquet(at)
    again = found.groupBy("gram").agg(F.sum("copies").alias("n")).where("n > 1").select("gram")
    found = materialise(found.join(again, "gram", "left_semi"), "repeated-grams")
    kinds = materialise(found.groupBy("gram", "context").agg(F.sum("copies").alias("n"), F.min(F.struct("row", "at")).alias("place")), "contexts")
    whole = found.join(kinds.where("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    start, end = F.greatest(F.col("at") - REACH, F.lit(0)), F.least(F.col("at") + LENGTH, F.col("size"))
    whole = whole.select("row", start.cast("bigint").alias("start"), end.cast("bigint").alias("end")).where(F.col("end") - F.col("start") >= LENGTH)
    mixed = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least")).where("d > 1 AND least = 1").select("gram")
    wanted = kinds.join(mixed, "gram", "left_semi").groupBy("place.row").agg(
        F.collect_list(F.struct("gram", F.col("place.at").cast("bigint").alias("at"), (F.col("n") == 1).alias("single"))).alias("wanted"))
    wanted = materialise(wanted, "wanted")
    near = scan.select("row", "data").join(C.broadcast_checked(wanted.select("row"), 16), "row", "left_semi").join(wanted, "row")
    fetched = near.select("row", "data", "wanted").mapInArrow(_fetch, "gram bigint, row bigint, at bigint, single boolean, ahead int, bytes binary")
    spread = buckets(materialise(fetched, "fetched"), largest).select("key", "low", "high", "row", "at", "single", "ahead", "bytes")
    sorted_rows = spread.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return materialise(whole.union(sorted_rows.mapInArrow(_search, SPANS)).groupBy("row").agg(
        F.collect_list(F.col("start")).alias("starts"), F.collect_list(F.col("end")).alias("ends")), "spans")


def _scanned(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Row number, id, bytes, length and SHA-256 of every text, written once."""
    at = scratch_path(docs.sparkSession, "texts")
    read = docs.select(F.col(doc_id).alias("doc_id"), C.text_bytes(text).alias("data")).withColumn("i", _identity("data"))
    read = read.select(F.monotonically_increasing_id().alias("row"), "doc_id", "data", "i.size", "i.sha")
    read.write.option("compression", "zstd").parquet(at)
    return docs.sparkSession.read.schema(read.schema).parquet(at)


def _cut_texts(scan: DataFrame, spans: DataFrame) -> DataFrame:
    """(sha, size, cut) of each distinct text with repeats."""
    near = scan.join(C.broadcast_checked(spans.select("row"), 16), "row", "left_semi").join(spans, "row")
    return near.select("sha", "size", _cut("data", "starts", "ends").alias("cut"))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", largest: int = LARGEST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    scan = _scanned(docs, text, doc_id)
    cut = _cut_texts(scan, repeats(scan, largest)).select("sha", "size", "cut.n_removed", "cut.n_spans", F.col("cut.sha").alias("kept"))
    every = scan.select("doc_id", "size", "sha").join(cut, ["sha", "size"], "left")
    zero = F.lit(0).cast("bigint")
    return every.select("doc_id", F.col("size").alias("n_bytes"), F.coalesce("n_removed", zero).alias("n_removed"),
                        F.coalesce("n_spans", zero).alias("n_spans"), F.lower(F.hex(F.coalesce("kept", "sha"))).alias("kept_sha256"))


def kept_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", largest: int = LARGEST) -> DataFrame:
    """(doc_id, kept): the remaining bytes of every document; a cut may fall inside a character."""
    scan = _scanned(docs, text, doc_id)
    cut = _cut_texts(scan, repeats(scan, largest)).select("sha", "size", "cut.kept")
    return scan.join(cut, ["sha", "size"], "left").select("doc_id", F.coalesce("kept", "data").alias("kept"))
