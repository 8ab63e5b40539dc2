"""Near-duplicates by SimHash fingerprints and a hierarchical index in Gray order.

Fingerprint: 64 votes over the XXH64 hashes of a text's word shingles. Two texts are linked when their
fingerprints differ in at most DISTANCE bits; a component is what links reach.

Search: a link differs in at most three bits, so of the four quarters of the fingerprint one is equal. Every
distinct fingerprint goes to the four buckets of its quarters, which are the roots of the index. A bucket with
more than LARGEST fingerprints is replaced by the buckets of the quarters of its remaining bits, as often as
needed; no pair is lost by this and no bucket is capped. In a bucket the fingerprints are sorted by Gray rank,
so that neighbours share bits. Nodes over runs of FAN neighbours hold the bits that all below them share and
that the parent doesn't hold yet. A search goes down from the root, adds up the differences in these bits and
leaves a whole run as soon as they exceed DISTANCE. A bucket gives a spanning forest of its links, not its pairs.

Copies of a text have one fingerprint and are one entry of the index. A text without words has fingerprint zero
and is linked like any other. Texts with fewer words than a shingle are one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from . import common as C
from .components import components

DISTANCE, SHINGLE, SEED = 3, 3, 42
FAN, LARGEST, PAIRS = 8, 4096, 1 << 20
ONE = np.uint64(1)


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text as a signed 64-bit number."""
    words = data.lower().split()  # on bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams, repeat(SEED))), np.uint8).reshape(-1, 8)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(digests), 1 << 14):
        votes += np.unpackbits(digests[at:at + (1 << 14)], axis=1).sum(0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(digests)).view(">i8")[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array, shingle: pa.Array) -> pa.Array:
    size = shingle[0].as_py() if len(shingle) else SHINGLE
    return pa.array([fingerprint(data, size) for data in C.byte_texts(texts)], pa.int64())


def fingerprints(text: str = "text", shingle: int = SHINGLE) -> Column:
    return _fingerprints(C.text_bytes(text), F.lit(shingle))


def gray_rank(fp: Column) -> Column:
    """Position of a bit pattern in the Gray sequence, as a signed number whose order is the unsigned one."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def quarters(mask: int) -> list[int]:
    """Masks of the buckets below a bucket whose members agree in `mask`: each adds a quarter of the other bits."""
    rest = [b for b in range(64) if not mask >> b & 1]
    parts = [rest[i * len(rest) // 4:(i + 1) * len(rest) // 4] for i in range(4)]
    return [mask | sum(1 << b for b in part) for part in parts if part]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def buckets(distinct: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(mask, fp): every fingerprint in all its buckets, none with more than `largest` members while bits are left."""
    level, masks, done = distinct.select("fp", F.lit(0).cast("bigint").alias("mask")), [0], None
    bucket = ["mask", "value"]
    while True:
        below = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(q)) for q in quarters(m)]))])
        masks = sorted({q for m in masks for q in quarters(m)})
        level = level.select("fp", F.explode(below[F.col("mask")]).alias("mask")).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        heavy = materialise(level.groupBy(*bucket).count().where(F.col("count") > largest).select(*bucket), "heavy")
        split = [m for m in masks if bin(m).count("1") < 61]
        if not split or heavy.isEmpty():
            return level.select("mask", "fp") if done is None else done.union(level.select("mask", "fp"))
        fine = level.join(heavy, bucket, "left_anti").select("mask", "fp")
        done = fine if done is None else done.union(fine)
        level = level.join(heavy, bucket, "left_semi").select("fp", "mask")


def _runs(start: np.ndarray, fan: int) -> list[np.ndarray]:
    """First rows of the nodes of each level, from single rows up to one node per bucket. start: first row of each row's bucket."""
    at = np.arange(len(start)) - start
    levels, width = [np.arange(len(start))], 1
    while width <= at.max(initial=0):
        width *= fan
        levels.append(np.flatnonzero(at % width == 0))
    return levels


def near_pairs(fps: np.ndarray, start: np.ndarray, distance: int = DISTANCE, fan: int = FAN, pairs: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows i < j of one bucket at most `distance` bits apart, in blocks. fps: uint64 in Gray order by bucket."""
    levels = _runs(start, fan)
    n = len(fps)
    shared, value, lower = [], [], []
    for first in levels:
        every, some = np.bitwise_and.reduceat(fps, first), np.bitwise_or.reduceat(fps, first)
        shared.append(~(every ^ some))
        value.append(every)
        lower.append(first)
    parents = [np.searchsorted(levels[k + 1], levels[k], "right") - 1 for k in range(len(levels) - 1)]
    own = [shared[k] & ~shared[k + 1][parents[k]] for k in range(len(parents))] + [shared[-1]]
    top = np.searchsorted(levels[-1], start)
    step = max(1, pairs // max(1, int(np.bincount(start, minlength=1).max())))
    for begin in range(0, n, step):
        query = np.arange(begin, min(n, begin + step))
        node, gap = top[query], np.bitwise_count((fps[query] ^ value[-1][top[query]]) & own[-1][top[query]])
        for k in range(len(levels) - 1, -1, -1):
            end = np.append(lower[k][1:], n)
            near = (gap <= distance) & (end[node] > query + 1)
            query, node, gap = query[near], node[near], gap[near]
            if k == 0:
                break
            child = np.searchsorted(levels[k - 1], lower[k])
            many = np.append(child[1:], len(levels[k - 1])) - child
            count = many[node]
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            query, gap, node = np.repeat(query, count), np.repeat(gap, count), np.repeat(child[node], count) + offset
            gap = gap + np.bitwise_count((fps[query] ^ value[k - 1][node]) & own[k - 1][node])
        yield query, node


def forest(fps: np.ndarray, start: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For each row the first row of its component among the links of its bucket."""
    label = np.arange(len(fps))
    for i, j in near_pairs(fps, start, distance):
        while len(i):
            a, b = label[i], label[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    return label


def _search(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, fp) come sorted by bucket and Gray rank; a bucket cut by a batch's end waits for the next batch."""
    held_mask, held = np.empty(0, np.int64), np.empty(0, np.int64)

    def linked(mask, fp):
        key = fp & mask
        fresh = np.append(True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))
        first = np.flatnonzero(fresh)
        label = forest(fp.view(np.uint64), first[np.cumsum(fresh) - 1], distance)
        child = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[label[child]])], ["a", "b"])

    for batch in batches:
        held_mask = np.concatenate([held_mask, batch.column(0).to_numpy(zero_copy_only=False)])
        held = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(held):
            continue
        key = held & held_mask
        last = int(np.flatnonzero((held_mask != held_mask[-1]) | (key != key[-1])).max(initial=-1)) + 1
        if last:
            yield linked(held_mask[:last], held[:last])
            held_mask, held = held_mask[last:], held[last:]
    if len(held):
        yield linked(held_mask, held)


def links(distinct: DataFrame, distance: int = DISTANCE, largest: int = LARGEST) -> DataFrame:
    """(a, b): links between distinct fingerprints, a spanning forest of each bucket's links."""
    if distance > 3:
        raise ValueError("four quarters find at most three differing bits")
    spread = buckets(distinct, largest)
    rows = spread.repartition("mask", F.col("fp").bitwiseAND(F.col("mask")))
    rows = rows.sortWithinPartitions("mask", F.col("fp").bitwiseAND(F.col("mask")), gray_rank(F.col("fp")))
    return rows.mapInArrow(lambda batches: _search(batches, distance), "a bigint, b bigint")


def classes(rows: DataFrame, distance: int = DISTANCE, largest: int = LARGEST) -> DataFrame:
    """(fp, first): the first row, as (none, id, row), of the component of every distinct fingerprint of (doc_id, fp, row)."""
    distinct = materialise(rows.groupBy("fp").agg(F.min(C.first_row()).alias("first")), "fingerprints")
    roots = components(links(distinct.select("fp"), distance, largest), "a", "b").select(F.col("node").alias("fp"), "root")
    joined = roots.join(distinct, "fp")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    found = roots.join(least, "root").select("fp", "least")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("least", "first").alias("first"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest id of its component, null if all are)."""
    rows = C.numbered(docs, F.col(doc_id).alias("doc_id"), fingerprints(text).alias("fp"), name="simhash")
    return rows.join(classes(rows, distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """One document of each component, the first by id, with all its columns."""
    whole, row = C.numbered_whole(docs, "documents")
    rows = materialise(whole.select(F.col(doc_id).alias("doc_id"), fingerprints(text).alias("fp"), F.col(row).alias("row")), "simhash")
    return C.keep_rows(whole, row, classes(rows, distance).select("first.row").distinct())
