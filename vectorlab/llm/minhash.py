"""Near-duplicates by word-shingle sets: a multi-index Hamming join over MinHash signatures, confirmed on full sets.

A document's set holds the XXH64 hashes of its distinct word shingles. Its signature has CHUNKS chunks of WIDTH
positions; a position keeps BITS bits of the least value of one hash function over the set. Two signatures differ in
as many positions as their values differ. If that is at most THRESHOLD = CHUNKS * (ERRORS + 1) - 1, some chunk has at
most ERRORS differing positions (pigeonhole), so the two agree in one way of leaving out ERRORS positions of that chunk.
All such ways are enumerated as keys: every pair within the threshold shares a key, and no key is capped. A pair with
similarity s agrees in a position with probability s or a little more, so a link at 0.8 shares no key with a
probability below 6e-10 (all 16 chunks having two errors or more); pairs beyond the threshold that share a key count too.

Pairs are not listed per key. Each key names as its hub the member with the most company over all keys, so that the
keys of one group of near copies mostly share a hub, and members meet once per hub instead of once per key:
* every member is compared with its hub; members linked to it form one component;
* members outside the hub's component are put in blocks, and every other member of another component is compared with
  the blocks. A block is an inverted index from hashes to its members, which gives exact intersections with all of them
  at once. Blocks and the members that meet them in a task are bounded, so a hub may have any number of members.
A task returns a spanning forest of the links it finds. Components come from alternating stars.

Documents with equal sets are one entry. A set of fewer shingles than can be linked to a different set has no keys.
Null text counts as empty; a text without words is linked with nothing. Ids may be null or repeated: each row counts for
itself, null ids come last in `component_id`, which is null if all ids of a component are; a row is kept where its id
is that of its component. Long texts are hashed whole. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from . import common as C
from .components import components

PERCENT, SHINGLE = 80, 2
CHUNKS, WIDTH, ERRORS, BITS = 16, 5, 1, 16
THRESHOLD = CHUNKS * (ERRORS + 1) - 1
POSITIONS = CHUNKS * WIDTH
SLICE = 4096  # shingles per step of a signature
#: Members of a block, hashes of a block, members that meet one block in one task.
BLOCK, BLOCK_HASHES, MEET = 512, 1 << 22, 8192
DESCRIBED = T.StructType().add("n", T.IntegerType()).add("digest", T.BinaryType()).add("signature", T.BinaryType()).add("hashes", T.BinaryType())
RNG = np.random.default_rng(11)
FACTORS = RNG.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = RNG.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)
TAG = 0x9E3779B97F4A7C15


def shingles(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a UTF-8 text; a shorter text is one shingle, none without words."""
    words = data.lower().split()  # on bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return np.empty(0, np.uint64)
    grams = set(map(b" ".join, zip(*(words[i:] for i in range(size))))) if len(words) > size else {b" ".join(words)}
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, len(grams)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Low BITS bits of the least value of every hash function."""
    least = np.full(POSITIONS, ~np.uint64(0))
    for at in range(0, len(hashes), SLICE):
        np.minimum(least, (hashes[at:at + SLICE, None] * FACTORS + OFFSETS).min(axis=0), out=least)
    return (least & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def least_linked(percent: int = PERCENT) -> int:
    """Size of the smallest set that can be linked to a different one."""
    n = 1
    while 100 * n < percent * (n + 1) and percent < 100:
        n += 1
    return n


def keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each row: every chunk without every choice of ERRORS of its positions."""
    out = []
    for chunk in range(CHUNKS):
        for left in combinations(range(WIDTH), WIDTH - ERRORS):
            key = np.full(len(signatures), TAG * (len(out) + 1) % (1 << 64), np.uint64)
            for p in left:
                key = (key ^ signatures[:, chunk * WIDTH + p].astype(np.uint64)) * FACTORS[p]
                key ^= key >> np.uint64(32)
            out.append(key)
    return np.stack(out, axis=1).view(np.int64)


@F.arrow_udf(DESCRIBED)
def _described(texts: pa.Array, size: pa.Array) -> pa.Array:
    width = size[0].as_py() if len(size) else SHINGLE
    sets = [shingles(data, width) for data in C.byte_texts(texts)]
    raw = [s.tobytes() for s in sets]
    return pa.StructArray.from_arrays(
        [pa.array([len(s) for s in sets], pa.int32()), pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()),
         pa.array([signature(s).tobytes() for s in sets], pa.binary()), pa.array(raw, pa.binary())], DESCRIBED.fieldNames())


def described(text: str, size: int = SHINGLE) -> Column:
    return _described(C.text_bytes(text), F.lit(size))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, POSITIONS)
            found = keys(sigs)
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(np.repeat(rows, found.shape[1]))], ["key", "node"])


def hubs(signatures: DataFrame) -> DataFrame:
    """(hub, node) for `signatures(node, signature)`: nodes that share a key share a hub. Hubs are members of themselves."""
    keyed = signatures.select("node", "signature").mapInArrow(_keyed, "key bigint, node bigint")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialise(keyed.join(sizes, "key"), "keys")
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    most = shared.join(company, "node").groupBy("key").agg(F.max(F.struct("company", (-F.col("node")).alias("node"))).alias("most"))
    found = shared.join(most, "key").select((-F.col("most.node")).alias("hub"), "node").distinct()
    return materialise(found, "hubs")


class Block:
    """An inverted index over a few sets."""

    def __init__(self, nodes: list[int], roots: list[int], sets: list[np.ndarray]):
        self.nodes, self.roots = np.array(nodes, np.int64), np.array(roots, np.int64)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owner = flat[order], owner[order]
        self.label = np.arange(len(sets))

    def links(self, node: int, root: int, hashes: np.ndarray, percent: int) -> list[int]:
        """Members linked to a set of another component, one for each part that earlier links don't join already."""
        first, end = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        count = end - first
        at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
        common = np.bincount(self.owner[at], minlength=len(self.nodes))
        near = np.flatnonzero((100 * common >= percent * (self.sizes + len(hashes) - common)) & (self.roots != root) & (self.nodes != node))
        if not len(near):
            return []
        labels, one = np.unique(self.label[near], return_index=True)
        self.label[np.isin(self.label, labels)] = labels[0]
        return self.nodes[near[one]].tolist()


def _met(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (hub, block, part, other, node, root, hashes) come sorted, a block's members (other = 0) before those that meet it."""
    group, members, block = None, [], None
    for batch in batches:
        a, b = [], []
        hub, number, part, other, node, root = (batch.column(i).to_pylist() for i in range(6))
        for i, raw in enumerate(batch.column(6)):
            hashes = np.frombuffer(raw.as_buffer(), np.uint64)
            if (now := (hub[i], number[i], part[i])) != group:
                group, members, block = now, [], None
            if not other[i]:
                members.append((node[i], root[i], hashes.copy()))
                continue
            if block is None and members:
                block = Block(*zip(*members))
            for near in block.links(node[i], root[i], hashes, percent) if block else ():
                a.append(near)
                b.append(node[i])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _links(blocks: DataFrame, meeting: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between `blocks(hub, block, parts, node, root)` and `meeting(hub, block, part, node, root)`, as a forest per task."""
    spread = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("hub", "block", "part", F.lit(0).alias("other"), "node", "root")
    rows = spread.union(meeting.select("hub", "block", "part", F.lit(1), "node", "root")).join(sets, "node")
    group = ["hub", "block", "part"]
    rows = rows.select(*group, "other", "node", "root", "hashes").repartition(*group).sortWithinPartitions(*group, "other")
    return rows.mapInArrow(lambda batches: _met(batches, percent), "a bigint, b bigint")


def _parts(count: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / size)).cast("int")


def _dealt(node: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(node), F.col(parts)).cast("int")


def links(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that join what all links within the hubs of `members(hub, node)` join; `sets(node, n, hashes)`."""
    sized = members.join(sets.select("node", "n"), "node")
    parts = members.groupBy("hub").agg(_parts(F.count(F.lit(1)), MEET).alias("parts"))
    stars = parts.select("hub", F.lit(0).alias("block"), "parts", F.col("hub").alias("node"), F.col("hub").alias("root"))
    rest = members.where("node != hub").join(parts, "hub")
    rest = rest.select("hub", F.lit(0).alias("block"), _dealt("node", "parts").alias("part"), "node", F.col("node").alias("root"))
    near = materialise(_links(stars, rest, sets, percent), "star-links")

    roots = components(near, "a", "b")
    rooted = sized.join(roots, "node", "left").select("hub", "node", "n", F.coalesce("root", "node").alias("root"))
    own = rooted.where("node = hub").select("hub", F.col("root").alias("own"))
    rooted = materialise(rooted.where("node != hub").join(own, "hub").withColumn("outside", F.col("root") != F.col("own")), "rooted")
    outside = F.col("outside").cast("int")
    blocks = rooted.groupBy("hub").agg(F.sum(outside).alias("left"), F.count(F.lit(1)).alias("all"), F.sum(outside * F.col("n")).alias("hashes"),
                                       _parts(F.count(F.lit(1)), MEET).alias("parts"))
    blocks = blocks.where("left > 0 and all > 1").select("hub", "parts", F.greatest(_parts(F.col("left"), BLOCK), _parts(F.col("hashes"), BLOCK_HASHES)).alias("blocks"))
    open_ = rooted.join(blocks, "hub")
    held = open_.where("outside").select("hub", _dealt("node", "blocks").alias("block"), "parts", "node", "root")
    every = open_.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = every.select("hub", "block", _dealt("node", "parts").alias("part"), "node", "root")
    return near.union(materialise(_links(held, every, sets, percent), "more-links"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id of its component, null if all are), kept."""
    if not PERCENT <= percent <= 100:
        raise ValueError(f"signatures are laid out for a similarity of {PERCENT} percent or more")
    about = described(text, size)
    rows = C.numbered(docs.select(F.col(doc_id).alias("doc_id"), about.alias("d")), "doc_id", "d.n", "d.digest", "d.signature", "d.hashes", name="minhash")
    same = rows.where("n > 0").groupBy("digest").agg(
        F.min(C.first_row()).alias("first"), F.min(F.struct("row", "n", "signature")).alias("one"))
    same = materialise(same.select("digest", "first", F.col("one.row").alias("node"), F.col("one.n").alias("n"), "one.signature"), "sets")
    members = hubs(same.where(F.col("n") >= least_linked(percent)))
    wanted = C.broadcast_checked(members.select("node").distinct(), 16)
    sets = materialise(rows.select(F.col("row").alias("node"), "n", "hashes").join(wanted, "node"), "wanted-sets")
    roots = components(links(members, sets, percent), "a", "b")
    joined = same.select("node", "first").join(roots, "node")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    moved = roots.join(least, "root").select("node", "least")
    classes = same.join(moved, "node", "left").select("digest", F.coalesce("least", "first").getField("id").alias("component_id"))
    found = rows.select("doc_id", "n", "digest").where("n > 0").join(classes, "digest").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.union(alone).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id",
                                     F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def sql(percent: int = PERCENT) -> str:
    """The same over `documents` in DuckDB, by brute force over pairs that share a shingle."""
    return rf"""
        WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 1], ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS p FROM t WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= {percent} * (p.n + q.n - m)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r(node, seen) AS (SELECT x, x FROM e UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.seen),
        k AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
        SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.component_id, t.doc_id) AS component_id, coalesce(k.component_id, t.doc_id) = t.doc_id AS kept
        FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN k ON k.node = t.doc_id"""
