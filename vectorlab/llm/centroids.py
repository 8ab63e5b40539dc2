"""Clusters of integer vectors: k-means rounds whose assignment is a tournament over bisectors.

A vector's component x becomes the integer floor(scale * x). For centroids i < j the vector v is nearer to j exactly when

    2 v . (c_j - c_i)  >  |c_j|^2 - |c_i|^2,

so the normals and thresholds of all pairs are computed once a round, and k - 1 sign tests, each between the winner
so far and the next centroid, leave the nearest one. Equality keeps the smaller number. Only the final distance is
computed in full. All arithmetic is on integers: 64-bit where a bound on the components allows it, else unbounded.

Tasks send sums per cluster, component and 32-bit limb, so sums are exact however many vectors there are; the driver
sees k * dims of them. The table is scanned once a round and twice at the end, and never shuffled.

Vectors that don't have exactly `dims` components, or hold a null, NaN or infinite one, are left out. Ids may be null
(hashed as the bare seed) or repeated; each row counts for itself. With fewer vectors than clusters there are as many
clusters as vectors. A distance or inertia beyond 64 bits is null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import check_broadcast

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Components below this size, in at most NARROW_DIMS dimensions, keep every test below 2^63.
NARROW, NARROW_DIMS, LIMB, LONG = 1 << 23, 1 << 10, 32, (1 << 63) - 1
STEP = 4096
RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python integers where a component is not small."""
    if x.size == 0 or (np.abs(x).max() < NARROW / scale and x.shape[1] <= NARROW_DIMS):
        return np.floor(x * scale).astype(np.int64)
    exact = lambda v: (n := v.as_integer_ratio())[0] * scale // n[1]
    return np.array([[exact(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


class Tournament:
    """Bisectors of every pair of centroids."""

    def __init__(self, centroids: list[list[int]]):
        flat = [abs(v) for c in centroids for v in c]
        self.narrow = max(flat, default=0) < NARROW and len(centroids[0]) <= NARROW_DIMS
        self.centroids = np.array(centroids, np.int64 if self.narrow else object)
        k = len(centroids)
        size = (self.centroids * self.centroids).sum(axis=1)
        i, j = np.triu_indices(k, 1)
        self.pair = np.zeros((k, k), np.int64)
        self.pair[i, j] = np.arange(len(i))
        self.normal = 2 * (self.centroids[j] - self.centroids[i])
        self.threshold = size[j] - size[i]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row, the smaller one on a tie."""
        if x.dtype == object and self.narrow:
            return Tournament.wide(self).winners(x)
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            test = self.pair[best, j]
            best[((self.normal[test] * x).sum(axis=1) > self.threshold[test]).astype(bool)] = j
        return best

    def wide(self) -> "Tournament":
        other = object.__new__(Tournament)
        other.narrow, other.pair = False, self.pair
        other.centroids, other.normal, other.threshold = (a.astype(object) for a in (self.centroids, self.normal, self.threshold))
        return other

    def distances(self, x: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        centre = self.centroids[cluster]
        gap = x - (centre.astype(object) if x.dtype == object else centre)
        return (gap * gap).sum(axis=1)


def usable(embedding: Column, dims: int = DIMS) -> Column:
    """Whether a vector has exactly `dims` components and all are finite numbers."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(embedding) == dims) & finite, F.lit(False))


def _parts(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a batch as integers, STEP at a time, with the first row's position; wide rows don't make others wide."""
    column = batch.column(batch.num_columns - 1)
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    for at in range(0, batch.num_rows, STEP):
        yield at, integers(flat[at:at + STEP], scale)


def _limbs(total: int) -> list[int]:
    """A whole number as signed limbs, lowest first; limbs of many numbers may be added."""
    sign, rest, out = (1 if total >= 0 else -1), abs(total), []
    while rest:
        out.append(sign * (rest & (1 << LIMB) - 1))
        rest >>= LIMB
    return out


def _sums(vectors: DataFrame, centroids: list[list[int]], scale: int) -> dict[int, list[int]]:
    """Per cluster the number of its vectors, then the sum of each component."""
    def run(batches):
        field, total = Tournament(centroids), {}
        for batch in batches:
            for _, x in _parts(batch, scale):
                won = field.winners(x)
                for c in np.unique(won):
                    inside = x[won == c]
                    new = [len(inside), *(int(v) for v in inside.sum(axis=0))]
                    total[c] = [a + b for a, b in zip(total[c], new)] if c in total else new
        rows = [(int(c), d, l, v) for c, sums in total.items() for d, s in enumerate(sums) for l, v in enumerate(_limbs(s))]
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        names = ["cluster", "dim", "limb", "value"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    parts = vectors.mapInArrow(run, "cluster int, dim int, limb int, value bigint")
    found: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("value").alias("value")).collect():  # k * (dims + 1) values
        sums = found.setdefault(r["cluster"], [0] * (len(centroids[0]) + 1))
        sums[r["dim"]] += r["value"] << LIMB * r["limb"]
    return found


def start(vectors: DataFrame, clusters: int = CLUSTERS, scale: int = SCALE, seed: int = SEED) -> list[list[int]]:
    """Integer vectors whose ids have the smallest SHA-256 of `seed:id`, in that order; equal ids by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(digest.alias("digest"), "emb").orderBy("digest", "emb").limit(clusters).collect()
    if not first:
        return []
    return [[int(v) for v in row] for row in integers(np.array([r["emb"] for r in first], np.float64), scale)]


def train(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> list[list[int]]:
    """Centroids of `vectors(vec_id, emb)` after the rounds; an empty cluster keeps its centroid."""
    centroids = start(vectors, clusters, scale, seed)
    check_broadcast(vectors.sparkSession, 8 * len(centroids) ** 2 * max(map(len, centroids), default=0), "bisectors of the centroids")
    for _ in range(rounds if centroids else 0):
        sums = _sums(vectors, centroids, scale)
        centroids = [[s // sums[c][0] for s in sums[c][1:]] if c in sums else old for c, old in enumerate(centroids)]
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]], scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; the distance is squared, and null beyond 64 bits."""
    def run(batches):
        field = Tournament(centroids)
        for batch in batches:
            for at, x in _parts(batch, scale):
                won = field.winners(x)
                far = field.distances(x, won)
                distance = pa.array([v if v <= LONG else None for v in far] if far.dtype == object else far, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(x)), pa.array(won.astype(np.int32)), distance],
                                                 ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def _inertia(rows: DataFrame, distance: str, *keys: str) -> DataFrame:
    """Sum of distances, null where one is missing or the sum passes 64 bits."""
    total = F.sum(F.col(distance).cast("decimal(38,0)"))
    return rows.groupBy(*keys).agg(F.when(F.count(F.lit(1)) == F.count(distance), total.try_cast("bigint")).alias("total"))


def clusters(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = DIMS, k: int = CLUSTERS, rounds: int = ROUNDS,
             scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 (of the comma-joined components)."""
    spark = df.sparkSession
    emb = F.col(embedding).cast("array<double>")
    vectors = df.where(usable(emb, dims)).select(F.col(vec_id).alias("vec_id"), emb.alias("emb"))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = train(vectors, k, rounds, scale, seed)
    if not centroids:
        return spark.createDataFrame([], f"vec_id {kind}, {RESULT}")
    found = assign(vectors, centroids, scale)
    per = {r["cluster"]: r["total"] for r in _inertia(found, "distance", "cluster").collect()}  # k rows
    whole = None if None in per.values() or sum(per.values()) > LONG else sum(per.values())
    about = [(c, per[c], whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in sorted(per)]
    table = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(dims: int = DIMS, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same over `embeddings` in DuckDB."""
    assigned = """a{r} AS (SELECT vec_id, q, cl, d FROM (
            SELECT vec_id, q, cl, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, cl) AS place FROM (
                SELECT v.vec_id, v.q, c.cl, list_sum(list_transform(range(1, {dims} + 1), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i]))) AS d
                FROM v CROSS JOIN c{r} c)) WHERE place = 1)"""
    moved = """s{r} AS (SELECT cl, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cl, unnest(range(1, {dims} + 1)) AS i, unnest(q) AS x FROM a{r}) GROUP BY cl, i),
        c{n} AS (SELECT cl, list(((s - ((s % n) + n) % n) // n) ORDER BY i) AS q FROM s{r} GROUP BY cl
                 UNION ALL SELECT cl, q FROM c{r} WHERE cl NOT IN (SELECT cl FROM a{r}))"""
    steps = [x.format(r=r, n=r + 1, dims=dims) for r in range(rounds) for x in (assigned, moved)] + [assigned.format(r=rounds, dims=dims)]
    return f"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                   WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
        c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS cl, q FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, q FROM v ORDER BY h LIMIT {k})),
        {", ".join(steps)},
        t AS (SELECT cl, sum(d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY cl)
        SELECT a.vec_id, a.cl::INTEGER AS cluster, a.d::BIGINT AS distance, t.cluster_inertia, (SELECT sum(cluster_inertia) FROM t)::BIGINT AS inertia,
               sha256(array_to_string(c.q, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN t ON a.cl = t.cl JOIN c{rounds} c ON a.cl = c.cl"""
