"""Inverted lists of rotated 1-bit codes with an unbiased distance estimate and a bound on its error.

A row's vector minus its centroid is turned by an orthogonal matrix and kept as sign bits, its length and its `fit`, the
cosine between the turned vector and its signs. For a query, minus the same centroid and turned, the cosine to the row
is estimated as the cosine to the row's signs divided by `fit`; this has no bias over rotations, and its error exceeds

    epsilon * sqrt((1 - fit^2) / fit^2) / sqrt(dim - 1)

only seldom (epsilon 1.9: about one in twenty, errors on either side together). So every row has an estimate between a
lower and an upper bound. The k rows with the smallest estimates are compared first; the worst of their true distances
bounds the k-th best, and only rows whose lower bound does not exceed it are compared besides. Their number follows from
the data and needs no refine factor.

The scan reads ids, bits and two numbers of the probed lists; `emb` is read for the rows that remain, from lists that
hold one. Tasks keep k upper bounds per query and the rows that may still matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import search as S
from ..operators.blocks import matrix
from ..session import check_broadcast, materialise, scratch_path
from .ivf import Centroids, _probe_table, assign, write_lists

EPSILON = 1.9
#: Rows a task holds before it drops those that no longer matter.
HELD = 1 << 20
CANDIDATES = "qid bigint, id bigint, list_id bigint, lower double, upper double, part int"


def hadamard_rotation(dim: int) -> np.ndarray:
    """Orthogonal matrix by rule, for powers of two: entry (i, j) is (-1)^(bits that i and j share) / sqrt(dim), with the
    sign of column j turned where j * (j + 1) / 2 is odd."""
    if dim & (dim - 1):
        raise ValueError(f"{dim} dimensions are not a power of two")
    i, j = np.indices((dim, dim))
    shared = np.bitwise_count(i & j) + j * (j + 1) // 2
    return np.where(shared % 2 == 0, 1.0, -1.0) / np.sqrt(dim)


def random_rotation(dim: int, seed: int = 7) -> np.ndarray:
    """Orthogonal matrix from a seeded normal sample, for any number of dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def rotation_for(dim: int, seed: int = 7) -> np.ndarray:
    return random_rotation(dim, seed) if dim & (dim - 1) else hadamard_rotation(dim)


def rotated_codes(corpus: DataFrame, centroids: Centroids, rotation: np.ndarray) -> DataFrame:
    """(id, emb, list_id, code, size, fit): packed sign bits of the turned residual, its length and its cosine to the signs."""
    check_broadcast(corpus.sparkSession, rotation.nbytes, "rotation")
    rows = assign(corpus.select("id", "emb"), centroids, residuals=True)
    element = rows.schema["emb"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = matrix(batch.column("residual")) @ rotation.T
            size = np.sqrt((y * y).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                fit = np.where(size > 0, np.abs(y).sum(axis=1) / (np.sqrt(y.shape[1]) * size), 1.0)
            bits = np.packbits(y > 0, axis=1).view(np.int8)
            offsets = pa.array((np.arange(len(y) + 1) * bits.shape[1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "emb", "list_id")), pa.ListArray.from_arrays(offsets, pa.array(bits.ravel())), pa.array(size), pa.array(fit)],
                ["id", "emb", "list_id", "code", "size", "fit"])

    return rows.mapInArrow(run, f"id bigint, emb array<{element}>, list_id bigint, code array<tinyint>, size double, fit double")


class Bounded:
    """The k smallest upper bounds per query and the rows that may be among its k nearest."""

    def __init__(self, queries: int, k: int, held: int = HELD):
        self.k, self.limit = k, held
        self.upper = np.full((queries, k), np.inf)
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, at: np.ndarray, ids: np.ndarray, list_id: int, estimate: np.ndarray, error: np.ndarray) -> None:
        """Estimates and errors of the queries `at` (rows) for all ids (columns)."""
        upper, lower = estimate + error, estimate - error
        both = np.concatenate([self.upper[at], upper], axis=1)
        self.upper[at] = np.partition(both, self.k - 1, axis=1)[:, :self.k]
        qi, xi = np.nonzero(lower <= self.upper[at].max(axis=1)[:, None])
        self.rows.append((at[qi], ids[xi], np.full(len(qi), list_id, np.int64), lower[qi, xi], upper[qi, xi]))
        self.size += len(qi)
        if self.size > self.limit:
            self.prune()
            self.limit = max(self.limit, 2 * self.size)

    def prune(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, float, float))
        rows = tuple(np.concatenate(c) for c in zip(*self.rows))
        keep = rows[3] <= self.upper.max(axis=1)[rows[0]]
        self.rows = [tuple(c[keep] for c in rows)]
        self.size = int(keep.sum())
        return self.rows[0]


def _scan(vectors: np.ndarray, ids: np.ndarray, probes: dict[int, np.ndarray], centroids: Centroids, rotation: np.ndarray, k: int, epsilon: float):
    place = {int(l): i for i, l in enumerate(centroids.ids)}
    dim = vectors.shape[1]

    def run(batches):
        best = Bounded(len(ids), k)
        turned: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            lists = batch.column("list_id").to_numpy(zero_copy_only=False)
            codes = matrix(batch.column("code"), np.int8)
            row_ids, size, fit = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "size", "fit"))
            for list_id in np.unique(lists).tolist():
                if list_id not in turned:
                    q = (vectors[probes[list_id]] - centroids.vectors[place[list_id]]) @ rotation.T
                    turned[list_id] = q, (q * q).sum(axis=1)
                q, square = turned[list_id]
                inside = np.flatnonzero(lists == list_id)
                signs = np.unpackbits(np.ascontiguousarray(codes[inside]).view(np.uint8), axis=1)[:, :dim] * 2.0 - 1.0
                r, f = size[inside], fit[inside]
                along = (q @ signs.T) / (np.sqrt(dim) * f)
                estimate = r * r + square[:, None] - 2.0 * r * along
                slack = 2.0 * epsilon * r * np.sqrt(np.maximum(0.0, 1.0 - f * f) / (f * f)) / np.sqrt(max(1, dim - 1))
                best.add(probes[list_id], row_ids[inside], list_id, estimate, np.sqrt(square)[:, None] * slack)
        at, found, list_id, lower, upper = best.prune()
        part = np.full(len(at), TaskContext.get().partitionId() % S.MERGE_WIDTH, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[at], found, list_id, lower, upper, part)], ["qid", "id", "list_id", "lower", "upper", "part"])

    return run


def likely(partial: DataFrame, k: int) -> DataFrame:
    """(qid, id, list_id) of the k smallest estimates of each query."""
    near = partial.withColumn("estimate", F.col("lower") + F.col("upper"))
    for within in (["qid", "part"], ["qid"]):
        near = near.withColumn("_r", S.rank_within(within, "estimate")).filter(F.col("_r") <= k)
    return near.select("qid", "id", "list_id")


def unsettled(partial: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """(qid, id, list_id) of rows whose lower bound doesn't exceed the k-th of the true distances `first(qid, dist, rank)`."""
    bound = first.filter(F.col("rank") == k).select(F.col("qid").alias("_q"), (F.col("dist") * F.col("dist")).alias("_bound"))
    joined = partial.join(bound, F.col("qid") == F.col("_q"), "left")
    return joined.filter(F.col("_bound").isNull() | (F.col("lower") <= F.col("_bound"))).select("qid", "id", "list_id")


def rotated_top_k(queries: DataFrame, coded: DataFrame, centroids: Centroids, rotation: np.ndarray, k: int, nprobe: int, epsilon: float = EPSILON,
                  where: Column | None = None) -> DataFrame:
    """L2 top-k of `coded(id, emb, list_id, code, size, fit)` in the `nprobe` lists nearest to each query."""
    rows = coded if where is None else coded.filter(where)

    def scan(block: S.QueryBlock) -> DataFrame:
        probes = _probe_table(block.vectors, centroids, nprobe)
        probed = rows.filter(F.col("list_id").isin(list(probes))).select("id", "list_id", "code", "size", "fit")
        partial = materialise(probed.mapInArrow(_scan(block.vectors, block.ids, probes, centroids, rotation, k, epsilon), CANDIDATES), "bounded")
        full = rows.filter(F.col("list_id").isin(list(probes))).select("id", "emb", "list_id")
        first = S.rerank(queries, full, likely(partial, k), k, "L2", len(block.ids) * k, ("list_id",))
        chosen = materialise(unsettled(partial, first, k), "candidates")
        lists = [r[0] for r in chosen.select("list_id").distinct().collect()]  # at most the probed lists
        held = full.filter(F.col("list_id").isin(lists))
        return S.rerank(queries, held, chosen, k, "L2", chosen.count(), ("list_id",))

    return S.over_query_blocks(queries.select("qid", "emb"), k, scan)


@dataclass
class RotatedBits:
    """A search method over rotated 1-bit codes; `nlist` clusters trained on a share of the corpus, `nprobe` lists per query."""

    nlist: int = 16
    nprobe: int = 4
    epsilon: float = EPSILON
    fraction: float = 1.0
    centroids: Centroids | None = field(default=None, repr=False)
    rotation: np.ndarray | None = field(default=None, repr=False)

    def build(self, corpus: DataFrame) -> DataFrame:
        if self.centroids is None:
            self.centroids = Centroids.train(corpus, self.nlist, self.fraction)
        if self.rotation is None:
            self.rotation = rotation_for(self.centroids.vectors.shape[1])
        return write_lists(rotated_codes(corpus, self.centroids, self.rotation), scratch_path(corpus.sparkSession, "rotated"))

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        if S.metric_of(metric).name != "L2":
            raise ValueError("rotated codes search under L2; normalise first for other metrics")
        return rotated_top_k(queries, table, self.centroids, self.rotation, k, self.nprobe, self.epsilon, where)
