"""Task-side arithmetic of the block search: one Arrow batch against the query block."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

NO_ID = np.iinfo(np.int64).max
PAIR_BUDGET = 1 << 22
# squared lengths whose products and quotients neither overflow nor vanish in double precision
PLAIN_SQUARES = (1e-140, 1e140)


BIT_METRICS = ("HAMMING", "JACCARD")


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of a list column as a matrix, in the type of the column when `dtype` is None."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, 0), dtype)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if flat.size % n:
        raise ValueError("vectors of different lengths in one batch")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if lengths.min() != lengths.max():
        raise ValueError("vectors of different lengths in one batch")
    return (flat if dtype is None else flat.astype(dtype, copy=False)).reshape(n, -1)


def running_sum(terms: np.ndarray) -> np.ndarray:
    """Sum along the last axis strictly from left to right, so equal rows give equal sums."""
    total = np.zeros(terms.shape[0])
    for d in range(terms.shape[1]):
        total += terms[:, d]
    return total


@dataclass
class Space:
    """How one metric is evaluated in blocks.

    `coarse` is a single-precision matrix product whose rounding error stays below `slack`;
    `exact` re-evaluates single pairs in double precision in a fixed order. Rows that survive
    the coarse bound are ranked by the exact value, so the answer is exact. `decode`
    (offset, step) turns scalar codes back into components.

    Under COSINE both sides are divided by their lengths before they are rounded, so that the
    coarse value, cosine with the sign changed, is the product itself. Vectors without a plain
    length are NaN there (missing if it is zero or NaN) and evaluated exactly if need be.
    """

    name: str
    queries: np.ndarray
    decode: tuple[np.ndarray, np.ndarray] | None = None
    _single: np.ndarray | None = field(default=None, repr=False)
    _aux: np.ndarray | None = field(default=None, repr=False)
    _squares: np.ndarray | None = field(default=None, repr=False)
    _odd: np.ndarray | None = field(default=None, repr=False)
    _last: tuple | None = field(default=None, repr=False)

    def __post_init__(self):
        if self.name in BIT_METRICS:
            self.queries = self._single = self._bits(self.queries)
            self._aux = self.queries.sum(axis=1)
            return
        self.queries = np.asarray(self.queries, np.float64)
        self._single = self.queries.astype(np.float32)
        self._aux = np.einsum("ij,ij->i", self._single, self._single)
        if self.name == "COSINE":
            self._squares, self._single, self._odd = self._unit(self.queries)
            np.negative(self._single, out=self._single)

    @staticmethod
    def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared lengths, rows over their lengths in single precision, positions of those to evaluate exactly."""
        x = x.astype(np.float64, copy=False)
        with np.errstate(over="ignore", invalid="ignore"):
            squares = running_sum(x * x)
            plain = (squares >= PLAIN_SQUARES[0]) & (squares <= PLAIN_SQUARES[1])
            unit = (x / np.sqrt(np.where(plain, squares, np.nan))[:, None]).astype(np.float32)
        return squares, unit, np.flatnonzero(~plain & (squares > 0))

    def _rows(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`_unit` of corpus rows, kept for the next queries that meet the same rows."""
        if self._last is None or self._last[0] is not x:
            self._last = (x, self._unit(x))
        return self._last[1]

    @staticmethod
    def _bits(codes: np.ndarray) -> np.ndarray:
        return np.unpackbits(np.ascontiguousarray(codes).astype(np.int8).view(np.uint8), axis=1).astype(np.float32)

    def load(self, column: pa.Array) -> np.ndarray:
        if self.name in BIT_METRICS:
            return self._bits(matrix(column, np.int8))
        if self.decode is not None:
            return matrix(column, np.float64) * self.decode[1] + self.decode[0]
        return matrix(column, None)

    def coarse(self, rows: slice, x: np.ndarray) -> np.ndarray:
        if self.name == "COSINE":
            _, unit, odd = self._rows(x)
            value = self._single[rows] @ unit.T
            if len(odd) or len(self._odd):
                positions = np.arange(len(self.queries))[rows]
                for at in np.flatnonzero(np.isin(positions, self._odd)):
                    value[at] = self.exact(np.full(len(x), positions[at]), x, np.arange(len(x))) - 1.0
                for at in odd:
                    value[:, at] = self.exact(positions, x, np.full(len(positions), at)) - 1.0
            return value
        single = x.astype(np.float32, copy=False)
        aux = self._aux[rows][:, None]
        product = self._single[rows] @ single.T
        if self.name == "IP":
            return np.negative(product, out=product)
        if self.name in BIT_METRICS:
            ones = aux + single.sum(axis=1)[None, :]
            if self.name == "HAMMING":
                return ones - 2.0 * product
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(ones > 0, 1.0 - product.astype(np.float64) / (ones - product), 1.0)
        sizes = np.einsum("ij,ij->i", single, single)
        product *= -2.0
        product += aux
        product += sizes[None, :]
        return product

    def slack(self, rows: slice, x: np.ndarray) -> np.ndarray:
        """Bound on the coarse rounding error of each query: (dim + 8) unit roundoffs per product."""
        n = len(self._aux[rows])
        if self.name in BIT_METRICS:
            return np.zeros(n)
        unit = (x.shape[1] + 8) * 2.0**-24
        if self.name == "COSINE":
            return np.full(n, 4 * unit)
        square = np.einsum("ij,ij->i", x, x)
        largest = float(square[np.isfinite(square)].max(initial=0.0))
        bound = 2 * unit * (self._aux[rows].astype(np.float64) + largest)
        return np.where(np.isfinite(bound), bound, np.inf)

    def as_coarse(self, dist: np.ndarray) -> np.ndarray:
        if self.name == "COSINE":
            return dist - 1.0
        return dist * dist if self.name == "L2" else dist

    def exact(self, qi: np.ndarray, x: np.ndarray, xi: np.ndarray) -> np.ndarray:
        out = np.empty(len(qi))
        step = max(1, PAIR_BUDGET // max(1, x.shape[1]))
        for lo in range(0, len(qi), step):
            part = slice(lo, lo + step)
            a, b = self.queries[qi[part]], x[xi[part]].astype(np.float64, copy=False)
            if self.name == "COSINE":
                out[part] = self._cosine(a, b, self._squares[qi[part]], self._rows(x)[0][xi[part]])
            else:
                out[part] = self._exact(a, b)
        return np.where(np.isnan(out), np.inf, out)  # a missing distance comes last

    def _exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.name in ("L2", "L2_SQUARED"):
            value = running_sum((a - b) ** 2)
            return np.sqrt(value) if self.name == "L2" else value
        if self.name == "HAMMING":
            return np.abs(a - b).sum(axis=1).astype(np.float64)
        product = running_sum(a * b)
        if self.name == "IP":
            return -product
        if self.name == "JACCARD":
            either = np.maximum(a, b).sum(axis=1).astype(np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(either > 0, 1.0 - product / either, 1.0)
        raise ValueError(self.name)

    @staticmethod
    def _cosine(a: np.ndarray, b: np.ndarray, a_squares: np.ndarray, b_squares: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            size = np.sqrt(a_squares * b_squares)
            return np.where(size > 0, 1.0 - running_sum(a * b) / size, np.inf)


class CodeSpace(Space):
    """Distances to product-quantised rows by table lookup.

    `tables[q, s, c]` is the squared distance of query q to code c in sub-space s.
    """

    def __init__(self, tables: np.ndarray):
        self.name = "PQ"
        self.queries = tables
        self.decode = self._single = self._aux = None

    def load(self, column: pa.Array) -> np.ndarray:
        return matrix(column, np.int64)

    def coarse(self, rows: slice, x: np.ndarray) -> np.ndarray:
        tables = self.queries[rows]
        total = np.zeros((tables.shape[0], x.shape[0]))
        for s in range(x.shape[1]):
            total += tables[:, s, :][:, x[:, s]]
        return total

    def slack(self, rows: slice, x: np.ndarray) -> np.ndarray:
        return np.zeros(self.queries[rows].shape[0])

    def exact(self, qi: np.ndarray, x: np.ndarray, xi: np.ndarray) -> np.ndarray:
        total = np.zeros(len(qi))
        for s in range(x.shape[1]):
            total += self.queries[qi, s, x[xi, s]]
        return total


class TopK:
    """The k best rows per query seen so far by one task."""

    def __init__(self, space: Space, k: int):
        self.space = space
        self.k = k
        n = space.queries.shape[0]
        self.dist = np.full((n, k), np.inf)
        self.ids = np.full((n, k), NO_ID, np.int64)

    def add(self, ids: np.ndarray, x: np.ndarray, subset: np.ndarray | None = None) -> None:
        """Take one batch, against all queries or a subset of query positions."""
        if len(ids) == 0:
            return
        if x.shape[1] != self.space.queries.shape[1]:
            raise ValueError(f"vectors of different lengths: {x.shape[1]} in the corpus, "
                             f"{self.space.queries.shape[1]} in the queries")
        if subset is not None:
            for lo in range(0, len(subset), 256):
                self._add_rows(subset[lo : lo + 256], ids, x)
            return
        n = self.space.queries.shape[0]
        step = max(1, PAIR_BUDGET // len(ids))
        for lo in range(0, n, step):
            self._add_rows(slice(lo, min(n, lo + step)), ids, x)

    def _add_rows(self, rows, ids: np.ndarray, x: np.ndarray, distinct: bool = False) -> None:
        k = self.k
        coarse = self.space.coarse(rows, x)
        slack = self.space.slack(rows, x)
        limit = self.space.as_coarse(self.dist[rows, k - 1]) + slack
        # in the type of the coarse values and rounded up, the limit loses no row; a missing distance passes none but infinity
        with np.errstate(over="ignore"):
            hits = coarse <= np.nextafter(limit.astype(coarse.dtype), coarse.dtype.type(np.inf))[:, None]
        hits[limit == np.inf] = True
        if coarse.shape[1] > k and np.count_nonzero(hits) > 4 * k * coarse.shape[0]:
            coarse = np.where(np.isnan(coarse), np.inf, coarse)
            # the task has no good bound yet, so the k-th best of this batch is one; its coarse value and
            # that of the row to keep may each be off by the slack
            tight = np.partition(coarse, k - 1, axis=1)[:, k - 1]
            hits = coarse <= np.minimum(limit, tight + 2 * slack)[:, None]
        flat = np.flatnonzero(hits)
        qi, xi = np.divmod(flat, coarse.shape[1])
        if not distinct and len(qi) > 8 * k * coarse.shape[0]:
            keep = k_copies(ids, x, k)
            if len(keep) < len(ids):
                self._add_rows(rows, ids[keep], x[keep], distinct=True)
                return
        positions = np.arange(rows.start, rows.stop) if isinstance(rows, slice) else np.asarray(rows)
        touched, local = np.unique(qi, return_inverse=True)
        if len(touched) == 0:
            return
        targets = positions[touched]
        dist = self.space.exact(positions[qi], x, xi)
        width = len(targets)
        owner = np.concatenate([np.repeat(np.arange(width), k), local])
        all_dist = np.concatenate([self.dist[targets].ravel(), dist])
        all_ids = np.concatenate([self.ids[targets].ravel(), ids[xi]])
        order = np.lexsort((all_ids, all_dist, owner))
        owner = owner[order]
        start = np.searchsorted(owner, np.arange(width))
        place = np.arange(len(owner)) - start[owner]
        kept = order[place < k]
        self.dist[targets] = all_dist[kept].reshape(width, k)
        self.ids[targets] = all_ids[kept].reshape(width, k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, id, distance) of every kept row."""
        found = self.ids != NO_ID
        qi = np.nonzero(found)[0]
        return qi, self.ids[found], self.dist[found]


def k_copies(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Positions of at most k rows per distinct vector, lowest ids first.

    Copies are at one distance and ties go to the lower id, so no other copy can be an answer.
    """
    raw = np.ascontiguousarray(x)
    key = raw.view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel()
    _, group = np.unique(key, return_inverse=True)
    order = np.lexsort((ids, group))
    sorted_group = group[order]
    start = np.searchsorted(sorted_group, np.arange(sorted_group[-1] + 1))
    place = np.arange(len(order)) - start[sorted_group]
    return np.sort(order[place < k])


def nearest(centroids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Position of the nearest centroid by L2 for each row, ties to the lower position."""
    out = np.empty(len(x), np.int64)
    sizes = np.einsum("ij,ij->i", centroids, centroids)
    step = max(1, PAIR_BUDGET // max(1, len(centroids)))
    for lo in range(0, len(x), step):
        part = x[lo : lo + step]
        out[lo : lo + step] = np.argmin(sizes[None, :] - 2.0 * (part @ centroids.T), axis=1)
    return out
