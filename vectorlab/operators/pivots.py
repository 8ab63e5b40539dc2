"""Radius search that skips rows by their distances to a few pivots.

A row within `radius` of a query is nearly as far from every pivot as the query: by the triangle inequality the two
distances differ by at most `radius`. The distances to the pivots are stored as columns and the table is sorted by the
first, so the reader skips row groups and pages that no query can reach; the other pivots drop rows before their
vectors are compared. The answers are those of the full search under L2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import check_broadcast
from .blocks import Space, matrix
from .quantise import first_codebooks
from .search import QueryBlock, over_query_blocks, scan_corpus, within_radius

PIVOTS, ROW_GROUP_BYTES, PAGE_BYTES, INTERVALS = 4, 1 << 20, 1 << 16, 200
#: Relative rounding error allowed for a distance; far above that of double precision sums.
ROUNDING = 1e-9


def choose_pivots(corpus: DataFrame, pivots: int = PIVOTS, seed: int = 7) -> np.ndarray:
    """Rows chosen by a hash of their id."""
    return first_codebooks(corpus, 1, pivots, seed=seed)[0]


def _far(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def write_pivots(corpus: DataFrame, pivots: np.ndarray, path: str, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> DataFrame:
    """Store `corpus(id, emb)` with its distances p0, p1, ... to the pivots, sorted by p0."""
    check_broadcast(corpus.sparkSession, pivots.nbytes, "pivots")
    names = [f"p{i}" for i in range(len(pivots))]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                far = _far(matrix(batch.column("emb")), pivots)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("emb"), *(pa.array(far[:, i]) for i in range(len(pivots)))], ["id", "emb", *names])

    rows = corpus.filter(F.col("emb").isNotNull()).select("id", "emb")
    kind = rows.schema["emb"].dataType.simpleString()
    known = rows.mapInArrow(run, f"id bigint, emb {kind}, " + ", ".join(f"{n} double" for n in names))
    ranged = known.repartitionByRange(files, "p0") if files else known.repartitionByRange("p0")
    options = {"parquet.block.size": row_group_bytes, "parquet.page.size": PAGE_BYTES, "parquet.page.size.row.check.min": 10, "parquet.block.size.row.check.min": 10}
    ranged.sortWithinPartitions("p0").write.mode("overwrite").options(**options).parquet(path)
    return corpus.sparkSession.read.schema(known.schema).parquet(path)


def intervals(low: np.ndarray, high: np.ndarray, most: int = INTERVALS) -> list[tuple[float, float]]:
    """The union of intervals as at most `most` intervals; the closest ones are joined first."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    gaps = low[1:] - high[:-1]
    cut = np.flatnonzero(gaps > 0)
    cut = np.sort(cut[np.argsort(gaps[cut], kind="stable")[max(0, len(cut) - (most - 1)):]])
    return list(zip(low[np.append(0, cut + 1)].tolist(), high[np.append(cut, len(low) - 1)].tolist()))


def _reachable(column: str, parts: list[tuple[float, float]]) -> Column:
    tests = [F.col(column).between(a, b) for a, b in parts]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


def radius_search_by_pivots(queries: DataFrame, table: DataFrame, pivots: np.ndarray, radius: float, num: int, min_num: int = 0) -> DataFrame:
    """As `radius_search` under L2, over a table of `write_pivots`. Rows with missing components are never within a radius."""
    names = [f"p{i}" for i in range(len(pivots))]

    def scan(block: QueryBlock) -> DataFrame:
        far = _far(block.vectors, pivots)
        reach = radius + ROUNDING * (1.0 + radius + far)

        def near(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                p = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
                keep = np.zeros(len(p), bool)
                for f, r in zip(far, reach):
                    rest = np.flatnonzero(~keep)
                    keep[rest] = (np.abs(p[rest] - f) <= r).all(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("id", "emb")], ["id", "emb"])

        reached = table.filter(_reachable("p0", intervals(far[:, 0] - reach[:, 0], far[:, 0] + reach[:, 0])))
        rows = reached.mapInArrow(near, f"id bigint, emb {table.schema['emb'].dataType.simpleString()}")
        return scan_corpus(rows, block.ids, Space("L2", block.vectors), num)

    return within_radius(over_query_blocks(queries.select("qid", "emb"), num, scan), radius, min_num)
