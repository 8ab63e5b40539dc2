"""Whole-corpus vector statistics, computed per task and merged by dimension."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import matrix


def mean_vectors(df: DataFrame, key: str, emb: str = "emb") -> DataFrame:
    """(key, emb, n): mean vector per key.

    Each task sums its own rows per key, so a key that holds a third of the corpus sends one
    row per dimension and task.
    """
    schema = "key bigint, dim int, total double, n bigint"

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            x = matrix(batch.column("emb"))
            uniques, inverse = np.unique(keys, return_inverse=True)
            block = np.zeros((len(uniques), x.shape[1]))
            np.add.at(block, inverse, x)
            for i, (value, n) in enumerate(zip(uniques.tolist(), np.bincount(inverse).tolist())):
                sums[value] = sums[value] + block[i] if value in sums else block[i]
                counts[value] = counts.get(value, 0) + n
            if len(sums) * x.shape[1] > 1 << 20:
                yield _by_dimension(sums, counts)
                sums, counts = {}, {}
        if sums:
            yield _by_dimension(sums, counts)

    rows = df.filter(F.col(emb).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(emb).alias("emb"))
    by_dim = (rows.mapInArrow(partial, schema).groupBy("key", "dim")
              .agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    ordered = F.array_sort(F.collect_list(F.struct("dim", (F.col("total") / F.col("n")).alias("mean"))))
    return by_dim.groupBy("key").agg(
        F.transform(ordered, lambda s: s["mean"]).alias("emb"), F.max("n").alias("n"))


def _by_dimension(sums: dict[int, np.ndarray], counts: dict[int, int]) -> pa.RecordBatch:
    keys = np.fromiter(sums, np.int64, len(sums))
    block = np.stack(list(sums.values()))
    dims = block.shape[1]
    n = np.fromiter((counts[k] for k in sums), np.int64, len(sums))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(keys, dims)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(keys))),
         pa.array(block.ravel()), pa.array(np.repeat(n, dims))],
        names=["key", "dim", "total", "n"],
    )


def dimension_range(df: DataFrame, emb: str = "emb") -> DataFrame:
    """(dim, lo, hi): smallest and largest component per dimension."""
    def partial(batches):
        lo = hi = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column(0))
            low, high = x.min(axis=0), x.max(axis=0)
            lo = low if lo is None else np.minimum(lo, low)
            hi = high if hi is None else np.maximum(hi, high)
        if lo is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(lo), dtype=np.int32)), pa.array(lo), pa.array(hi)], names=["dim", "lo", "hi"])

    return (df.filter(F.col(emb).isNotNull()).select(emb)
            .mapInArrow(partial, "dim int, lo double, hi double")
            .groupBy("dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
