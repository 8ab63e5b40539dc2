"""Tables sorted by id from which a few rows are read without a scan.

Files cover disjoint id ranges, and a small table beside them says which. A lookup opens only files whose range holds a
wanted id. Inside a file the ids go down to the reader as ranges, so that row groups and pages without a wanted id are
skipped by their statistics; single ids are tested against the row groups' bloom filters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search as S
from ..session import broadcast_limit, materialise

ROW_GROUP_BYTES, PAGE_BYTES = 1 << 20, 1 << 16
#: Ranges in a filter; more wanted ids are joined to ranges where they are closest.
RANGES = 200


def write_lookup(df: DataFrame, path: str, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES, ids_per_group: int = 1 << 14) -> "Lookup":
    """Store `df(id, ...)` in id order, with the id range of every file."""
    ranged = df.repartitionByRange(files, "id") if files else df.repartitionByRange("id")
    options = {"parquet.block.size": row_group_bytes, "parquet.page.size": PAGE_BYTES, "parquet.page.size.row.check.min": 10,
               "parquet.block.size.row.check.min": 10, "parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.expected.ndv#id": ids_per_group}
    ranged.sortWithinPartitions("id").write.mode("overwrite").options(**options).parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    about = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    about.write.mode("overwrite").parquet(f"{path}/files")
    return Lookup(df.sparkSession, path)


def id_ranges(ids: np.ndarray, most: int = RANGES) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all of the ascending ids, and as little else as possible."""
    if not len(ids):
        return []
    gaps = np.diff(ids)
    cut = np.sort(np.argsort(gaps, kind="stable")[len(gaps) - min(most - 1, len(gaps)):])
    cut = cut[gaps[cut] > 1]
    return list(zip(ids[np.append(0, cut + 1)].tolist(), ids[np.append(cut, len(ids) - 1)].tolist()))


def in_ranges(column: str, ranges: list[tuple[int, int]]) -> Column:
    """Whether a value lies in one of the ranges, as a balanced tree of tests."""
    if not ranges:
        return F.lit(False)
    tests = [F.col(column) == a if a == b else F.col(column).between(a, b) for a, b in ranges]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


class Lookup:
    """A table written by `write_lookup`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def files_with(self, ids: np.ndarray) -> list[str]:
        """Files whose id range holds one of the ascending ids; no more than there are ids."""
        def run(batches):
            for batch in batches:
                low, high = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
                inside = np.searchsorted(ids, low, "left") < np.searchsorted(ids, high, "right")
                yield pa.RecordBatch.from_arrays([batch.column("file").filter(pa.array(inside))], ["file"])

        about = self.spark.read.parquet(f"{self.path}/files").where("low IS NOT NULL")
        return sorted(r["file"] for r in about.mapInArrow(run, "file string").collect())

    def candidates_of(self, wanted: DataFrame) -> DataFrame:
        """Rows in whose ranges a wanted id lies: all wanted rows and some others. `wanted(id)` may repeat ids.

        The distinct ids are fetched if they fit the broadcast limit; beyond it a lookup is no better than a scan, and
        all rows are returned.
        """
        distinct = materialise(wanted.where(F.col("id").isNotNull()).select("id").distinct(), "wanted")
        if distinct.count() * 8 > broadcast_limit(self.spark):
            return self.rows()
        ids = np.sort(distinct.toArrow().column(0).to_numpy())
        paths = self.files_with(ids)
        if not paths:
            return self.rows().where(F.lit(False))
        rows = self.spark.read.schema(self.rows().schema).parquet(*paths)
        return rows.where(in_ranges("id", id_ranges(ids)))


def rerank_by_lookup(queries: DataFrame, table: Lookup, candidates: DataFrame, k: int, metric: str = "L2") -> DataFrame:
    """Exact distances for `candidates(qid, id)` and the best k, reading only where candidates lie."""
    chosen = materialise(candidates.select("qid", "id"), "candidates")
    rows = table.candidates_of(chosen.select("id")).select("id", "emb")
    return S.rerank(queries, rows, chosen, k, metric, chosen.count())
