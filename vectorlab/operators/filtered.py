"""Exact top-k under many filters in one scan of the corpus.

Filters of the form `id >= threshold` are sorted by threshold. The thresholds cut the ids into segments, and a row
belongs to one: a task compares it once and updates the k best of its segment only. What a filter passes is the union
of the segments from its threshold on, so its answer is merged from theirs. A label filter passes the rows of one label,
which are kept by label in the same scan; rows with no wanted label are not compared for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import metric as metric_of
from .blocks import Space, TopK
from .search import MERGE_WIDTH, QueryBlock, full_batches, over_query_blocks, rank_within

PARTIAL = "family int, place int, qid bigint, id bigint, dist double, part int"
RESULT = "filter string, qid bigint, id bigint, dist double, rank int"


def _scan(block: QueryBlock, name: str, k: int, cuts: np.ndarray, labels: list[str]):
    def run(batches):
        best: dict[tuple[int, int], TopK] = {}

        def take(family: int, place: np.ndarray, ids: np.ndarray, x: np.ndarray):
            for p in np.unique(place[place >= 0]).tolist():
                inside = place == p
                best.setdefault((family, p), TopK(space, k)).add(ids[inside], x[inside])

        space = Space(name, block.vectors)
        for batch in full_batches(batches):
            if not batch.num_rows:
                continue
            ids, x = batch.column("id").to_numpy(zero_copy_only=False), space.load(batch.column("emb"))
            if len(cuts):
                take(0, np.searchsorted(cuts, ids, "right") - 1, ids, x)
            if labels:
                own = pa.compute.index_in(batch.column("labels"), pa.array(labels, pa.string()))
                take(1, own.fill_null(-1).to_numpy(zero_copy_only=False), ids, x)
        part = TaskContext.get().partitionId() % MERGE_WIDTH
        for (family, place), found in best.items():
            at, rows, dist = found.rows()
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, family, np.int32)), pa.array(np.full(n, place, np.int32)), pa.array(block.ids[at]), pa.array(rows),
                 pa.array(dist, mask=~np.isfinite(dist)), pa.array(np.full(n, part, np.int32))], ["family", "place", "qid", "id", "dist", "part"])

    return run


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    return rows.withColumn("rank", rank_within(list(keys))).filter(F.col("rank") <= k)


def top_k_under_filters(queries: DataFrame, corpus: DataFrame, k: int = 100, metric: str = "L2", thresholds: dict[str, int] | None = None,
                        labels: dict[str, str] | None = None) -> DataFrame:
    """(filter, qid, id, dist, rank): the exact top-k of every query under every named filter.

    `thresholds` maps a filter's name to its least id, `labels` to the value of `corpus.labels`. Thresholds may be equal.
    """
    thresholds, labels = thresholds or {}, labels or {}
    spark, name = queries.sparkSession, metric_of(metric).name
    cuts = np.array(sorted(set(thresholds.values())), np.int64)
    values = sorted(set(labels.values()))
    passed = [(0, int(s), f) for f, least in thresholds.items() for s in np.flatnonzero(cuts >= least)]
    passed += [(1, values.index(v), f) for f, v in labels.items()]
    if not passed:
        return spark.createDataFrame([], RESULT)
    rows = corpus.filter(F.col("emb").isNotNull()).select("id", "emb", *(["labels"] if labels else []))
    if len(cuts):
        wanted = F.col("id") >= int(cuts[0])
        rows = rows.filter(wanted | F.col("labels").isin(values) if labels else wanted)
    elif labels:
        rows = rows.filter(F.col("labels").isin(values))
    groups = len(cuts) + len(values)

    def scan(block: QueryBlock) -> DataFrame:
        partial = rows.mapInArrow(_scan(block, name, k, cuts, values), PARTIAL)
        once = _best(_best(partial, k, "family", "place", "qid", "part").drop("rank"), k, "family", "place", "qid").drop("rank", "part")
        named = spark.createDataFrame(passed, "family int, place int, filter string")
        return _best(once.join(F.broadcast(named), ["family", "place"]), k, "filter", "qid").select("filter", "qid", "id", "dist", "rank")

    return over_query_blocks(queries.select("qid", "emb"), k * groups, scan, schema=RESULT)


def ground_truths(queries: DataFrame, corpus: DataFrame, k: int = 100, metric: str = "L2", thresholds: dict[str, int] | None = None,
                  labels: dict[str, str] | None = None) -> DataFrame:
    """(filter, id, neighbors_id): exact neighbours of every query, nearest first, under every filter."""
    found = top_k_under_filters(queries, corpus, k, metric, thresholds, labels)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "id")))  # at most k
    return found.groupBy("filter", F.col("qid").alias("query")).agg(F.transform(ordered, lambda s: s["id"]).alias("neighbors_id")).withColumnRenamed("query", "id")
