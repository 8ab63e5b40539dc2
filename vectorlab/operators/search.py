"""Batch vector search: top-k, range search, rerank and two-phase search.

The corpus is scanned once per query block and never shuffled: the query block is a broadcast
of checked size, each task keeps k rows per query, and only those meet in the final merge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import metric as metric_of
from ..session import broadcast_if_small, broadcast_limit, scratch_path
from .blocks import CodeSpace, Space, TopK, matrix
from .grid import grid_top_k

RESULT = "qid bigint, id bigint, dist double, rank int"
PARTIAL = "qid bigint, id bigint, dist double, part int"
MERGE_WIDTH = 64
BATCH_ROWS = 10_000


def query_set(df: DataFrame, qid: str = "qid", emb: str = "emb") -> DataFrame:
    return df.select(F.col(qid).cast("bigint").alias("qid"), F.col(emb).alias("emb"))


def query_blocks(queries: DataFrame, k: int, bytes_per_value: int = 8, tables: int = 1) -> tuple[int, int]:
    """(number of blocks, number of queries) so that one block fits the broadcast limit.

    A query costs its vector (times `tables` for lookup tables) and k result slots.
    """
    row = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("emb")).alias("dim")).first()
    n, dim = row["n"], row["dim"] or 0
    limit = broadcast_limit(queries.sparkSession)
    total = n * (dim * bytes_per_value * tables + 24 * k)
    if total <= limit:
        return 1, n
    # hashing is uneven, so blocks aim at three quarters of the limit
    return int(np.ceil(total / (0.75 * limit))), n


@dataclass
class QueryBlock:
    """Ids and vectors of one size-checked query block, in id order, with any further columns."""

    ids: np.ndarray
    vectors: np.ndarray
    columns: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fetch(cls, block: DataFrame) -> "QueryBlock":
        table = block.toArrow().sort_by("qid")
        kind = table.schema.field("emb").type.value_type
        vectors = matrix(table.column("emb"), np.int8 if kind == pa.int8() else np.float64)
        others = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("qid", "emb")}
        return cls(table.column("qid").to_numpy(), vectors, others)


def over_query_blocks(queries: DataFrame, k: int, scan: Callable[[QueryBlock], DataFrame],
                      tables: int = 1, beyond: Callable[[DataFrame], DataFrame] | None = None, schema: str = RESULT) -> DataFrame:
    """Run `scan(block)` for every block of `queries(qid, emb, ...)` and join the answers.

    One block is the normal case and stays lazy. A query set above the broadcast limit is cut
    into blocks by a hash of the query id; every block is a full parallel pass over the corpus
    whose answers go to the shared folder before the next block is fetched, so neither the
    driver nor a task ever holds more than one block. `beyond` takes such query sets instead.
    """
    spark = queries.sparkSession
    # sized and then fetched, so that an expensive query set is computed once
    cached = queries.persist()
    try:
        blocks, n = query_blocks(cached, k, tables=tables)
        if n == 0:
            return spark.createDataFrame([], schema)
        if blocks == 1:
            return scan(QueryBlock.fetch(cached))
        if beyond is not None:
            return beyond(cached)
        path = scratch_path(spark, "answers")
        for b in range(blocks):
            block = QueryBlock.fetch(cached.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b))
            if len(block.ids):
                scan(block).write.mode("append").parquet(path)
        return spark.read.schema(schema).parquet(path)
    finally:
        cached.unpersist()


def full_batches(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Small Arrow batches joined up to `rows` rows, so that the search does not depend on how a session cuts them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches() if len(held) > 1 else held
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def scan_corpus(corpus: DataFrame, ids: np.ndarray, space: Space, k: int,
                probes: dict[int, np.ndarray] | None = None) -> DataFrame:
    """Top-k of every query over `corpus(id, emb[, list_id])`; lists restrict who is compared."""
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast((ids, space, probes))

    def run(batches):
        qids, local_space, lists = shared.value
        best = TopK(local_space, k)
        for batch in full_batches(batches):
            if batch.num_rows == 0:
                continue
            row_ids = batch.column("id").to_numpy(zero_copy_only=False)
            x = local_space.load(batch.column("emb"))
            if lists is None:
                best.add(row_ids, x)
                continue
            list_ids = batch.column("list_id").to_numpy(zero_copy_only=False)
            for list_id in np.unique(list_ids):
                subset = lists.get(int(list_id))
                if subset is not None:
                    inside = list_ids == list_id
                    best.add(row_ids[inside], x[inside], subset)
        qi, found, dist = best.rows()
        part = TaskContext.get().partitionId() % MERGE_WIDTH
        missing = ~np.isfinite(dist)
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids[qi]), pa.array(found), pa.array(dist, mask=missing),
             pa.array(np.full(len(qi), part, np.int32))],
            names=["qid", "id", "dist", "part"],
        )

    columns = ["id", "emb"] + (["list_id"] if probes is not None else [])
    rows = corpus.filter(F.col("emb").isNotNull()).select(*columns)
    return merge_top_k(rows.mapInArrow(run, PARTIAL), k)


def rank_within(keys: list[str], by: str = "dist", tie: str = "id") -> Column:
    """Rank of an answer within its query: best distance first, ties by id, missing last."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(by).asc_nulls_last(), F.col(tie)))


def merge_top_k(partial: DataFrame, k: int) -> DataFrame:
    """Best k of the per-task answers, in two steps so that no query's answers from all tasks meet in one task."""
    partial = partial.withColumn("rank", rank_within(["qid", "part"])).filter(F.col("rank") <= k).drop("rank")
    return (partial.withColumn("rank", rank_within(["qid"])).filter(F.col("rank") <= k)
            .select("qid", "id", "dist", "rank"))


def top_k(queries: DataFrame, corpus: DataFrame, k: int = 100, metric: str = "L2",
          where: Column | None = None) -> DataFrame:
    """Exact k nearest rows of `corpus(id, emb)` for every row of `queries(qid, emb)`.

    `where` is applied to the corpus before the search, so k answers come back whenever that
    many rows pass. HAMMING and JACCARD take packed byte codes. A query set above the broadcast
    limit is searched as a grid of query and corpus blocks.
    """
    name = metric_of(metric).name
    rows = corpus if where is None else corpus.filter(where)
    return over_query_blocks(queries.select("qid", "emb"), k,
                             lambda block: scan_corpus(rows, block.ids, Space(name, block.vectors), k),
                             beyond=lambda asked: grid_top_k(asked, rows, k, metric))


def top_k_one(vector: list[float], corpus: DataFrame, k: int = 100, metric: str = "L2",
              where: Column | None = None) -> DataFrame:
    """Top-k for a single query vector (id, dist), planned as a take-ordered."""
    m = metric_of(metric)
    rows = corpus if where is None else corpus.filter(where)
    literal = F.array(*[F.lit(float(x)) for x in vector])
    return (rows.select("id", m.distance(F.col("emb"), literal).alias("dist"))
            .orderBy(F.col("dist").asc_nulls_last(), "id").limit(k))


def radius_search(queries: DataFrame, corpus: DataFrame, radius: float, num: int, min_num: int = 0,
                  metric: str = "L2", where: Column | None = None) -> DataFrame:
    """Up to `num` rows within `radius`; `enough` tells whether a query found at least `min_num`."""
    return within_radius(top_k(queries, corpus, num, metric, where), radius, min_num)


def within_radius(answers: DataFrame, radius: float, min_num: int) -> DataFrame:
    near = answers.filter(F.col("dist") <= radius)
    hits = F.count(F.lit(1)).over(Window.partitionBy("qid"))
    return near.withColumn("enough", hits >= min_num)


def candidate_width(k: int, ratio: float, cap: int | None = None) -> int:
    """Candidates of the coarse phase: int(k * ratio), at least k, at most `cap`."""
    width = max(k, int(k * ratio))
    return width if cap is None else max(k, min(cap, width))


def rerank(queries: DataFrame, corpus: DataFrame, candidates: DataFrame, k: int, metric: str = "L2",
           max_candidates: int | None = None, partition_keys: tuple[str, ...] = ()) -> DataFrame:
    """Exact distances for `candidates(qid, id)` and the best k of them.

    Candidates are the build side of the join with the corpus while their row bound keeps them
    under the broadcast limit; beyond it both sides are shuffled on id, which is unique.
    `partition_keys` (such as list_id) let the scan skip corpus partitions without candidates.
    """
    m = metric_of(metric)
    wanted = candidates.select("qid", "id", *partition_keys)
    if max_candidates is not None:
        wanted = broadcast_if_small(wanted, max_candidates, 24)
    q = queries.select("qid", F.col("emb").alias("q_emb"))
    pairs = corpus.join(wanted, ["id", *partition_keys]).join(q, "qid")
    scored = pairs.select("qid", "id", m.distance(F.col("q_emb"), F.col("emb")).alias("dist"))
    return (scored.withColumn("rank", rank_within(["qid"])).filter(F.col("rank") <= k)
            .select("qid", "id", "dist", "rank"))


def two_phase(queries: DataFrame, coarse_queries: DataFrame, corpus: DataFrame, k: int, width: int,
              coarse_scan: Callable[[QueryBlock], DataFrame], metric: str = "L2") -> DataFrame:
    """`width` candidates per query from `coarse_scan`, reranked by their full vectors.

    Both phases run per query block, so the candidates to broadcast are bounded by the block.
    """
    def scan(block: QueryBlock) -> DataFrame:
        return rerank(queries, corpus, coarse_scan(block), k, metric, len(block.ids) * width)

    return over_query_blocks(coarse_queries, width, scan)


def answer_lists(answers: DataFrame, k: int | None = None, ids: str = "ids") -> DataFrame:
    """One ordered id list per query; list length is bounded by k."""
    rows = answers if k is None else answers.filter(F.col("rank") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "id")))
    return rows.groupBy("qid").agg(F.transform(ordered, lambda s: s["id"]).alias(ids))


def ground_truth(queries: DataFrame, corpus: DataFrame, k: int = 100, metric: str = "L2",
                 where: Column | None = None) -> DataFrame:
    """(id, neighbors_id): exact neighbours, nearest first, under an optional filter."""
    exact = top_k(queries, corpus, k, metric, where)
    return answer_lists(exact, ids="neighbors_id").withColumnRenamed("qid", "id")


def coded_top_k(queries: DataFrame, codes: DataFrame, k: int, lo: np.ndarray, step: np.ndarray,
                metric: str = "L2") -> DataFrame:
    """Top-k over scalar codes; the scan moves codes and decodes them next to the arithmetic."""
    name = metric_of(metric).name
    return over_query_blocks(
        queries.select("qid", "emb"), k,
        lambda block: scan_corpus(codes, block.ids, Space(name, block.vectors, decode=(lo, step)), k))


def product_tables(vectors: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """Squared distance of every query sub-vector to every code."""
    m, _, width = codebooks.shape
    parts = vectors.reshape(len(vectors), m, 1, width)
    return ((parts - codebooks[None]) ** 2).sum(axis=3)


def product_top_k(queries: DataFrame, codes: DataFrame, codebooks: np.ndarray, k: int,
                  probes_of: Callable[[np.ndarray], dict[int, np.ndarray]] | None = None) -> DataFrame:
    """Top-k over product-quantised rows by per-query distance tables (L2)."""
    _, n_codes, width = codebooks.shape

    def scan(block: QueryBlock) -> DataFrame:
        probes = probes_of(block.vectors) if probes_of else None
        rows = codes if probes is None else codes.filter(F.col("list_id").isin(list(probes)))
        tables = product_tables(block.vectors, codebooks)
        return scan_corpus(rows, block.ids, CodeSpace(tables), k, probes).withColumn("dist", F.sqrt("dist"))

    return over_query_blocks(queries.select("qid", "emb"), k, scan, tables=max(1, n_codes // width + 1))
