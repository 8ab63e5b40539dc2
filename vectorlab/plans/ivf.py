"""Inverted-file tables: build by cluster, search the lists nearest to each query.

A table is stored partitioned by `list_id`, so a search reads only probed lists. Rows of a list
are compared where they are scanned and never gathered by list, so a list that holds a third of
the corpus is simply more scan tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import search as S
from ..operators.blocks import Space, TopK, matrix, nearest
from ..operators.quantise import bit_codes, fit_scalar, product_codes, range_arrays, scalar_codes, scalar_steps
from ..session import broadcast_limit, check_broadcast, materialise


@dataclass
class Centroids:
    """Cluster centres in list order; `len(ids) * dim` doubles, bounded by the list count."""

    ids: np.ndarray
    vectors: np.ndarray

    @classmethod
    def from_frame(cls, df: DataFrame) -> "Centroids":
        """From a small `(list_id, emb)` table whose size is checked before it is fetched."""
        size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("emb")).alias("dim")).first()
        if size["n"] * (size["dim"] or 0) * 8 > broadcast_limit(df.sparkSession):
            raise ValueError(f"{size['n']} centroids exceed the broadcast limit; use fewer lists")
        table = df.select(F.col("list_id").cast("bigint").alias("list_id"), "emb").orderBy("list_id").toArrow()
        return cls(table.column("list_id").to_numpy(), matrix(table.column("emb")))

    @classmethod
    def train(cls, corpus: DataFrame, nlist: int, fraction: float = 1.0, seed: int = 7, iterations: int = 20) -> "Centroids":
        """k-means on a training share of the corpus."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        rows = corpus.filter(F.col("emb").isNotNull())
        if fraction < 1.0:
            rows = rows.sample(fraction=fraction, seed=seed)
        points = rows.select(array_to_vector(F.col("emb").cast("array<double>")).alias("features"))
        centers = np.array(KMeans(k=nlist, seed=seed, maxIter=iterations).fit(points).clusterCenters())
        return cls(np.arange(len(centers), dtype=np.int64), centers)


def assign(corpus: DataFrame, centroids: Centroids, residuals: bool = False) -> DataFrame:
    """Adds `list_id`, the nearest centroid by L2 (ties to the lower list).

    With `residuals` also adds `residual`, the vector minus its centroid.
    """
    spark = corpus.sparkSession
    check_broadcast(spark, centroids.vectors.nbytes, "centroids")
    shared = spark.sparkContext.broadcast(centroids)
    names = corpus.columns

    def run(batches):
        for batch in batches:
            c = shared.value
            x = matrix(batch.column("emb"))
            place = nearest(c.vectors, x) if len(x) else np.zeros(0, np.int64)
            columns = [batch.column(i) for i in range(len(names))] + [pa.array(c.ids[place])]
            out = names + ["list_id"]
            if residuals:
                rest = x - c.vectors[place] if len(x) else np.zeros((0, 1))
                offsets = pa.array((np.arange(len(x) + 1) * rest.shape[1]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(rest.ravel())))
                out = out + ["residual"]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in corpus.schema)
    extra = ", list_id bigint" + (", residual array<double>" if residuals else "")
    return corpus.filter(F.col("emb").isNotNull()).mapInArrow(run, fields + extra)


def write_lists(assigned: DataFrame, path: str, by: str = "list_id") -> DataFrame:
    """Store a table partitioned by list.

    The rebalance hint groups rows of a list and lets the planner split a large list over many
    tasks, so no writer gets a whole hot list.
    """
    assigned.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    return assigned.sparkSession.read.parquet(path).select(*assigned.columns)


def probe_lists(queries: DataFrame, centroids: Centroids, nprobe: int) -> DataFrame:
    """(qid, list_id, dist, rank): the `nprobe` nearest lists of each query."""
    spark = queries.sparkSession
    centres = spark.createDataFrame(
        [(int(i), v.tolist()) for i, v in zip(centroids.ids, centroids.vectors)], "id bigint, emb array<double>")
    return S.top_k(queries, centres, nprobe).withColumnRenamed("id", "list_id")


def _probe_table(q: np.ndarray, centroids: Centroids, nprobe: int) -> dict[int, np.ndarray]:
    """Query positions per probed list, for one query block."""
    best = TopK(Space("L2", q), min(nprobe, len(centroids.ids)))
    best.add(centroids.ids, centroids.vectors)
    position, lists, _ = best.rows()
    return {int(l): position[lists == l] for l in np.unique(lists)}


def ivf_top_k(queries: DataFrame, lists: DataFrame, centroids: Centroids, k: int, nprobe: int,
              metric: str = "L2", decode: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Top-k over `lists(id, emb, list_id)` restricted to the `nprobe` lists nearest each query.

    With `decode` the `emb` column holds scalar codes.
    """
    name = S.metric_of(metric).name

    def scan(block: S.QueryBlock) -> DataFrame:
        probes = _probe_table(block.vectors, centroids, nprobe)
        wanted = lists.filter(F.col("list_id").isin(list(probes)))
        return S.scan_corpus(wanted, block.ids, Space(name, block.vectors, decode), k, probes)

    return S.over_query_blocks(queries.select("qid", "emb"), k, scan)


@dataclass
class ScalarLists:
    """Scalar codes stored by list, and what turns them back into vectors."""

    table: DataFrame
    decode: tuple[np.ndarray, np.ndarray]


def store_scalar_lists(corpus: DataFrame, centroids: Centroids, path: str, bits: int = 8) -> ScalarLists:
    """Encode a corpus once, in lists: (id, emb, list_id) with codes for `emb`."""
    lo, hi = range_arrays(fit_scalar(corpus))
    coded = scalar_codes(assign(corpus.select("id", "emb"), centroids), lo, hi, bits, keep=["id", "list_id"])
    return ScalarLists(write_lists(coded, path), (lo, scalar_steps(lo, hi, bits)))


def ivf_scalar_top_k(queries: DataFrame, stored: ScalarLists, centroids: Centroids, k: int, nprobe: int, metric: str = "L2") -> DataFrame:
    """IVF over stored scalar codes: distances are taken to the decoded vectors, and only probed lists are read."""
    return ivf_top_k(queries, stored.table, centroids, k, nprobe, metric, stored.decode)


def store_product_lists(corpus: DataFrame, centroids: Centroids, codebooks: np.ndarray, path: str) -> DataFrame:
    """Encode a corpus once, in lists: (id, emb, list_id) with product codes for `emb`."""
    return write_lists(product_codes(assign(corpus.select("id", "emb"), centroids), codebooks, keep=["id", "list_id"]), path)


def ivf_product_top_k(queries: DataFrame, stored: DataFrame, centroids: Centroids, k: int, nprobe: int,
                      codebooks: np.ndarray) -> DataFrame:
    """IVF over stored product codes with table-lookup distances; only probed lists are read."""
    return S.product_top_k(queries, stored, codebooks, k, lambda q: _probe_table(q, centroids, nprobe))


def residual_codes(corpus: DataFrame, centroids: Centroids) -> DataFrame:
    """(id, emb, list_id, code): sign bits of the vector minus its centroid, packed to bytes."""
    rows = assign(corpus.select("id", "emb"), centroids, residuals=True)
    return bit_codes(rows, keep=["id", "emb", "list_id"], emb="residual", out="code")


def ivf_bit_top_k(queries: DataFrame, coded: DataFrame, centroids: Centroids, k: int, nprobe: int,
                  refine: float, metric: str = "L2") -> DataFrame:
    """IVF over 1-bit residual codes, then exact rerank of `int(k * refine)` candidates.

    A query has one code per probed list, because residuals are taken from that list's centroid.
    Candidates keep their list, so the rerank reads only lists that hold one.
    """
    width = S.candidate_width(k, refine)
    place = {int(l): i for i, l in enumerate(centroids.ids)}

    def probe_codes(batches):
        for batch in batches:
            x = matrix(batch.column("emb"))
            at = np.array([place[int(l)] for l in batch.column("list_id").to_pylist()], np.int64)
            codes = np.packbits(x - centroids.vectors[at] > 0, axis=1).view(np.int8) if len(x) else np.zeros((0, 1), np.int8)
            offsets = pa.array((np.arange(len(x) + 1) * codes.shape[1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("owner"), batch.column("list_id"), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))],
                names=["owner", "list_id", "emb"])

    probes = probe_lists(queries, centroids, nprobe).select("qid", "list_id")
    pairs = probes.join(queries.select("qid", "emb"), "qid").select(F.col("qid").alias("owner"), "list_id", "emb")
    coded_queries = pairs.mapInArrow(probe_codes, "owner bigint, list_id bigint, emb array<tinyint>")
    # block search needs one id per (query, list); the written table keeps those ids fixed
    keyed = materialise(coded_queries.withColumn("qid", F.monotonically_increasing_id()), "probe-codes")

    owners = keyed.select("qid", "owner", "list_id")

    def scan(block: S.QueryBlock) -> DataFrame:
        lists = block.columns["list_id"]
        subsets = {int(l): np.nonzero(lists == l)[0] for l in np.unique(lists)}
        wanted = coded.filter(F.col("list_id").isin(list(subsets))).select("id", F.col("code").alias("emb"), "list_id")
        return S.scan_corpus(wanted, block.ids, Space("HAMMING", block.vectors), width, subsets)

    # a query may be spread over several blocks by its lists, so its candidates are cut once more
    found = S.over_query_blocks(keyed.select("qid", "emb", "list_id"), width, scan)
    best = found.select("qid", "id", "dist").join(owners, "qid").select(F.col("owner").alias("qid"), "id", "dist", "list_id")
    coarse = best.withColumn("rank", S.rank_within(["qid"])).filter(F.col("rank") <= width)
    bound = queries.count() * width
    return S.rerank(queries, coded.select("id", "emb", "list_id"), coarse, k, metric, bound, ("list_id",))


def bit_top_k(queries: DataFrame, corpus: DataFrame, k: int, ratio: float, metric: str = "L2",
              coarse: str = "HAMMING") -> DataFrame:
    """Bit-code search without clusters, then exact rerank by `metric`.

    A stored `code` column is used when the corpus has one, so that the coarse scan reads codes only.
    """
    width = S.candidate_width(k, ratio)
    codes = (corpus.select("id", F.col("code").alias("emb")) if "code" in corpus.columns else bit_codes(corpus))
    return S.two_phase(queries, bit_codes(queries, keep=["qid"]), corpus.select("id", "emb"), k, width,
                       lambda block: S.scan_corpus(codes, block.ids, Space(coarse, block.vectors), width), metric)


def store_scalar_codes(corpus: DataFrame, path: str, bits: int = 8, quantile: float | None = None) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """The corpus with a stored column `code` of scalar codes, and what turns them back into vectors."""
    lo, hi = range_arrays(fit_scalar(corpus, quantile=quantile))
    scalar_codes(corpus, lo, hi, bits, keep=corpus.columns, out="code").write.parquet(path)
    return corpus.sparkSession.read.parquet(path), (lo, scalar_steps(lo, hi, bits))


def scalar_top_k(queries: DataFrame, corpus: DataFrame, k: int, ratio: float, bits: int = 8,
                 quantile: float | None = None, metric: str = "L2", rescore: bool = True,
                 decode: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Search over scalar codes, optionally rescored by the full vectors.

    With `decode` the corpus has a stored `code` column, and the coarse scan reads only that; without, codes are made for this search.
    """
    if decode is None:
        lo, hi = range_arrays(fit_scalar(corpus, quantile=quantile))
        codes, decode = scalar_codes(corpus, lo, hi, bits), (lo, scalar_steps(lo, hi, bits))
    else:
        codes = corpus.select("id", F.col("code").alias("emb"))
    if not rescore:
        return S.coded_top_k(queries, codes, k, *decode, metric)
    width, name = S.candidate_width(k, ratio), S.metric_of(metric).name
    return S.two_phase(queries, queries.select("qid", "emb"), corpus.select("id", "emb"), k, width,
                       lambda block: S.scan_corpus(codes, block.ids, Space(name, block.vectors, decode), width), metric)
