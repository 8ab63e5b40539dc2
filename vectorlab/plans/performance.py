"""Performance cases: any search method, one call, one metric row."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round4
from ..operators import search as S
from ..operators.filters import NoFilter
from ..operators.querylog import per_query_scores, run_scores
from ..operators.quantise import bit_codes, fit_codebooks, product_codes
from ..session import scratch_path
from . import ivf


class Searcher(Protocol):
    """A search method: builds its table from a corpus and answers a query set."""

    def build(self, corpus: DataFrame) -> DataFrame: ...

    def search(self, queries: DataFrame, table: DataFrame, k: int, metric: str, where: Column | None) -> DataFrame: ...


@dataclass
class Flat:
    """Exact search over the corpus as it is."""

    def build(self, corpus: DataFrame) -> DataFrame:
        return corpus

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        return S.top_k(queries, table, k, metric, where)


@dataclass
class BitCodes:
    """Bit codes with exact rerank of `int(k * ratio)` candidates; codes are stored with the rows."""

    ratio: float = 10.0
    coarse: str = "HAMMING"

    def build(self, corpus: DataFrame) -> DataFrame:
        path = scratch_path(corpus.sparkSession, "bits")
        bit_codes(corpus, keep=corpus.columns, out="code").write.parquet(path)
        return corpus.sparkSession.read.parquet(path)

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        rows = table if where is None else table.filter(where)
        return ivf.bit_top_k(queries, rows, k, self.ratio, metric, self.coarse)


@dataclass
class ScalarCodes:
    """8- or 6-bit scalar codes, stored with the rows, optionally rescored."""

    ratio: float = 3.0
    bits: int = 8
    quantile: float | None = None
    rescore: bool = True
    decode: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def build(self, corpus: DataFrame) -> DataFrame:
        table, self.decode = ivf.store_scalar_codes(corpus, scratch_path(corpus.sparkSession, "scalar"), self.bits, self.quantile)
        return table

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        rows = table if where is None else table.filter(where)
        return ivf.scalar_top_k(queries, rows, k, self.ratio, self.bits, self.quantile, metric, self.rescore, self.decode)


@dataclass
class ProductCodes:
    """Product codes with table-lookup distances (L2)."""

    m: int = 8
    nbits: int = 8
    fraction: float = 1.0
    codebooks: np.ndarray | None = field(default=None, repr=False)

    def build(self, corpus: DataFrame) -> DataFrame:
        self.codebooks = fit_codebooks(corpus, self.m, self.nbits, fraction=self.fraction)
        keep = [c for c in corpus.columns if c != "emb"]
        path = scratch_path(corpus.sparkSession, "pq")
        product_codes(corpus, self.codebooks, keep).write.parquet(path)
        return corpus.sparkSession.read.parquet(path)

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        if S.metric_of(metric).name != "L2":
            raise ValueError("product codes search under L2; normalise first for other metrics")
        rows = table if where is None else table.filter(where)
        return S.product_top_k(queries, rows, self.codebooks, k)


@dataclass
class InvertedFile:
    """IVF: `nlist` clusters trained on a share of the corpus, `nprobe` lists per query."""

    nlist: int = 16
    nprobe: int = 4
    fraction: float = 1.0
    centroids: ivf.Centroids | None = field(default=None, repr=False)

    def build(self, corpus: DataFrame) -> DataFrame:
        if self.centroids is None:
            self.centroids = ivf.Centroids.train(corpus, self.nlist, self.fraction)
        return ivf.write_lists(ivf.assign(corpus, self.centroids), scratch_path(corpus.sparkSession, "lists"))

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        rows = table if where is None else table.filter(where)
        return ivf.ivf_top_k(queries, rows, self.centroids, k, self.nprobe, metric)


@dataclass
class InvertedScalarCodes:
    """IVF over scalar codes that are stored by list."""

    nlist: int = 16
    nprobe: int = 4
    bits: int = 8
    fraction: float = 1.0
    centroids: ivf.Centroids | None = field(default=None, repr=False)
    decode: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def build(self, corpus: DataFrame) -> DataFrame:
        if self.centroids is None:
            self.centroids = ivf.Centroids.train(corpus, self.nlist, self.fraction)
        stored = ivf.store_scalar_lists(corpus, self.centroids, scratch_path(corpus.sparkSession, "scalar-lists"), self.bits)
        self.decode = stored.decode
        return stored.table

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        rows = table if where is None else table.filter(where)
        return ivf.ivf_scalar_top_k(queries, ivf.ScalarLists(rows, self.decode), self.centroids, k, self.nprobe, metric)


@dataclass
class InvertedProductCodes:
    """IVF over product codes that are stored by list (L2)."""

    nlist: int = 16
    nprobe: int = 4
    m: int = 8
    nbits: int = 8
    fraction: float = 1.0
    centroids: ivf.Centroids | None = field(default=None, repr=False)
    codebooks: np.ndarray | None = field(default=None, repr=False)

    def build(self, corpus: DataFrame) -> DataFrame:
        if self.centroids is None:
            self.centroids = ivf.Centroids.train(corpus, self.nlist, self.fraction)
        if self.codebooks is None:
            self.codebooks = fit_codebooks(corpus, self.m, self.nbits, fraction=self.fraction)
        return ivf.store_product_lists(corpus, self.centroids, self.codebooks, scratch_path(corpus.sparkSession, "product-lists"))

    def search(self, queries, table, k, metric, where=None) -> DataFrame:
        if S.metric_of(metric).name != "L2":
            raise ValueError("product codes search under L2; normalise first for other metrics")
        rows = table if where is None else table.filter(where)
        return ivf.ivf_product_top_k(queries, rows, self.centroids, k, self.nprobe, self.codebooks)


def run_case(searcher: Searcher, corpus: DataFrame, queries: DataFrame, truth: DataFrame | None = None, k: int = 100,
             metric: str = "L2", filters=NoFilter()) -> DataFrame:
    """Load, build, search and score one case: a single metric row.

    Throughput is that of the batch: queries over the seconds of the search job.
    """
    spark = corpus.sparkSession
    where = None if isinstance(filters, NoFilter) else filters.predicate()
    begin = time.time()
    table = searcher.build(corpus)
    loaded = table.count()
    built = time.time()
    path = scratch_path(spark, "answers")
    S.answer_lists(searcher.search(queries, table, k, metric, where)).write.parquet(path)
    searched = time.time()
    exact = truth if truth is not None else S.ground_truth(queries, corpus, k, metric, where)
    scores = run_scores(per_query_scores(spark.read.parquet(path), exact, k))
    n = queries.count()
    return scores.select(
        F.lit(type(searcher).__name__).alias("searcher"), F.lit(metric).alias("metric"), F.lit(filters.rate).alias("filter_rate"),
        F.lit(k).alias("k"), F.lit(loaded).alias("loaded_rows"), F.lit(n).alias("queries"),
        round4(F.lit(built - begin)).alias("load_duration"), round4(F.lit(n / (searched - built))).alias("qps"),
        "recall", "ndcg")


def sweep(searchers: list[Searcher], corpus: DataFrame, queries: DataFrame, k: int = 100, metric: str = "L2") -> DataFrame:
    """One metric row per setting against one shared ground truth."""
    from ..session import materialise

    truth = materialise(S.ground_truth(queries, corpus, k, metric), "truth")
    rows = [run_case(s, corpus, queries, truth, k, metric).withColumn("seq", F.lit(i)).withColumn("setting", F.lit(repr(s)))
            for i, s in enumerate(searchers)]
    result = rows[0]
    for r in rows[1:]:
        result = result.unionByName(r)
    return result
