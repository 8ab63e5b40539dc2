"""Scalar and product quantisation: fit over the whole corpus, encode in batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import check_broadcast, materialise
from .blocks import matrix, nearest
from .running import running_sum
from .vectors import dimension_range

BINS = 4096


def fit_scalar(df: DataFrame, emb: str = "emb", quantile: float | None = None) -> DataFrame:
    """(dim, lo, hi): coding range per dimension, optionally clipped to the central quantile."""
    if quantile is None:
        return dimension_range(df, emb)
    tail = (1.0 - quantile) / 2.0
    wide = dimension_quantiles(df, emb, [tail, 1.0 - tail])
    return wide.groupBy("dim").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def dimension_quantiles(df: DataFrame, emb: str, levels: list[float]) -> DataFrame:
    """(dim, level, value): exact interpolated quantiles per dimension.

    Tasks count their components in equal bins per dimension, the merged counts tell which bins
    hold the wanted order statistics, and a second scan returns only the values of those bins,
    counted per task. No dimension is ever gathered whole.
    """
    spark = df.sparkSession
    ranges = dimension_range(df, emb).orderBy("dim").toPandas()
    lo, hi = ranges["lo"].to_numpy(), ranges["hi"].to_numpy()
    width = np.where(hi > lo, (hi - lo) / BINS, 1.0)
    shape = spark.sparkContext.broadcast((lo, width))

    def bins_of(x):
        low, step = shape.value
        return np.clip(((x - low) / step).astype(np.int64), 0, BINS - 1)

    def histogram(batches):
        total = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            b = bins_of(matrix(batch.column(0)))
            flat = np.bincount((b + np.arange(b.shape[1]) * BINS).ravel(), minlength=b.shape[1] * BINS)
            total = flat if total is None else total + flat
        if total is not None:
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array((at // BINS).astype(np.int32)), pa.array((at % BINS).astype(np.int32)), pa.array(total[at])],
                names=["dim", "bin", "n"])

    vectors = df.filter(F.col(emb).isNotNull()).select(emb)
    counts = (vectors.mapInArrow(histogram, "dim int, bin int, n bigint")
              .groupBy("dim", "bin").agg(F.sum("n").alias("n")))
    by_dim = Window.partitionBy("dim")
    upto = (counts.withColumn("upto", F.sum("n").over(by_dim.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("total", F.sum("n").over(by_dim)))
    ranks = upto.withColumn("level", F.explode(F.array(*[F.lit(float(p)) for p in levels])))
    position = (F.col("total") - 1) * F.col("level")
    before = F.col("upto") - F.col("n")
    hit = ((before <= F.floor(position)) & (F.floor(position) < F.col("upto"))
           | (before <= F.ceil(position)) & (F.ceil(position) < F.col("upto")))
    # at most two bins per level and dimension
    wanted = ranks.filter(hit).select("dim", "bin", "level", position.alias("rank"), before.alias("before")).toPandas()
    mask = np.zeros((len(lo), BINS), bool)
    mask[wanted["dim"], wanted["bin"]] = True
    chosen = spark.sparkContext.broadcast(mask)

    def values(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column(0))
            b = bins_of(x)
            row, dim = np.nonzero(chosen.value[np.arange(x.shape[1]), b])
            pairs, n = np.unique(np.stack([dim.astype(np.float64), x[row, dim]]), axis=1, return_counts=True)
            d = pairs[0].astype(np.int64)
            bins = np.clip(((pairs[1] - lo[d]) / width[d]).astype(np.int64), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d.astype(np.int32)), pa.array(bins.astype(np.int32)), pa.array(pairs[1]), pa.array(n)],
                names=["dim", "bin", "v", "n"])

    inside = (vectors.mapInArrow(values, "dim int, bin int, v double, n bigint")
              .groupBy("dim", "bin", "v").agg(F.sum("n").alias("n")))
    # a far outlier can push most of a dimension into one bin, so the bin is summed in chunks
    placed = running_sum(inside, ["dim", "bin"], ["v"], "n", "upto")
    if not len(wanted):
        return spark.createDataFrame([], "dim int, level double, value double")
    targets = spark.createDataFrame(wanted)
    joined = placed.join(targets, ["dim", "bin"])
    end = F.col("before") + F.col("upto")
    start = end - F.col("n")

    def at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < end), F.col("v")))

    picked = joined.groupBy("dim", "level", "rank").agg(
        at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b"))
    return picked.select(F.col("dim").cast("int").alias("dim"), "level",
                         (F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))).alias("value"))


def range_arrays(params: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Coding ranges as arrays; one row per dimension, so their size is the vector length."""
    table = params.orderBy("dim").toPandas()
    return table["lo"].to_numpy(np.float64), table["hi"].to_numpy(np.float64)


def map_vectors(df: DataFrame, change: Callable[[np.ndarray], np.ndarray], element: str,
                keep: list[str] | None = None, emb: str = "emb", out: str = "emb") -> DataFrame:
    """`keep` columns plus `out`: the batch function `change` applied to the rows of `emb`."""
    columns = ["id"] if keep is None else keep

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            y = np.ascontiguousarray(change(matrix(batch.column("_v"))))
            offsets = pa.array((np.arange(len(y) + 1) * y.shape[1]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [lists], names=columns + [out])

    rows = df.filter(F.col(emb).isNotNull()).select(*columns, F.col(emb).alias("_v"))
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in columns)
    return rows.mapInArrow(run, f"{fields}`{out}` array<{element}>")


def bit_codes(df: DataFrame, keep: list[str] | None = None, emb: str = "emb", out: str = "emb") -> DataFrame:
    """Sign bits packed to bytes, high bit first, for whole batches."""
    return map_vectors(df, lambda x: np.packbits(x > 0, axis=1).view(np.int8), "tinyint", keep, emb, out)


def scalar_steps(lo: np.ndarray, hi: np.ndarray, bits: int = 8) -> np.ndarray:
    return np.where(hi > lo, hi - lo, 1.0) / float(2**bits - 1)


def scalar_codes(df: DataFrame, lo: np.ndarray, hi: np.ndarray, bits: int = 8, keep: list[str] | None = None,
                 emb: str = "emb", out: str = "emb") -> DataFrame:
    """Codes 0 .. 2^bits-1 per component; values outside the range take the end codes."""
    top, step = 2**bits - 1, scalar_steps(lo, hi, bits)
    return map_vectors(df, lambda x: np.clip(np.floor((x - lo) / step + 0.5), 0, top).astype(np.int16),
                       "smallint", keep, emb, out)


def decode_scalar(codes: Column, lo: np.ndarray, step: np.ndarray) -> Column:
    lows = F.array(*[F.lit(float(v)) for v in lo])
    steps = F.array(*[F.lit(float(v)) for v in step])
    return F.zip_with(F.zip_with(codes.cast("array<double>"), steps, lambda c, s: c * s), lows, lambda a, b: a + b)


def first_codebooks(df: DataFrame, m: int, codes: int, emb: str = "emb", by: str = "id", seed: int = 7) -> np.ndarray:
    """(m, codes, dim/m) from the rows whose `by` has the smallest SHA-256 of `seed:by`; too few rows are repeated."""
    rows = df.filter(F.col(emb).isNotNull()).select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(by).cast("string")), 256).alias("_h"), F.col(emb).alias("_v"))
    x = matrix(rows.orderBy("_h", "_v").limit(codes).select("_v").toArrow().column(0))
    if not len(x):
        raise ValueError("no rows to train on")
    if x.shape[1] % m:
        raise ValueError(f"{m} sub-vectors do not divide {x.shape[1]} dimensions")
    x = np.vstack([x, np.repeat(x[:1], codes - len(x), axis=0)])
    return np.ascontiguousarray(x.reshape(codes, m, -1).transpose(1, 0, 2))


def codebook_sums(df: DataFrame, books: np.ndarray, emb: str = "emb") -> DataFrame:
    """(s, code, n, total): rows and component sums of every code of every sub-space, in one scan.

    A task adds up its rows and sends at most one row per sub-space and code.
    """
    m, codes, width = books.shape
    shared = df.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        n, total = np.zeros((m, codes), np.int64), np.zeros((m, codes, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0)).reshape(batch.num_rows, m, width)
            for s, book in enumerate(shared.value):
                code = nearest(book, x[:, s])
                n[s] += np.bincount(code, minlength=codes)
                for d in range(width):
                    total[s, :, d] += np.bincount(code, x[:, s, d], minlength=codes)
        s, code = np.nonzero(n)
        offsets = pa.array((np.arange(len(s) + 1) * width).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(n[s, code]), pa.ListArray.from_arrays(offsets, pa.array(total[s, code].ravel()))],
            ["s", "code", "n", "total"])

    parts = df.filter(F.col(emb).isNotNull()).select(emb).mapInArrow(run, "s int, code int, n bigint, total array<double>")
    return parts.groupBy("s", "code").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(width)]).alias("total"))


def fit_codebooks(df: DataFrame, m: int, nbits: int = 8, emb: str = "emb", fraction: float = 1.0, seed: int = 7,
                  iterations: int = 10, by: str = "id") -> np.ndarray:
    """(m, 2^nbits, dim/m) codebooks by k-means steps in all sub-spaces at once on a training share of the corpus.

    Every iteration is one scan and one aggregate whose size is that of the codebooks. The first codes are rows chosen
    by rule, a code without rows keeps its place, and the steps end when nothing moves. A share is written once.
    """
    train = df.select(by, emb)
    if fraction < 1.0:
        train = materialise(train.sample(fraction=fraction, seed=seed), "training-share")
    books = first_codebooks(train, m, 2**nbits, emb, by, seed)
    check_broadcast(df.sparkSession, 2 * books.nbytes, "codebooks")
    for _ in range(iterations):
        table = codebook_sums(train, books, emb).toArrow()  # no more rows than codes
        s, code, n = (table.column(c).to_numpy() for c in ("s", "code", "n"))
        moved = books.copy()
        if len(s):
            moved[s, code] = matrix(table.column("total")) / n[:, None]
        if np.array_equal(moved, books):
            break
        books = moved
    return books


def product_codes(df: DataFrame, codebooks: np.ndarray, keep: list[str] | None = None, emb: str = "emb",
                  out: str = "emb") -> DataFrame:
    """The code of each sub-vector: its nearest centre, ties to the lower code. At most 2^15 centres, as codes are 16-bit."""
    if codebooks.shape[1] > 1 << 15:
        raise ValueError(f"{codebooks.shape[1]} centres do not fit a 16-bit code")
    check_broadcast(df.sparkSession, codebooks.nbytes, "codebooks")
    shared = df.sparkSession.sparkContext.broadcast(codebooks)

    def encode(x: np.ndarray) -> np.ndarray:
        books = shared.value
        width = books.shape[2]
        codes = [nearest(book, x[:, s * width : (s + 1) * width]) for s, book in enumerate(books)]
        return np.stack(codes, axis=1).astype(np.int16)

    return map_vectors(df, encode, "smallint", keep, emb, out)
