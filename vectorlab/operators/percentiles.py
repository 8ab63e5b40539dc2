"""Exact interpolated percentiles per group by radix selection, without gathering or ordering a group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, materialise

DIGIT = 16
#: Ranges with at most this many rows are looked through as a list.
FEW = 4096
LOW = np.int64(0x7FFFFFFFFFFFFFFF)


@F.arrow_udf(T.LongType())
def _order(values: pa.Array) -> pa.Array:
    """The bits of doubles as integers in the order of the doubles; -0.0 counts as 0.0."""
    bits = (values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0).view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ LOW, bits))


@F.arrow_udf(T.DoubleType())
def _value(codes: pa.Array) -> pa.Array:
    bits = codes.to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.array(np.where(bits < 0, bits ^ LOW, bits).view(np.float64))


def _other(df: DataFrame, keys: list[str], *rest: str) -> DataFrame:
    """Key and range columns under other names, for a join on them."""
    return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("range").alias("_range"), *rest)


def _same(keys: list[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return same


def _found(entries: Column, rank: Column) -> Column:
    """(code, before, n) of the entry of an ordered list of (code, n) that holds a rank, counted from the list's start."""
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(None).cast("bigint").alias("code"), F.lit(0).cast("bigint").alias("n"))

    def step(acc, e):
        here = acc["code"].isNull() & (acc["upto"] + e["n"] > rank)
        return F.when(acc["code"].isNotNull(), acc).when(here, F.struct(acc["upto"].alias("upto"), e["code"].alias("code"), e["n"].alias("n"))).otherwise(
            F.struct((acc["upto"] + e["n"]).alias("upto"), F.lit(None).cast("bigint").alias("code"), F.lit(0).cast("bigint").alias("n")))

    return F.aggregate(entries, start, step)


def _refined(rows: DataFrame, targets: DataFrame, keys: list[str], shift: int | None, child: Column, brackets: int) -> DataFrame:
    """Targets narrowed to the child code that holds their rank. `shift` makes a row's code that of its range, None for all."""
    held = broadcast_if_small(_other(targets.select(*keys, "range").distinct(), keys), brackets, 64 * (len(keys) + 1))
    inside = F.lit(True) if shift is None else F.shiftright("_code", shift) == F.col("_range")
    met = rows.join(held, _same(keys) & inside)
    counts = met.groupBy(*keys, F.col("_range").alias("range"), child.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    lists = counts.groupBy(*keys, "range").agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("entries"))  # at most 2^DIGIT or FEW
    joined = targets.join(_other(lists, keys, "entries"), _same(keys) & (F.col("range") == F.col("_range")))
    found = joined.withColumn("_f", _found(F.col("entries"), F.col("rank") - F.col("before")))
    return found.select(*keys, "total", "rank", F.col("_f.code").alias("range"), (F.col("before") + F.col("_f.upto")).alias("before"), F.col("_f.n").alias("n"))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, levels: list[float]) -> DataFrame:
    """(keys, level, n, percentile) with linear interpolation between order statistics; nulls and NaN are left out.

    Doubles are turned into integers of the same order. A pass counts, for each range that holds a wanted rank, the
    rows of its 2^16 parts; the counts are added up before the shuffle and say which part holds the rank. Four passes
    at most find the value itself; a range with few rows is looked through at once. So a group of any size costs
    histograms of bounded length, whether its values are all equal or all distinct.
    """
    if not keys:
        whole = exact_percentiles(df.withColumn("_all", F.lit(1)), ["_all"], value, levels)
        return whole.drop("_all")
    number = F.col(value).cast("double")
    rows = materialise(df.filter(number.isNotNull() & ~F.isnan(number)).select(*keys, _order(number).alias("_code")), "ordered")
    sizes = materialise(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total")), "sizes")
    rank_of = [(F.col("total") - 1) * F.lit(float(p)) for p in levels]
    wanted = F.array_distinct(F.array(*[f(r).cast("bigint") for r in rank_of for f in (F.floor, F.ceil)]))
    targets = sizes.select(*keys, "total", F.explode(wanted).alias("rank"), F.lit(0).cast("bigint").alias("range"), F.lit(0).cast("bigint").alias("before"),
                           F.col("total").alias("n"))
    shift = 64
    while True:
        most = targets.agg(F.max("n"), F.count(F.lit(1))).first()
        brackets = most[1]
        if (most[0] or 0) <= FEW or shift == 0:
            break
        above = None if shift == 64 else shift
        shift -= DIGIT
        targets = materialise(_refined(rows, targets, keys, above, F.shiftright("_code", shift), brackets), "ranges")
    if shift:
        targets = _refined(rows, targets, keys, None if shift == 64 else shift, F.col("_code"), brackets)
    values = targets.withColumn("v", _value("range")).groupBy(*keys, "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def picked(p: float, r: Column) -> Column:
        low, high = (F.col("at")[f(r).cast("bigint")] for f in (F.floor, F.ceil))
        return F.struct(F.lit(float(p)).alias("level"), (low + (high - low) * (r - F.floor(r))).alias("percentile"))

    return (values.select(*keys, F.col("total").alias("n"), F.explode(F.array(*[picked(p, r) for p, r in zip(levels, rank_of)])).alias("_p"))
            .select(*keys, "_p.level", "n", "_p.percentile"))


def percentile_columns(df: DataFrame, keys: list[str], value: str, names: dict[str, float]) -> DataFrame:
    """One row per group with a column per named level."""
    long = exact_percentiles(df, keys, value, list(dict.fromkeys(names.values())))
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("level") == p, F.col("percentile"))).alias(name) for name, p in names.items()])
