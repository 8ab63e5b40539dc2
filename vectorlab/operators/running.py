"""Running values over an ordered sequence per group, safe for one group with most of the rows.

Rows are range-partitioned by (group, order), so a large group spans many partitions. Each
partition works on its own chunk; a small table with one row per group and chunk carries the
value from chunk to chunk. The chunked table is written first, because chunk numbers must not
change if a task is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

CHUNK, PLACE = "_chunk", "_place"


def chunked(df: DataFrame, keys: list[str], order: list[str], place: str | None = None) -> DataFrame:
    """The table by ranges, each with its number; `place` gets numbers that grow within a range."""
    ranged = df.repartitionByRange(*keys, *order) if keys or order else df
    ranged = ranged.withColumn(CHUNK, F.spark_partition_id())
    return materialise(ranged.withColumn(place, F.monotonically_increasing_id()) if place else ranged, "chunks")


def _within(keys: list[str], order: list[str | Column]) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def _across(keys: list[str]) -> Window:
    # one row per group and chunk, so this window is at most as long as the number of chunks
    return Window.partitionBy(*keys).orderBy(CHUNK)


def _with_carry(chunks: DataFrame, keys: list[str], per_chunk: Column, carried: Column) -> DataFrame:
    totals = chunks.groupBy(*keys, CHUNK).agg(per_chunk.alias("_part"))
    carry = totals.withColumn("_carry", carried).drop("_part")
    return chunks.join(carry, [*keys, CHUNK])


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Cumulative sum up to and including each row."""
    across = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = _with_carry(chunked(df, keys, order), keys, F.sum(value), F.sum("_part").over(across))
    here = F.sum(value).over(_within(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, here + F.coalesce("_carry", F.lit(0))).drop(CHUNK, "_carry")


def max_of_later(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Largest value after each row; null on the last one.

    Chunks and rows are taken from the last to the first: a frame that begins with its window is
    carried from row to row, one that ends with it would be gone over again for every row. Rows
    of one position keep the order in which their chunk was written.
    """
    backwards = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    rows = _with_carry(chunked(df, keys, order, PLACE), keys, F.max(value), F.max("_part").over(backwards))
    before = _within(keys, [F.desc(c) for c in [*order, PLACE]]).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.greatest(F.max(value).over(before), "_carry")).drop(CHUNK, PLACE, "_carry")


def last_known(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Latest non-null value up to and including each row."""
    position = F.struct(*order)
    newest = F.max_by(value, F.when(F.col(value).isNotNull(), position))
    across = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = _with_carry(chunked(df, keys, order), keys, newest, F.last("_part", ignorenulls=True).over(across))
    here = F.last(value, ignorenulls=True).over(_within(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, F.coalesce(here, "_carry")).drop(CHUNK, "_carry")


def previous(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Value of the row before; null on the first one."""
    boxed = F.struct(F.col(value).alias("v"))
    across = _across(keys)
    rows = _with_carry(chunked(df, keys, order), keys, F.max_by(boxed, F.struct(*order)), F.lag("_part").over(across))
    before = F.coalesce(F.lag(boxed).over(_within(keys, order)), F.col("_carry"))
    return rows.withColumn(out, before["v"]).drop(CHUNK, "_carry")
