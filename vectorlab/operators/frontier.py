"""Frontier of speed over recall, stage tails and table reuse between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import last_known, max_of_later, previous


def mark_frontier(points: DataFrame, group: list[str], x: str = "recall", y: str = "qps", seq: str = "seq") -> DataFrame:
    """Adds `on_frontier`: no later point in recall order of the group is faster."""
    later = max_of_later(points, group, [x, seq], y, "_later")
    keep = F.col("_later").isNull() | (F.col(y) >= F.col("_later"))
    return later.withColumn("on_frontier", keep).drop("_later")


def split_frontier(points: DataFrame, group: list[str], **names: str) -> tuple[DataFrame, DataFrame]:
    """(frontier, the other points)."""
    marked = mark_frontier(points, group, **names)
    return (marked.filter("on_frontier").drop("on_frontier"),
            marked.filter(~F.col("on_frontier")).drop("on_frontier"))


def last_two_stages(stages: DataFrame, keys: list[str], stage: str = "search_stage") -> DataFrame:
    """The two last stages of each run that ends with an optimised stage (above 100).

    Only a constant number of rows per run is ranked, so a run with many rows is cut by the
    partial group limit before the shuffle.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(stage).desc())
    top = stages.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= 2)
    whole = Window.partitionBy(*keys)
    return (top.withColumn("_max", F.max(stage).over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
            .filter((F.col("_max") > 100) & (F.col("_n") == 2)).drop("_rank", "_max", "_n"))


def carried_load(runs: DataFrame, keys: list[str], order: list[str], fresh: Column, load: str = "load") -> DataFrame:
    """Load duration of each case: its own when loaded afresh, else the last fresh one, else zero."""
    marked = runs.withColumn("_fresh", F.when(fresh, F.col(load)))
    known = last_known(marked, keys, order, "_fresh", "load_duration")
    return known.withColumn("load_duration", F.coalesce("load_duration", F.lit(0.0))).drop("_fresh")


def reuses_previous(runs: DataFrame, keys: list[str], order: list[str], same: list[str]) -> DataFrame:
    """Adds `reused`: the case before it used the same backend, index settings and dataset."""
    setup = runs.withColumn("_setup", F.struct(*same))
    before = previous(setup, keys, order, "_setup", "_before")
    return before.withColumn("reused", F.coalesce(F.col("_setup") == F.col("_before"), F.lit(False))).drop("_setup", "_before")
