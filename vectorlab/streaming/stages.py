"""Rates, stages and time budgets of a streaming run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round4
from ..operators.running import running_sum

AFTER_INSERT, AFTER_OPTIMISE = 100, 110


def rate_in_batches(rate: Column, batch: Column | int) -> Column:
    """Insert rate as a multiple of the batch size, at least one batch."""
    size = batch if isinstance(batch, Column) else F.lit(batch)
    return F.greatest(size, (F.floor(rate / size) * size).cast("bigint"))


def sorted_stages(stages: Iterable[float]) -> list[float]:
    """Search stages in order; each must lie in [0, 1)."""
    ordered = sorted(stages)
    for s in ordered:
        if not 0.0 <= s < 1.0:
            raise ValueError(f"search stage {s} is not in [0, 1)")
    return ordered


def stages_valid(stages: Column) -> Column:
    return F.forall(stages, lambda s: (s >= 0.0) & (s < 1.0))


def ideal_duration(size: Column, rate: Column) -> Column:
    return F.ceil(size / rate).cast("bigint")


def total_batches(size: int, rate: int) -> int:
    return -(-size // rate)


def target_batch(total: Column, stage: Column) -> Column:
    """Batches after which a stage starts; truncated like its percent."""
    return (total * stage).cast("bigint")


def search_time(at: Column, start: Column) -> Column:
    return round4(at - start)


def stage_budgets(stages: DataFrame, keys: list[str], size: Column, rate: Column, levels: Column) -> DataFrame:
    """Adds `budget`: seconds per concurrency level between a stage and the next.

    `stages` has `stage` and `serial_seconds`; the last stage ends at 1.0. A run has at most a
    hundred stages, so the window per run is bounded.
    """
    following = F.lead("stage", 1, 1.0).over(Window.partitionBy(*keys).orderBy("stage"))
    between = F.floor(size * (following - F.col("stage")) / rate)
    left = between - F.col("serial_seconds")
    usable = F.when(left > 60, left - 30).when(left > 30, left - 15).otherwise(left / 2)
    return stages.withColumn("budget", round4(usable / levels))


def cumulative_progress(progress: DataFrame, keys: list[str], order: list[str], rows: str = "rows") -> DataFrame:
    """Adds `total_rows`: rows inserted up to and including each batch."""
    return running_sum(progress, keys, order, rows, "total_rows")


def first_reaching(progress: DataFrame, targets: DataFrame, batch: str = "batch_id") -> DataFrame:
    """(stage, target_rows, first batch whose running total reaches the target).

    `progress` has `total_rows`. There are few stages, so each is one conditional minimum over
    the progress table, and nothing is joined.
    """
    wanted = targets.select("stage", "target_rows").collect()
    mins = [F.min(F.when(F.col("total_rows") >= r["target_rows"], F.col(batch))).alias(f"s{i}")
            for i, r in enumerate(wanted)]
    row = progress.agg(*mins)
    entries = [F.struct(F.lit(r["stage"]).alias("stage"), F.lit(r["target_rows"]).alias("target_rows"),
                        F.col(f"s{i}").alias(batch)) for i, r in enumerate(wanted)]
    return row.select(F.explode(F.array(*entries)).alias("s")).select("s.*")


def rows_per_second(progress: DataFrame, done: str = "done_ts", rows: str = "rows", late: str | None = None) -> DataFrame:
    """Rows finished in each second; `late` adds a watermark when progress is a stream."""
    source = progress.withWatermark(done, late) if late else progress
    return (source.groupBy(F.window(done, "1 second").alias("w")).agg(F.sum(rows).alias("rows"))
            .select(F.col("w.start").alias("second"), "rows"))
