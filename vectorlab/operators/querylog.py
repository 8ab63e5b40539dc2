"""Scores of answers and of query logs: quality, latency, throughput and failures.

A log has one row per request: (conc, qid, start, latency, ok), optionally a recall column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round4
from ..functions.scoring import recall_at, set_ndcg_at
from .percentiles import percentile_columns


def per_query_scores(answers: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """(qid, recall, ndcg) of every query in `truth(id, neighbors_id)`; one without a row in `answers(qid, ids)` scores 0."""
    t = truth.select(F.col("id").alias("qid"), F.col("neighbors_id").alias("truth"))
    none = F.array().cast(answers.schema["ids"].dataType)
    return t.join(answers, "qid", "left").withColumn("ids", F.coalesce("ids", none)).select(
        "qid", recall_at(F.col("truth"), F.col("ids"), k).alias("recall"),
        set_ndcg_at(F.col("truth"), F.col("ids"), k).alias("ndcg"))


def run_scores(scores: DataFrame) -> DataFrame:
    """Average recall and NDCG of a run; zero when there was nothing to compare.

    The last digits of a distributed sum depend on the order of its parts, so they are cut
    before the four-digit rounding; otherwise a tie could round either way from run to run.
    """
    def mean(name: str) -> Column:
        return round4(F.round(F.coalesce(F.avg(name), F.lit(0.0)), 12)).alias(name)

    return scores.agg(mean("recall"), mean("ndcg"))


def serial_latency(log: DataFrame) -> DataFrame:
    """Mean, total, p95 and p99 latency of a log, to four decimals."""
    names = {"p95": 0.95, "p99": 0.99}
    totals = log.agg(F.count("latency").alias("n"), F.avg("latency").alias("avg"), F.sum("latency").alias("total"))
    tails = percentile_columns(log, [], "latency", names)
    # two one-row tables put side by side without a join
    both = totals.unionByName(tails, allowMissingColumns=True)
    return both.agg(F.max("n").alias("n"), *[round4(F.max(c)).alias(c) for c in ("avg", "total", *names)])


def latency_by_concurrency(log: DataFrame, levels: DataFrame | None = None, recall: str | None = None) -> DataFrame:
    """Latency tails, mean latency and mean recall per concurrency level.

    Levels without a request get NaN latencies and zero recall.
    """
    mean_recall = F.avg(recall) if recall else F.lit(0.0)
    means = log.groupBy("conc").agg(F.avg("latency").alias("latency_avg"), mean_recall.alias("recall"))
    tails = percentile_columns(log, ["conc"], "latency",
                               {"latency_p99": 0.99, "latency_p95": 0.95, "latency_p90": 0.90})
    scored = means.join(tails, "conc", "left")
    if levels is not None:
        scored = levels.select("conc").join(scored, "conc", "left")
    nan = F.lit(float("nan"))
    return scored.select(
        "conc", *[F.coalesce(c, nan).alias(c) for c in ("latency_p99", "latency_p95", "latency_p90", "latency_avg")],
        F.coalesce("recall", F.lit(0.0)).alias("recall"))


def elapsed(start: str = "start", latency: str = "latency") -> Column:
    """Seconds from the first start to the last end."""
    return F.max(F.col(start) + F.col(latency)) - F.min(start)


def throughput(log: DataFrame, keys: tuple[str, ...] = ("conc",)) -> DataFrame:
    """Requests, elapsed seconds and queries per second per concurrency level."""
    merged = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), elapsed().alias("seconds"))
    qps = F.when(F.col("seconds") > 0, round4(F.col("n") / F.col("seconds"))).otherwise(F.lit(0.0))
    return merged.withColumn("qps", qps)


def max_throughput(per_level: DataFrame) -> DataFrame:
    """Highest QPS and the level that reached it first."""
    best = F.struct("qps", -F.col("conc"))
    return per_level.agg(F.coalesce(F.max("qps"), F.lit(0.0)).alias("max_qps"), F.max_by("conc", best).alias("conc"))


def failures(log: DataFrame) -> DataFrame:
    """Failure rate and QPS of the successes per level."""
    per_level = log.groupBy("conc").agg(
        F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), elapsed().alias("seconds"))
    total = F.col("succeeded") + F.col("failed")
    return per_level.select(
        "conc", "succeeded", "failed", (F.col("failed") / total).alias("failed_rate"),
        F.when(F.col("seconds") > 0, round4(F.col("succeeded") / F.col("seconds"))).otherwise(0.0).alias("qps"))


def run_failures(per_level: DataFrame) -> DataFrame:
    """Best QPS of a run with the failure rate of its last (highest) level."""
    return per_level.agg(F.max("qps").alias("max_qps"), F.max_by("failed_rate", "conc").alias("failed_rate"))


def load_duration(insert: Column, optimise: Column) -> Column:
    return round4(insert + optimise)


def check_loaded(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Row counts on both sides of a load and whether they agree."""
    counts = (source.select(F.lit(1).alias("s"), F.lit(0).alias("l"))
              .unionByName(loaded.select(F.lit(0).alias("s"), F.lit(1).alias("l")))
              .agg(F.sum("s").alias("source_rows"), F.sum("l").alias("loaded_rows")))
    return counts.withColumn("complete", F.col("source_rows") == F.col("loaded_rows"))


def score_log(log: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """All per-level figures of a query log in one table."""
    done = log.filter("ok")
    recall = "recall" if "recall" in log.columns else None
    return (latency_by_concurrency(done, levels, recall)
            .join(throughput(done).select("conc", "n", "qps"), "conc", "left")
            .join(failures(log).select("conc", "failed_rate"), "conc", "left")
            .withColumns({"n": F.coalesce("n", F.lit(0)), "qps": F.coalesce("qps", F.lit(0.0))}))
