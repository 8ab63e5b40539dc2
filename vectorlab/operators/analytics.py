"""Result analytics: best runs, chart tables, price figures and leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X

# fixed values: report order of metrics, and those where less is better
METRIC_ORDER = ["qps", "recall", "load_duration", "serial_latency_p99", "serial_latency_p95", "max_load_count"]
LOWER_IS_BETTER = ["load_duration", "serial_latency_p99", "serial_latency_p95"]


def keep_selected(rows: DataFrame, backends: list[str], cases: list[str], db: str = "db_name", case: str = "case_name") -> DataFrame:
    return rows.filter(F.col(db).isin(backends) & F.col(case).isin(cases))


def with_list(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.coalesce(F.size(F.when(F.col(column).isNotNull(), F.col(column))), F.lit(0)) > 0)


def merge_runs(rows: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """One row per (backend, case): the run with the highest QPS (the later one on a tie) and the
    best status (normal if any run was, else the last one).

    A plain aggregate, so repeats of a hot pair are reduced before the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys and c != "status"]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce("qps", F.lit(0.0)).alias("q"), F.col(seq)))
    status = (F.when(F.bool_or(F.col("status") == X.NORMAL), X.NORMAL)
              .otherwise(F.max_by("status", seq)))
    return rows.groupBy(*keys).agg(best.alias("_best"), status.alias("status")).select(*keys, "_best.*", "status")


def failed_backends(merged: DataFrame, case: str = "case_name", db: str = "db_name") -> DataFrame:
    """Backends without a normal run, one row per case, status and backend, in that order."""
    return merged.filter(F.col("status") != X.NORMAL).select(case, "status", db).distinct().orderBy(case, "status", db)


def distinct_values(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns).distinct().orderBy(*columns)


def padded_range(rows: DataFrame, keys: list[str], metric: str, below: float, above: float) -> DataFrame:
    """Axis range of a metric per group, widened by shares of its spread; missing counts as zero."""
    value = F.coalesce(F.col(metric), F.lit(0.0))
    spread = F.col("hi") - F.col("lo")
    return (rows.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
            .select(*keys, (F.col("lo") - spread * below).alias("range_from"),
                    (F.col("hi") + spread * above).alias("range_to")))


def metric_names(rows: DataFrame, keys: list[str], metrics: str = "metrics") -> DataFrame:
    """Names of the metrics that occur in each group, from a map column."""
    names = rows.select(*keys, F.explode(F.map_keys(metrics)).alias("metric")).distinct()
    return names.groupBy(*keys).agg(F.array_sort(F.collect_list("metric")).alias("metrics"))


def in_listed_order(column: str, listed: list[str]) -> list[Column]:
    """Sort keys: listed values in their order, then unknown ones by name."""
    place = F.array_position(F.array(*[F.lit(v) for v in listed]), F.col(column))
    return [F.when(place == 0, F.lit(len(listed) + 1)).otherwise(place).asc(), F.col(column).asc()]


def best_first(metric: Column, value: Column) -> Column:
    """Value with its sign flipped where less is better, so that descending order is best first."""
    return F.when(metric.isin(LOWER_IS_BETTER), -value).otherwise(value)


def report_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("db").desc(), F.col("db_label").desc(), F.col("case_name").desc())


def with_price(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Hourly price per backend and label, zero when unlisted."""
    return rows.join(prices, ["db", "db_label"], "left").withColumn("price", F.coalesce("price", F.lit(0.0)))


def price_list(rows: DataFrame, prices: DataFrame, free: list[str]) -> DataFrame:
    """Distinct priced backends in order; backends that cost nothing by nature are left out."""
    pairs = distinct_values(rows.filter(~F.col("db").isin(free)), "db", "db_label")
    return with_price(pairs, prices).orderBy("db", "db_label")


def dollar_chart(rows: DataFrame, prices: DataFrame) -> DataFrame:
    priced = with_price(rows, prices)
    return priced.withColumn("qpd", N.thousand_queries_per_dollar(F.col("qps"), F.col("price")))


def concurrency_chart(rows: DataFrame) -> DataFrame:
    """Chart rows per concurrency: missing list entries are zero, latencies in ms."""
    lists = ["conc_num_list", "conc_qps_list", "conc_latency_p99_list", "conc_latency_p95_list", "conc_latency_avg_list"]
    zipped = F.arrays_zip(*[F.coalesce(F.col(c), F.array()).alias(c) for c in lists])
    # entries beyond the concurrency list have no level of their own
    c = rows.select("db_name", "db", F.explode(F.slice(zipped, 1, F.size(F.coalesce("conc_num_list", F.array())))).alias("c"))
    zero = F.lit(0.0)
    return c.select(
        "db_name", "db", F.col("c.conc_num_list").alias("conc_num"), F.coalesce("c.conc_qps_list", zero).alias("qps"),
        *[(F.coalesce(f"c.conc_{n}_list", zero) * 1000).alias(n) for n in ("latency_p99", "latency_p95", "latency_avg")])


def stage_chart(rows: DataFrame) -> DataFrame:
    """Chart rows per search stage of streaming runs."""
    names = {"search_stage": "st_search_stage_list", "search_time": "st_search_time_list", "qps": "st_max_qps_list_list",
             "recall": "st_recall_list", "ndcg": "st_ndcg_list", "p99": "st_serial_latency_p99_list",
             "p95": "st_serial_latency_p95_list"}
    zipped = F.arrays_zip(*[F.coalesce(F.col(c), F.array()).alias(n) for n, c in names.items()])
    stages = F.slice(zipped, 1, F.size(F.coalesce("st_search_stage_list", F.array())))
    s = rows.withColumn("s", F.explode(stages))
    stage = F.col("s.search_stage")
    return s.select(
        "db", "db_name", stage.alias("search_stage"), "s.search_time", "s.qps", "s.recall", "s.ndcg",
        N.stage_adjusted(F.col("s.recall"), stage).alias("adjusted_recall"),
        N.stage_adjusted(F.col("s.ndcg"), stage).alias("adjusted_ndcg"),
        N.round_even(F.col("s.p99") * 1000, 2).alias("latency_p99"),
        F.coalesce(N.round_even(F.col("s.p95") * 1000, 2), F.lit(0.0)).alias("latency_p95"),
        F.col("st_ideal_insert_duration").alias("ideal_insert_duration"), "insert_duration", "optimize_duration",
        (stage > 100).alias("optimized"))


def at_stage(values: Column, stages: Column, stage: int) -> Column:
    """Entry of a parallel list at a stage; null when the stage is missing."""
    place = F.array_position(stages, F.lit(stage))
    return F.when(place > 0, F.try_element_at(values, place.cast("int")))


def leaderboard(rows: DataFrame, prices: DataFrame, capacity_cases: list[int], dated: dict[str, str] | None = None) -> DataFrame:
    """Standard runs with their code, month and queries per dollar.

    `dated` names backends that count only from a given day on.
    """
    keep = F.coalesce(F.contains("task_label", F.lit("standard")), F.lit(False)) & ~F.col("case_id").isin(capacity_cases)
    for db, day in (dated or {}).items():
        recent = F.timestamp_seconds("timestamp") >= F.lit(day).cast("timestamp")
        keep = keep & ((F.col("db") != db) | recent)
    priced = with_price(rows.filter(keep), prices)
    return priced.select(
        "db", "db_label", "db_name", "case_name", "qps", F.col("serial_latency_p99").alias("latency"), "recall",
        X.status_code(F.col("status")).alias("label"), "note", "version",
        X.test_month(F.col("timestamp")).alias("test_time"),
        N.queries_per_dollar(F.col("qps"), F.col("price")).alias("qp$"))


def _short_name() -> Column:
    return F.concat_ws("-", "db", X.non_empty(F.col("db_label")))


def leaderboard_by_filter(rows: DataFrame) -> DataFrame:
    """Second leaderboard: performance cases by dataset and filter rate."""
    return rows.select(
        F.col("dataset_title").alias("dataset"), "db", F.col("db_label").alias("label"), _short_name().alias("db_name"),
        N.round4(F.col("qps")).alias("qps"), N.round4(F.col("serial_latency_p99")).alias("latency"),
        N.round4(F.col("recall")).alias("recall"),
        N.round_even(F.coalesce("filter_rate", F.lit(0.0)), 3).alias("filter_ratio"))


def leaderboard_streaming(rows: DataFrame, stage: int = 90) -> DataFrame:
    """Streaming leaderboard: speed at one insert stage; `has_stage` marks runs that reached it."""
    stages = F.col("st_search_stage_list")
    return rows.select(
        F.col("dataset_title").alias("dataset"), "db", F.col("db_label").alias("label"), _short_name().alias("db_name"),
        "insert_rate", N.round4(at_stage(F.col("st_max_qps_list_list"), stages, stage)).alias("streaming_qps"),
        N.round4(at_stage(F.col("st_serial_latency_p99_list"), stages, stage)).alias("streaming_latency"),
        F.coalesce(F.array_contains(stages, stage), F.lit(False)).alias("has_stage"))
