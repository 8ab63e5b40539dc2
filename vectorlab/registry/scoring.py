"""Scores of answers and query logs, windows and stage arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import scoring as SC
from ..operators import frontier as FR
from ..operators import percentiles as P
from ..operators import quantise as QZ
from ..operators import querylog as QL
from ..operators import search as S
from ..plans.performance import Flat, run_case
from ..session import scratch_path
from ..streaming import stages as ST
from .base import C, L2, Q, corpus, profiles, query, r6, table, top_sql
from .vectors import BC, BQ, HAM

K = 10

# --- answers against ground truth ---------------------------------------------------------------

_LISTS = f"""WITH {C}, {Q}, {BC}, {BQ},
ts AS (SELECT q.qid, c.id, {L2} AS d FROM q, c),
t AS (SELECT * FROM (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rank FROM ts) WHERE rank <= {K}),
gs AS (SELECT q.qid, c.id, {HAM} AS d FROM qb q, cb c),
g AS (SELECT * FROM (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rank FROM gs) WHERE rank <= {K}),
ideal AS (SELECT sum(1 / log2(i + 2)) AS v FROM (SELECT unnest(range(0, {K})) AS i)),
sc AS (SELECT g.qid, count(t.id) / {K}.0 AS recall, coalesce(sum(1 / log2(t.rank + 1)), 0) / max(v) AS ndcg
FROM g LEFT JOIN t ON t.qid = g.qid AND t.id = g.id, ideal GROUP BY g.qid)"""


def truth_lists(spark, sf):
    return S.ground_truth(profiles(spark, sf), corpus(spark, sf), K)


def got_lists(spark, sf):
    """Approximate answers: the ten nearest by bit codes."""
    q, c = profiles(spark, sf), corpus(spark, sf)
    return S.answer_lists(S.top_k(QZ.bit_codes(q, ["qid"]), QZ.bit_codes(c), K, "HAMMING"))


@query("a1_recall_per_query", f"{_LISTS} SELECT qid, round(recall, 6) AS recall FROM sc")
def recall_per_query(spark, sf):
    return QL.per_query_scores(got_lists(spark, sf), truth_lists(spark, sf), K).select("qid", r6("recall", "recall"))


@query("a2_ideal_dcg", """SELECT o_orderkey, round((SELECT sum(1 / log2(i + 2)) FROM (SELECT unnest(range(0, 10 + o_custkey % 90)) AS i)), 6) AS ideal FROM orders""")
def ideal_dcg(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", r6(SC.ideal_dcg((F.lit(10) + F.col("o_custkey") % 90).cast("int")), "ideal"))


@query("a3_set_ndcg_per_query", f"{_LISTS} SELECT qid, round(ndcg, 6) AS ndcg FROM sc")
def ndcg_per_query(spark, sf):
    return QL.per_query_scores(got_lists(spark, sf), truth_lists(spark, sf), K).select("qid", r6("ndcg", "ndcg"))


@query("a4_run_scores", f"{_LISTS} SELECT round_even(round(avg(recall), 12), 4) AS recall, round_even(round(avg(ndcg), 12), 4) AS ndcg FROM sc")
def run_scores(spark, sf):
    return QL.run_scores(QL.per_query_scores(got_lists(spark, sf), truth_lists(spark, sf), K))


@query("j4_match_answers", f"{_LISTS} SELECT g.qid, count(t.id) AS found FROM g LEFT JOIN t ON t.qid = g.qid AND t.id = g.id GROUP BY g.qid")
def match_answers(spark, sf):
    both = got_lists(spark, sf).join(truth_lists(spark, sf).withColumnRenamed("id", "qid"), "qid")
    return both.select("qid", F.size(SC.shared_ids(F.col("neighbors_id"), F.col("ids"))).cast("bigint").alias("found"))


@query("u3_shared_ids", f"{_LISTS} SELECT g.qid, g.id FROM g JOIN t ON t.qid = g.qid AND t.id = g.id")
def shared_ids(spark, sf):
    both = got_lists(spark, sf).join(truth_lists(spark, sf).withColumnRenamed("id", "qid"), "qid")
    return both.select("qid", F.explode(SC.shared_ids(F.col("neighbors_id"), F.col("ids"))).alias("id"))


@query("u4_distinct_answers", f"{_LISTS} SELECT qid, count(DISTINCT id) AS n FROM g GROUP BY qid")
def distinct_answers(spark, sf):
    twice = got_lists(spark, sf).select("qid", F.concat("ids", "ids").alias("ids"))
    return twice.select("qid", F.size(SC.distinct_ids(F.col("ids"))).cast("bigint").alias("n"))


@query("t6_truncated_answers", f"SELECT qid, rank AS position, id FROM ({top_sql(L2, k=5)})")
def truncated_answers(spark, sf):
    wide = S.answer_lists(S.top_k(profiles(spark, sf), corpus(spark, sf), 20))
    short = wide.select("qid", F.posexplode(SC.truncated(F.col("ids"), 5)).alias("p", "id"))
    return short.select("qid", (F.col("p") + 1).cast("bigint").alias("position"), "id")


@query("e1_flat_case", """SELECT 'Flat' AS searcher, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS ndcg,
(SELECT count(*) FROM embeddings) AS loaded_rows, (SELECT count(DISTINCT label * 8 + vec_id % 8) FROM embeddings) AS queries""")
def flat_case(spark, sf):
    row = run_case(Flat(), corpus(spark, sf), profiles(spark, sf), k=K)
    return row.select("searcher", "recall", "ndcg", F.col("loaded_rows").cast("bigint").alias("loaded_rows"),
                      F.col("queries").cast("bigint").alias("queries"))


# --- query logs ------------------------------------------------------------------------------------

CONC = "CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 5 WHEN 'purchase' THEN 10 WHEN 'signup' THEN 20 ELSE 30 END"
LOG_SQL = f"""log AS (SELECT CAST({CONC} AS BIGINT) AS conc, event_id % 10 AS qid, user_id AS worker, epoch_us(ts) / 1e6 AS start,
value / 1000 AS latency, event_id % 17 <> 0 AS ok, (event_id % 11) / 10.0::DOUBLE AS recall FROM events)"""


def log(spark, sf):
    """The events table as a query log.

    Interpolated latencies have up to seven decimals, so they are compared to nine.
    """
    e = table(spark, sf, "events")
    return e.select(
        F.expr(f"cast({CONC} as bigint)").alias("conc"), (F.col("event_id") % 10).alias("qid"),
        F.col("user_id").alias("worker"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("start"),
        (F.col("value") / 1000).alias("latency"), (F.col("event_id") % 17 != 0).alias("ok"),
        ((F.col("event_id") % 11) / 10).alias("recall"))


@query("a5_serial_latency", f"""WITH {LOG_SQL} SELECT count(*) AS n, round_even(avg(latency), 4) AS avg, round_even(sum(latency), 4) AS total,
round_even(quantile_cont(latency, 0.95), 4) AS p95, round_even(quantile_cont(latency, 0.99), 4) AS p99 FROM log""")
def serial_latency(spark, sf):
    return QL.serial_latency(log(spark, sf))


_BY_CONC = f"""WITH {LOG_SQL}, levels AS (SELECT unnest([1, 5, 10, 20, 30, 50])::BIGINT AS conc),
done AS (SELECT * FROM log), st AS (SELECT conc, quantile_cont(latency, 0.99) AS p99, quantile_cont(latency, 0.95) AS p95,
quantile_cont(latency, 0.90) AS p90, avg(latency) AS av, avg(recall) AS recall FROM done GROUP BY conc)"""


@query("a6_latency_by_concurrency", f"""{_BY_CONC} SELECT conc, round(coalesce(p99, -1), 9) AS latency_p99, round(coalesce(p95, -1), 9) AS latency_p95,
round(coalesce(p90, -1), 9) AS latency_p90, round(coalesce(av, -1), 9) AS latency_avg, round(coalesce(recall, 0), 6) AS recall
FROM levels LEFT JOIN st USING (conc)""")
def latency_by_concurrency(spark, sf):
    """Level 50 has no request; its NaN latencies are shown as -1."""
    rows = log(spark, sf)
    levels = rows.select("conc").distinct().unionByName(spark.range(1).select(F.lit(50).cast("bigint").alias("conc")))
    found = QL.latency_by_concurrency(rows, levels, "recall")
    return found.select("conc", *[F.round(F.nanvl(F.col(c), F.lit(-1.0)), 9).alias(c)
                                  for c in ("latency_p99", "latency_p95", "latency_p90", "latency_avg")], r6("recall", "recall"))


_QPS = f"""WITH {LOG_SQL}, t AS (SELECT conc, count(*) AS n, max(start + latency) - min(start) AS seconds FROM log GROUP BY conc)"""


@query("a7_throughput", f"{_QPS} SELECT conc, n, round(seconds, 3) AS seconds, round_even(n / seconds, 4) AS qps FROM t")
def throughput(spark, sf):
    return QL.throughput(log(spark, sf)).select("conc", "n", F.round("seconds", 3).alias("seconds"), "qps")


@query("a8_merge_workers", f"""WITH {LOG_SQL} SELECT conc, count(*) AS requests, count(DISTINCT worker) AS workers,
round(sum(latency), 6) AS busy FROM log GROUP BY conc""")
def merge_workers(spark, sf):
    per_worker = log(spark, sf).groupBy("conc", "worker").agg(F.count(F.lit(1)).alias("n"), F.sum("latency").alias("busy"))
    return per_worker.groupBy("conc").agg(F.sum("n").alias("requests"), F.count(F.lit(1)).alias("workers"), r6(F.sum("busy"), "busy"))


@query("a9_max_throughput", f"{_QPS} SELECT round_even(n / seconds, 4) AS max_qps, conc FROM t ORDER BY 1 DESC, conc LIMIT 1")
def max_throughput(spark, sf):
    return QL.max_throughput(QL.throughput(log(spark, sf)))


_FAIL = f"""WITH {LOG_SQL}, f AS (SELECT conc, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
max(start + latency) - min(start) AS seconds FROM log GROUP BY conc)"""


@query("a10_failure_rate", f"""{_FAIL} SELECT conc, succeeded, failed, round(failed / (failed + succeeded), 6) AS failed_rate,
round_even(succeeded / seconds, 4) AS qps FROM f""")
def failure_rate(spark, sf):
    f = QL.failures(log(spark, sf))
    return f.select("conc", "succeeded", "failed", r6("failed_rate", "failed_rate"), "qps")


@query("a10_run_failure_rate", f"""{_FAIL} SELECT max(round_even(succeeded / seconds, 4)) AS max_qps,
round(arg_max(failed / (failed + succeeded), conc), 6) AS failed_rate FROM f""")
def run_failure_rate(spark, sf):
    r = QL.run_failures(QL.failures(log(spark, sf)))
    return r.select("max_qps", r6("failed_rate", "failed_rate"))


@query("a11_load_duration", f"""WITH {LOG_SQL}, l AS (SELECT worker, sum(latency) FILTER (conc < 20) AS i, sum(latency) FILTER (conc >= 20) AS o FROM log GROUP BY worker)
SELECT worker, round_even(coalesce(i, 0) + coalesce(o, 0), 4) AS load_duration FROM l""")
def load_duration(spark, sf):
    parts = log(spark, sf).groupBy("worker").agg(
        F.sum(F.when(F.col("conc") < 20, F.col("latency")).otherwise(0.0)).alias("i"),
        F.sum(F.when(F.col("conc") >= 20, F.col("latency")).otherwise(0.0)).alias("o"))
    return parts.select("worker", QL.load_duration(F.col("i"), F.col("o")).alias("load_duration"))


@query("a12_loaded_rows", "SELECT count(*) AS source_rows, count(*) AS loaded_rows, true AS complete FROM embeddings")
def loaded_rows(spark, sf):
    c, path = corpus(spark, sf), scratch_path(spark, "loaded")
    c.write.parquet(path)
    return QL.check_loaded(c, spark.read.parquet(path))


@query("e2_score_log", f"""WITH {LOG_SQL}, d AS (SELECT conc, count(*) AS n, quantile_cont(latency, 0.99) AS p99, quantile_cont(latency, 0.95) AS p95,
quantile_cont(latency, 0.9) AS p90, avg(latency) AS av, avg(recall) AS recall, count(*) / (max(start + latency) - min(start)) AS qps FROM log WHERE ok GROUP BY conc),
f AS (SELECT conc, count(*) FILTER (NOT ok) / count(*) AS failed_rate FROM log GROUP BY conc)
SELECT conc, n, round(p99, 9) AS latency_p99, round(p95, 9) AS latency_p95, round(p90, 9) AS latency_p90, round(av, 9) AS latency_avg,
round(recall, 6) AS recall, round_even(qps, 4) AS qps, round(failed_rate, 6) AS failed_rate FROM d JOIN f USING (conc)""")
def score_log(spark, sf):
    s = QL.score_log(log(spark, sf))
    return s.select("conc", "n", "qps", r6("recall", "recall"), r6("failed_rate", "failed_rate"),
                    *[F.round(c, 9).alias(c) for c in ("latency_p99", "latency_p95", "latency_p90", "latency_avg")])


@query("a5_percentiles_per_user", """SELECT user_id, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY user_id""")
def percentiles_per_user(spark, sf):
    e = table(spark, sf, "events")
    tails = P.percentile_columns(e, ["user_id"], "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    n = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return tails.join(n, "user_id").select("user_id", "n", r6("p50", "p50"), r6("p95", "p95"), r6("p99", "p99"))


# --- windows ----------------------------------------------------------------------------------------

_POINTS = """pts AS (SELECT p_brand AS db, p_size / 50.0::DOUBLE AS recall, p_retailprice AS qps, p_partkey AS seq FROM part),
fr AS (SELECT *, max(qps) OVER (PARTITION BY db ORDER BY recall, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM pts)"""


def points(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_brand").alias("db"), (F.col("p_size") / 50.0).alias("recall"),
                    F.col("p_retailprice").alias("qps"), F.col("p_partkey").alias("seq"))


@query("w1_frontier", f"WITH {_POINTS} SELECT db, round(recall, 6) AS recall, round(qps, 6) AS qps, seq FROM fr WHERE later IS NULL OR qps >= later")
def frontier(spark, sf):
    best, _ = FR.split_frontier(points(spark, sf), ["db"])
    return best.select("db", r6("recall", "recall"), r6("qps", "qps"), "seq")


@query("u5_off_frontier", f"WITH {_POINTS} SELECT db, round(recall, 6) AS recall, round(qps, 6) AS qps, seq FROM fr WHERE qps < later")
def off_frontier(spark, sf):
    _, rest = FR.split_frontier(points(spark, sf), ["db"])
    return rest.select("db", r6("recall", "recall"), r6("qps", "qps"), "seq")


_STAGES = """s AS (SELECT o_custkey AS run, o_orderpriority AS db, (o_orderkey % 12) * 10 AS search_stage, max(o_totalprice) AS qps
FROM orders GROUP BY 1, 2, 3)"""


@query("w3_last_two_stages", f"""WITH {_STAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY run, db ORDER BY search_stage DESC) AS rn,
max(search_stage) OVER (PARTITION BY run, db) AS mx, count(*) OVER (PARTITION BY run, db) AS n FROM s)
SELECT run, db, search_stage, round(qps, 6) AS qps FROM r WHERE rn <= 2 AND mx > 100 AND n >= 2""")
def last_two_stages(spark, sf):
    o = table(spark, sf, "orders")
    s = o.groupBy(F.col("o_custkey").alias("run"), F.col("o_orderpriority").alias("db"),
                  ((F.col("o_orderkey") % 12) * 10).alias("search_stage")).agg(F.max("o_totalprice").alias("qps"))
    return FR.last_two_stages(s, ["run", "db"]).select("run", "db", "search_stage", r6("qps", "qps"))


_RUNS = "runs AS (SELECT event_id, user_id, epoch_us(ts) AS at_us, event_type, value AS load FROM events)"


def runs(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"), "event_type",
                    F.col("value").alias("load"))


@query("w4_carried_load", f"""WITH {_RUNS} SELECT event_id, user_id, round(coalesce(last_value(CASE WHEN event_type = 'signup' THEN load END IGNORE NULLS)
OVER (PARTITION BY user_id ORDER BY at_us, event_id ROWS UNBOUNDED PRECEDING), 0), 6) AS load_duration FROM runs""")
def carried_load(spark, sf):
    c = FR.carried_load(runs(spark, sf), ["user_id"], ["at_us", "event_id"], F.col("event_type") == "signup")
    return c.select("event_id", "user_id", r6("load_duration", "load_duration"))


@query("w5_reuse_of_tables", f"""WITH {_RUNS} SELECT event_id, user_id, coalesce(event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY at_us, event_id), false) AS reused FROM runs""")
def reuse_of_tables(spark, sf):
    r = FR.reuses_previous(runs(spark, sf), ["user_id"], ["at_us", "event_id"], ["event_type"])
    return r.select("event_id", "user_id", "reused")


@query("w6_cumulative_rows", """SELECT event_type, event_id, sum(user_id) OVER (PARTITION BY event_type ORDER BY event_id)::BIGINT AS total_rows FROM events""")
def cumulative_rows(spark, sf):
    p = table(spark, sf, "events").select("event_type", F.col("event_id").alias("batch_id"), F.col("user_id").alias("rows"))
    c = ST.cumulative_progress(p, ["event_type"], ["batch_id"])
    return c.select("event_type", F.col("batch_id").alias("event_id"), F.col("total_rows").cast("bigint").alias("total_rows"))


@query("w6_first_batch_of_stage", """WITH p AS (SELECT event_id AS batch_id, sum(user_id) OVER (ORDER BY event_id) AS total_rows FROM events),
n AS (SELECT sum(user_id) AS n FROM events), st AS (SELECT unnest([0.1, 0.5, 0.8, 0.9])::DOUBLE AS stage),
t AS (SELECT stage, trunc(n * stage)::BIGINT AS target_rows FROM st, n)
SELECT stage, target_rows, min(batch_id) AS batch_id FROM t JOIN p ON p.total_rows >= t.target_rows GROUP BY stage, target_rows""")
def first_batch_of_stage(spark, sf):
    p = table(spark, sf, "events").select(F.col("event_id").alias("batch_id"), F.col("user_id").alias("rows"))
    total = p.agg(F.sum("rows")).first()[0]
    targets = spark.createDataFrame([(s, int(total * s)) for s in ST.sorted_stages([0.9, 0.1, 0.5, 0.8])],
                                    "stage double, target_rows bigint")
    return ST.first_reaching(ST.cumulative_progress(p, [], ["batch_id"]), targets)


# --- rates and stages ---------------------------------------------------------------------------------


@query("x2_rate_in_batches", "SELECT o_orderkey, greatest(100, (o_orderkey // 100) * 100)::BIGINT AS rate FROM orders")
def rate_in_batches(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", ST.rate_in_batches(F.col("o_orderkey"), 100).cast("bigint").alias("rate"))


@query("x5_valid_stages", """SELECT p_partkey, (p_size / 50.0 < 1 AND p_retailprice / 1000 < 1) AS valid, round(least(p_size / 50.0, p_retailprice / 1000), 6) AS first FROM part""")
def valid_stages(spark, sf):
    s = F.array((F.col("p_size") / 50.0), F.col("p_retailprice") / 1000)
    return table(spark, sf, "part").select("p_partkey", ST.stages_valid(s).alias("valid"), r6(F.array_sort(s)[0], "first"))


@query("x6_ideal_duration", "SELECT p_partkey, ceil(p_retailprice / p_size)::BIGINT AS seconds FROM part")
def ideal_duration(spark, sf):
    return table(spark, sf, "part").select("p_partkey", ST.ideal_duration(F.col("p_retailprice"), F.col("p_size")).alias("seconds"))


@query("x7_search_time", """SELECT event_id, round_even(epoch_us(ts) / 1e6 - (SELECT min(epoch_us(ts)) / 1e6 FROM events), 4) AS search_time FROM events""")
def search_time(spark, sf):
    e = table(spark, sf, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    start = e.agg(F.min("at")).first()[0]
    return e.select("event_id", ST.search_time(F.col("at"), F.lit(start)).alias("search_time"))


_BUDGET = """s AS (SELECT o_custkey, (o_orderkey % 10) / 10.0::DOUBLE AS stage, max(o_totalprice) / 10000 AS serial_seconds FROM orders GROUP BY 1, 2),
n AS (SELECT *, lead(stage, 1, 1.0) OVER (PARTITION BY o_custkey ORDER BY stage) AS nxt FROM s),
d AS (SELECT *, floor(100000 * (nxt - stage) / 500) - serial_seconds AS left_over FROM n)"""


@query("x8_stage_budget", f"""WITH {_BUDGET} SELECT o_custkey, round(stage, 6) AS stage, round_even((CASE WHEN left_over > 60 THEN left_over - 30
WHEN left_over > 30 THEN left_over - 15 ELSE left_over / 2 END) / 2, 4) AS budget FROM d""")
def stage_budget(spark, sf):
    s = table(spark, sf, "orders").groupBy("o_custkey", ((F.col("o_orderkey") % 10) / 10).alias("stage")).agg(
        (F.max("o_totalprice") / 10000).alias("serial_seconds"))
    b = ST.stage_budgets(s, ["o_custkey"], F.lit(100000), F.lit(500), F.lit(2))
    return b.select("o_custkey", r6("stage", "stage"), "budget")


@query("x10_rows_per_second", """SELECT epoch_us(date_trunc('second', ts)) // 1000000 AS second, sum(user_id)::BIGINT AS rows FROM events GROUP BY 1""")
def rows_per_second(spark, sf):
    p = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("done_ts"), F.col("user_id").alias("rows"))
    r = ST.rows_per_second(p)
    return r.select(F.unix_seconds("second").alias("second"), F.col("rows").cast("bigint").alias("rows"))


@query("m13_adjusted_scores", """SELECT event_id, round_even(value / 1000 / least(10 + event_id % 111, 100) * 100, 4) AS adjusted FROM events""")
def adjusted_scores(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", N.stage_adjusted(F.col("value") / 1000, F.lit(10) + F.col("event_id") % 111).alias("adjusted"))
