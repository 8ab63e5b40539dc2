import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vectorlab.functions import numbers as N
from vectorlab.functions import scoring as SC
from vectorlab.operators import frontier as FR
from vectorlab.operators import percentiles as P
from vectorlab.operators import querylog as QL
from vectorlab.operators import running as R
from vectorlab.streaming import stages as ST

# fixed values: published golden cases of recall and number text
TRUTH = [1, 3, 5, 7, 9, 10]
RECALLS = [([1, 3, 5, 7, 9, 10], 1.0), ([11, 12, 13, 14, 15, 16], 0.0), ([1, 3, 5, 11, 12, 13], 0.5), ([1, 3, 5], 0.5)]
NUMBERS = [(1, "1"), (10, "10"), (100, "100"), (1_000, "1K"), (2_000, "2K"), (30_000, "30K"), (400_000, "400K"),
           (5_000_000, "5M"), (60_000_000, "60M"), (1_000_000_000, "1B"), (1_000_000_000_000, "1000B")]


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def ids(values):
    return F.array(*[F.lit(v).cast("bigint") for v in values])


@pytest.mark.parametrize("got, expected", RECALLS)
def test_recall(spark, got, expected):
    assert one(spark, SC.recall_at(ids(TRUTH), ids(got), 6)) == expected


def test_recall_counts_repeated_answers(spark):
    assert one(spark, SC.recall_at(ids(TRUTH), ids([1, 1, 2, 2, 2, 2]), 6)) == pytest.approx(2 / 6)


def test_ndcg_uses_the_true_rank_and_ignores_answer_order(spark):
    half = one(spark, SC.set_ndcg_at(ids(TRUTH), ids([1, 3, 5]), 6))
    assert round(half, 4) == 0.6448
    assert one(spark, SC.set_ndcg_at(ids(TRUTH), ids([5, 1, 3, 3]), 6)) == half
    assert one(spark, SC.set_ndcg_at(ids(TRUTH), ids(TRUTH[::-1]), 6)) == 1.0


@pytest.mark.parametrize("n, text", NUMBERS)
def test_short_numbers(spark, n, text):
    assert one(spark, N.short_number(F.lit(n))) == text


def test_rounding_is_half_to_even(spark):
    assert one(spark, N.round4(F.lit(0.00005))) == 0.0 and one(spark, N.round4(F.lit(0.00015))) == np.round(0.00015, 4)


def test_scores_without_truth_are_zero(spark):
    empty = spark.createDataFrame([], "qid bigint, recall double, ndcg double")
    assert QL.run_scores(empty).first().asDict() == {"recall": 0.0, "ndcg": 0.0}


@pytest.fixture(scope="module")
def values(spark):
    r = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in r.exponential(size=30_000)] + [("flat", 1.0)] * 200 + [("one", 3.0)] + [
        ("few", float(v)) for v in (4, 1, 9)] + [("ties", float(v)) for v in r.integers(0, 4, 15_000)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(6)


def test_percentiles_are_exact(values):
    rows, df = values
    levels = [0.0, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = {(r["g"], r["level"]): r["percentile"] for r in P.exact_percentiles(df, ["g"], "v", levels).collect()}
    for g in {g for g, _ in rows}:
        x = [v for name, v in rows if name == g]
        for p in levels:
            assert got[g, p] == pytest.approx(np.percentile(x, p * 100), abs=1e-12)


def test_percentiles_of_a_whole_table(values):
    rows, df = values
    r = P.percentile_columns(df, [], "v", {"p95": 0.95, "p99": 0.99}).first()
    assert r["p95"] == pytest.approx(np.percentile([v for _, v in rows], 95), abs=1e-12)
    assert r["p99"] == pytest.approx(np.percentile([v for _, v in rows], 99), abs=1e-12)


def test_level_without_requests(spark):
    log = spark.createDataFrame([(1, 0.0, 0.5, True)], "conc bigint, start double, latency double, ok boolean")
    levels = spark.createDataFrame([(1,), (5,)], "conc bigint")
    rows = {r["conc"]: r for r in QL.latency_by_concurrency(log, levels).collect()}
    assert rows[1]["latency_p99"] == 0.5 and np.isnan(rows[5]["latency_p99"]) and rows[5]["recall"] == 0.0
    still = spark.createDataFrame([(1, 2.0, 0.0, True)], log.schema)
    assert QL.throughput(still).first()["qps"] == 0.0


@pytest.fixture(scope="module")
def sequence(spark):
    r = np.random.default_rng(9)
    rows = [("hot" if r.random() < 0.7 else f"g{r.integers(5)}", i, float(r.integers(100)), None if r.random() < 0.6 else float(i))
            for i in range(2000)]
    # small partitions are merged by default, so that this little table would be a single chunk
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(rows, "g string, i bigint, v double, sparse double").repartition(5)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_values_equal_plain_windows(sequence):
    w = Window.partitionBy("g").orderBy("i")
    upto, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    pairs = [(R.running_sum(sequence, ["g"], ["i"], "v", "x"), F.sum("v").over(upto)),
             (R.max_of_later(sequence, ["g"], ["i"], "v", "x"), F.max("v").over(after)),
             (R.last_known(sequence, ["g"], ["i"], "sparse", "x"), F.last("sparse", True).over(upto)),
             (R.previous(sequence, ["g"], ["i"], "sparse", "x"), F.lag("sparse").over(w))]
    for ours, plain in pairs:
        a = ours.select("g", "i", "x")
        b = sequence.withColumn("x", plain).select("g", "i", "x")
        assert a.count() == 2000 and a.exceptAll(b).count() == 0


def test_a_hot_group_spans_several_chunks(sequence):
    chunks = R.chunked(sequence.filter("g = 'hot'"), ["g"], ["i"])
    assert chunks.select(R.CHUNK).distinct().count() > 1


def test_frontier_by_hand(spark):
    rows = [("a", 0.90, 100.0, 1), ("a", 0.95, 120.0, 2), ("a", 0.97, 80.0, 3), ("a", 0.98, 80.0, 4), ("a", 0.99, 10.0, 5),
            ("b", 0.5, 1.0, 6)]
    points = spark.createDataFrame(rows, "db string, recall double, qps double, seq bigint")
    best, rest = FR.split_frontier(points, ["db"])
    assert sorted(r["seq"] for r in best.collect()) == [2, 3, 4, 5, 6]
    assert [r["seq"] for r in rest.collect()] == [1]


def test_carried_load_and_reuse(spark):
    rows = [(1, "x", True, 5.0), (2, "x", False, 9.0), (3, "y", True, 7.0), (4, "y", False, 1.0), (5, "y", False, 1.0)]
    runs = spark.createDataFrame(rows, "seq bigint, db string, fresh boolean, load double")
    carried = FR.carried_load(runs, [], ["seq"], F.col("fresh")).orderBy("seq").collect()
    assert [r["load_duration"] for r in carried] == [5.0, 5.0, 7.0, 7.0, 7.0]
    none = FR.carried_load(runs.filter("not fresh"), [], ["seq"], F.col("fresh")).collect()
    assert {r["load_duration"] for r in none} == {0.0}
    reused = FR.reuses_previous(runs, [], ["seq"], ["db"]).orderBy("seq").collect()
    assert [r["reused"] for r in reused] == [False, True, False, True, True]


def test_last_two_stages(spark):
    rows = [("a", s) for s in (50, 80, 100, 110)] + [("b", s) for s in (50, 100)] + [("c", 110)]
    got = FR.last_two_stages(spark.createDataFrame(rows, "run string, search_stage int"), ["run"]).collect()
    assert sorted((r["run"], r["search_stage"]) for r in got) == [("a", 100), ("a", 110)]


def test_better_of_two(spark):
    def better(a, b, lower):
        return one(spark, N.better_of(F.lit(a), F.lit(b), lower))

    assert better(0.0, 2.0, True) == 2.0 and better(3.0, 0.0, True) == 3.0 and better(0.0, 0.0, True) == 0.0
    assert better(3.0, 2.0, True) == 2.0 and better(3.0, 2.0, False) == 3.0


def test_stage_arithmetic(spark):
    assert ST.sorted_stages([0.8, 0.0, 0.5]) == [0.0, 0.5, 0.8]
    with pytest.raises(ValueError):
        ST.sorted_stages([0.5, 1.0])
    assert [one(spark, ST.rate_in_batches(F.lit(r), 100)) for r in (50, 100, 250, 999)] == [100, 100, 200, 900]
    assert one(spark, ST.target_batch(F.lit(100), F.lit(0.29))) == int(100 * 0.29)
    s = spark.createDataFrame([(1, 0.5, 10.0), (1, 0.8, 10.0)], "run int, stage double, serial_seconds double")
    got = [r["budget"] for r in ST.stage_budgets(s, ["run"], F.lit(100_000), F.lit(500), F.lit(2)).orderBy("stage").collect()]

    def budget(cur, nxt):
        left = 100_000 * (nxt - cur) // 500 - 10.0
        left = left - 30 if left > 60 else left - 15 if left > 30 else left / 2
        return round(left / 2, 4)

    assert got == [budget(0.5, 0.8), budget(0.8, 1.0)]


@pytest.mark.parametrize("name", ["distinct", "few", "one", "signs"])
def test_percentiles_of_one_group_of_all_rows(spark, name, monkeypatch):
    """More rows than a list holds: all distinct, few values, a single value, and signs, zeros and extremes."""
    rng = np.random.default_rng(12)
    x = {"distinct": rng.normal(size=20_000) * 10.0 ** rng.integers(-200, 200, 20_000), "few": rng.integers(0, 3, 20_000) * 0.1,
         "one": np.full(20_000, 7.25), "signs": rng.choice([0.0, -0.0, -1.5, 1e-320, -1e-320, 1e300, -1e300], 20_000)}[name]
    monkeypatch.setattr(P, "FEW", 50)
    rows = [(None, float(v)) for v in x] + [("small", 1.0), ("small", 2.0), ("small", float("nan")), ("small", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    levels = [0.0, 0.001, 0.25, 0.5, 0.95, 0.99, 1.0]
    found = P.exact_percentiles(df, ["g"], "v", levels)
    got = {(r["g"], r["level"]): (r["n"], r["percentile"]) for r in found.collect()}
    order = np.sort(x + 0.0)
    for p in levels:
        at = (len(x) - 1) * p
        low, high = order[int(np.floor(at))], order[int(np.ceil(at))]
        assert got[None, p] == (len(x), low + (high - low) * (at - np.floor(at)))
        assert got["small", p] == (2, 1.0 + p)
    assert len(got) == 2 * len(levels)
    assert "Window" not in found._jdf.queryExecution().toString()
