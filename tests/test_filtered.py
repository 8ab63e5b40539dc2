"""Many filters in one scan, and radius search by pivots."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import found, vectors
from tests.test_tables import rows_scanned
from vectorlab.operators import filtered as FD
from vectorlab.operators import pivots as PV
from vectorlab.operators import search as S
from vectorlab.plans.cases import ID_RATES
from vectorlab.session import BROADCAST_BYTES_KEY

rng = np.random.default_rng(31)
ROWS = rng.normal(size=(900, 10)).astype(np.float32)
ROWS[200:400] = ROWS[5]
ASKED = np.vstack([ROWS[:6], rng.normal(size=(6, 10)).astype(np.float32)])
LABELS = {"a": 0.5, "b": 0.2, "c": 0.05}


@pytest.fixture(scope="module")
def labelled(spark):
    label = F.when(F.col("id") % 20 < 10, "a").when(F.col("id") % 20 < 14, "b").when(F.col("id") % 20 < 15, "c")
    return vectors(spark, ROWS, parts=4).withColumn("labels", label).persist()


@pytest.mark.parametrize("metric", ["L2", "COSINE"])
def test_thirty_filters_in_one_scan(spark, labelled, metric):
    q = vectors(spark, ASKED, "qid")
    thresholds = {f"id {r}": int(len(ROWS) * r) for r in ID_RATES} | {"all": 0, "all too": -5, "same": int(len(ROWS) * 0.5), "few": 896, "none": 5000}
    labels = {f"label {v}": v for v in LABELS} | {"no label": "x"}
    assert len(thresholds) + len(labels) >= 30
    got = FD.top_k_under_filters(q, labelled, 7, metric, thresholds, labels)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    lists = {}
    for r in sorted(got.collect(), key=lambda r: r["rank"]):
        lists.setdefault((r["filter"], r["qid"]), []).append((r["id"], r["dist"]))
    for name, where in [*((f, F.col("id") >= t) for f, t in thresholds.items()), *((f, F.col("labels") == v) for f, v in labels.items())]:
        want = {}
        for r in S.top_k(q, labelled, 7, metric, where).orderBy("rank").collect():
            want.setdefault(r["qid"], []).append((r["id"], r["dist"]))
        assert {qid: a for (f, qid), a in lists.items() if f == name} == want
    spark.conf.set(BROADCAST_BYTES_KEY, "9000")  # more query blocks
    try:
        few = {"all": 0, "half": 450}
        assert FD.top_k_under_filters(q, labelled, 7, metric, few).where("filter = 'half'").count() == 7 * len(ASKED)
    finally:
        spark.conf.unset(BROADCAST_BYTES_KEY)


def test_filters_of_nothing(spark, labelled):
    q = vectors(spark, ASKED, "qid")
    assert FD.top_k_under_filters(q, labelled, 7).count() == 0
    assert FD.top_k_under_filters(q, labelled.where("id < 0"), 7, thresholds={"all": 0}).count() == 0
    assert FD.top_k_under_filters(q.where("qid < 0"), labelled, 7, thresholds={"all": 0}).columns == ["filter", "qid", "id", "dist", "rank"]
    truth = FD.ground_truths(q, labelled, 3, thresholds={"all": 0}, labels={"b": "b"})
    assert truth.count() == 2 * len(ASKED) and all(len(r["neighbors_id"]) == 3 for r in truth.collect())


def test_radius_search_by_pivots(spark, tmp_path):
    centres = rng.normal(size=(40, 10)) * 5
    x = (centres[rng.integers(0, 40, 12_000)] + rng.normal(size=(12_000, 10)) * 0.3).astype(np.float32)
    x[100:160] = x[100]
    c = vectors(spark, x, parts=4)
    pivots = PV.choose_pivots(c, 3)
    table = PV.write_pivots(c, pivots, f"file:{tmp_path}/t", 4, row_group_bytes=60_000)
    q = vectors(spark, np.vstack([x[100], x[7] + 0.05]), "qid")
    for radius, num, least in ((0.8, 50, 5), (0.0, 20, 30), (1e-9, 500, 1), (60.0, 30, 1)):
        want = S.radius_search(q, c, radius, num, least).orderBy("qid", "rank").collect()
        got = PV.radius_search_by_pivots(q, table, pivots, radius, num, least)
        assert got.orderBy("qid", "rank").collect() == want and want
    near = PV.radius_search_by_pivots(q, table, pivots, 0.8, 50)
    assert rows_scanned(near) < 0.5 * len(x)
    assert PV.radius_search_by_pivots(q, table, pivots, -1.0, 5).count() == 0


def test_intervals():
    low, high = np.array([5.0, 0.0, 1.0, 9.0]), np.array([6.0, 2.0, 1.5, 9.5])
    assert PV.intervals(low, high) == [(0.0, 2.0), (5.0, 6.0), (9.0, 9.5)]
    assert PV.intervals(low, high, 2) == [(0.0, 6.0), (9.0, 9.5)] or PV.intervals(low, high, 2) == [(0.0, 2.0), (5.0, 9.5)]
    assert PV.intervals(low, high, 1) == [(0.0, 9.5)]
