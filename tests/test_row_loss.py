"""Rows that must not get lost: missing distances, coarse errors, sparse ids, unanswered queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorlab import session
from vectorlab.functions import vector as V
from vectorlab.operators import blocks, querylog
from vectorlab.operators import search as S
from vectorlab.registry import tables

from .conftest import found, vectors


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_rows_with_nan_come_last(spark, metric):
    corpus = vectors(spark, [[1, 2], [float("nan"), 1], [3, 1], [2, float("nan")]])
    asked = vectors(spark, [[1, 1]], "qid")
    answer = found(S.top_k(asked, corpus, 4, metric))
    assert sorted(answer[0][:2]) == [0, 2] and answer[0][2:] == [1, 3]


@pytest.mark.parametrize("metric", ["L2", "L2_SQUARED", "IP"])
def test_coarse_errors_of_the_full_slack_lose_no_row(monkeypatch, metric):
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(400, 8)).astype(np.float32), rng.normal(size=(3, 8)).astype(np.float32)
    true_coarse = blocks.Space.coarse
    monkeypatch.setattr(blocks.Space, "slack", lambda self, rows, x: np.full(len(self._aux[rows]), 0.5))
    monkeypatch.setattr(blocks.Space, "coarse", lambda self, rows, x: true_coarse(self, rows, x) + rng.choice([-0.5, 0.5], (len(self._aux[rows]), len(x))))
    space = blocks.Space(metric, q)
    best = blocks.TopK(space, 5)
    best.add(np.arange(400), x)
    exact = {"L2": lambda: np.linalg.norm(x[None] - q[:, None], axis=2), "L2_SQUARED": lambda: ((x[None] - q[:, None]) ** 2).sum(2), "IP": lambda: -(q @ x.T)}[metric]()
    assert best.ids.tolist() == np.argsort(exact, axis=1)[:, :5].tolist()


def test_slices_cover_sparse_ids(spark):
    ids = [-5, 0, 7, 1000, 10**12, None]
    parts, _ = tables._slices(spark.createDataFrame([(i,) for i in ids], "id bigint"), 3)
    assert sorted((r.id is None, r.id or 0) for p in parts for r in p.collect()) == sorted((i is None, i or 0) for i in ids)


def test_unanswered_queries_score_zero(spark):
    truth = spark.createDataFrame([(1, [1, 2]), (2, [3, 4])], "id bigint, neighbors_id array<bigint>")
    answers = spark.createDataFrame([(1, [1, 2])], "qid bigint, ids array<bigint>")
    scores = querylog.per_query_scores(answers, truth, 2)
    assert scores.count() == 2 and querylog.run_scores(scores).first().recall == 0.5


def test_levels_without_success_have_zero_throughput(spark):
    log = spark.createDataFrame([(1, 1, 0.0, 0.1, True), (1, 2, 0.2, 0.1, True), (2, 1, 0.0, 0.1, False)], "conc int, qid int, start double, latency double, ok boolean")
    levels = spark.createDataFrame([(1,), (2,)], "conc int")
    rows = {r.conc: r for r in querylog.score_log(log, levels).collect()}
    assert rows[2].n == 0 and rows[2].qps == 0


def test_normalise_computes_the_norm_once(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>").select(V.normalise(F.col("v")).alias("u"))
    assert [r.u for r in df.collect()] == [[0.6, 0.8], [None, None]]


def test_no_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())
