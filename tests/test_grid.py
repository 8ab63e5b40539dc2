import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import brute_force, found, vectors
from vectorlab.operators import quantise as QZ
from vectorlab.operators import search as S
from vectorlab.operators.grid import grid_top_k, packed

rng = np.random.default_rng(8)
ROWS = rng.normal(size=(700, 12)).astype(np.float32)
ROWS[100:300] = ROWS[7]  # copies: more ties than k
ASKED = np.vstack([ROWS[:90], rng.normal(size=(60, 12)).astype(np.float32)])


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
@pytest.mark.parametrize("block_bytes, range_bytes", [(1 << 21, 1 << 28), (500, 3000)])
def test_grid_equals_brute_force(spark, metric, block_bytes, range_bytes):
    got = grid_top_k(vectors(spark, ASKED, "qid"), vectors(spark, ROWS, parts=5), 9, metric, None, block_bytes, range_bytes)
    assert found(got) == brute_force(ASKED, ROWS, 9, metric)


def test_grid_of_bit_codes(spark):
    a, b = rng.integers(0, 2, (2, 80, 40)) * 2.0 - 1.0
    q, c = QZ.bit_codes(vectors(spark, a, "qid"), ["qid"]), QZ.bit_codes(vectors(spark, b))
    for metric in ("HAMMING", "JACCARD"):
        assert found(grid_top_k(q, c, 6, metric, block_bytes=60)) == found(S.top_k(q, c, 6, metric))


def test_grid_filters_nulls_and_missing_distances(spark):
    c = vectors(spark, ROWS[:50]).union(spark.createDataFrame([(900, None), (901, [float("nan")] * 12)], "id bigint, emb array<float>"))
    q = vectors(spark, ASKED[:5], "qid")
    got = grid_top_k(q, c, 60, "L2", F.col("id") >= 10, block_bytes=300)
    rows = got.where("qid = 0").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 42))
    assert rows[-1]["id"] == 901 and rows[-1]["dist"] is None and min(r["id"] for r in rows) == 10


def test_grid_without_rows_or_queries(spark):
    c, q = vectors(spark, ROWS[:20]), vectors(spark, ASKED[:5], "qid")
    assert grid_top_k(q.where("qid < 0"), c, 3).count() == 0
    assert grid_top_k(q, c.where("id < 0"), 3).count() == 0


def test_grid_needs_vectors_of_one_length(spark):
    with pytest.raises(Exception, match="different lengths"):
        grid_top_k(vectors(spark, ASKED[:3, :5], "qid"), vectors(spark, ROWS), 3).collect()


def test_nothing_is_broadcast_or_fetched(spark):
    got = grid_top_k(vectors(spark, ASKED, "qid"), vectors(spark, ROWS), 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" in plan  # of packed blocks
    blocks = packed(vectors(spark, ROWS), "test-blocks", 50 * 12 * 4)
    assert blocks.select(F.max(F.octet_length("ids") / 8)).first()[0] <= 50
    assert blocks.select(F.sum(F.octet_length("ids") / 8)).first()[0] == len(ROWS)
