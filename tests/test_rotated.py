import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import brute_force, found, vectors
from vectorlab.plans import ivf
from vectorlab.plans import rotated as RB

rng = np.random.default_rng(21)
ROWS = rng.normal(size=(3000, 64)).astype(np.float32)
ASKED = rng.normal(size=(20, 64)).astype(np.float32)


@pytest.fixture(scope="module")
def built(spark):
    search = RB.RotatedBits(6, 6, rotation=RB.hadamard_rotation(64))
    return search, search.build(vectors(spark, ROWS)).persist()


def recall(a, b):
    return np.mean([len(set(x) & set(y)) / len(y) for x, y in zip(a, b)])


@pytest.mark.parametrize("dim", [1, 2, 16, 64])
def test_rotations_are_orthogonal(dim):
    for r in (RB.hadamard_rotation(dim), RB.random_rotation(dim)):
        assert np.allclose(r @ r.T, np.eye(dim))
    assert RB.rotation_for(24).shape == (24, 24)
    with pytest.raises(ValueError):
        RB.hadamard_rotation(24)


def test_recall_with_fewer_rows_compared_than_plain_bits_need(spark, built, monkeypatch):
    search, table = built
    compared = []
    rerank = RB.S.rerank

    def counting(queries, rows, candidates, k, *rest):
        compared.append(candidates.count())
        return rerank(queries, rows, candidates, k, *rest)

    monkeypatch.setattr(RB.S, "rerank", counting)
    q, want = vectors(spark, ASKED, "qid"), brute_force(ASKED, ROWS, 10)
    got = found(search.search(q, table, 10, "L2"))
    assert recall(got, want) >= 0.95 and sum(compared) < 0.5 * len(ROWS) * len(ASKED)  # normal noise, the worst case
    plain = ivf.residual_codes(vectors(spark, ROWS), search.centroids)
    equal = found(ivf.ivf_bit_top_k(q, plain, search.centroids, 10, 6, sum(compared) / len(ASKED) / 10))
    assert recall(equal, want) < recall(got, want)  # plain bits with as many rows compared


def test_bounds_hold_and_estimates_have_no_bias():
    errors, outside = [], []
    for seed in range(30):
        r = RB.random_rotation(64, seed)
        y, q = ROWS[:200] @ r.T, ASKED[0] @ r.T
        size, signs = np.linalg.norm(y, axis=1), np.where(y > 0, 1, -1)
        fit = np.abs(y).sum(axis=1) / 8 / size
        got = signs @ q / 8 / fit / np.linalg.norm(q)
        true = y @ q / size / np.linalg.norm(q)
        errors.append(got - true)
        outside.append(np.abs(got - true) > RB.EPSILON * np.sqrt((1 - fit * fit) / (fit * fit)) / np.sqrt(63))
    assert abs(np.mean(errors)) < 0.005 and np.mean(outside) < 0.1


def test_generous_bounds_give_exact_answers(spark, built):
    _, table = built
    q = vectors(spark, ASKED, "qid")
    got = RB.rotated_top_k(q, table, built[0].centroids, built[0].rotation, 10, 6, epsilon=8.0)
    assert found(got) == brute_force(ASKED, ROWS, 10)
    some = RB.rotated_top_k(q, table, built[0].centroids, built[0].rotation, 10, 6, 8.0, F.col("id") >= 2000)
    assert found(some) == [[i + 2000 for i in a] for a in brute_force(ASKED, ROWS[2000:], 10)]


def test_few_rows_copies_and_a_row_at_its_centroid(spark):
    x = np.vstack([np.zeros((3, 8)), np.ones((4, 8)), np.eye(8)]).astype(np.float32)
    cents = ivf.Centroids(np.array([0, 1]), np.vstack([np.zeros(8), np.ones(8)]))
    search = RB.RotatedBits(2, 2, centroids=cents)
    table = search.build(vectors(spark, x))
    assert found(search.search(vectors(spark, x[:4], "qid"), table, 3, "L2")) == brute_force(x[:4], x, 3)
    assert search.search(vectors(spark, x[:1], "qid"), table, 40, "L2").count() == len(x)
    with pytest.raises(ValueError):
        search.search(vectors(spark, x[:1], "qid"), table, 3, "COSINE")


def test_held_rows_are_pruned():
    best = RB.Bounded(2, 3, held=10)
    r = np.random.default_rng(1)
    far = r.random((2, 400))
    for at in range(0, 400, 20):
        best.add(np.arange(2), np.arange(at, at + 20), 0, far[:, at:at + 20], np.full((2, 20), 0.01))
    at, ids, _, lower, upper = best.prune()
    for q in range(2):
        bound = np.sort(far[q])[2] + 0.01
        assert sorted(ids[at == q]) == np.flatnonzero(far[q] - 0.01 <= bound).tolist()
