"""What must not grow faster than the tables: cells of the grid, steps of running values, bytes of archives."""

import os

import numpy as np
import pytest

from vectorlab.operators import frontier, grid
from vectorlab.operators.blocks import Space, TopK
from vectorlab.registry import results, scoring
from vectorlab.registry import vectors as queries
from vectorlab.sources import results as RS

from .conftest import vectors


def cosine_distance(q, x):
    """From q to every row of x, summed from left to right; infinite where missing."""
    with np.errstate(all="ignore"):
        size = np.sqrt((x * x).cumsum(axis=1)[:, -1] * (q * q).cumsum()[-1])
        dist = np.where(size > 0, 1 - (x * q).cumsum(axis=1)[:, -1] / size, np.inf)
    return np.where(np.isnan(dist), np.inf, dist)


def test_ground_truth_of_every_row_meets_in_few_cells(spark, tmp_path, monkeypatch):
    x = np.random.default_rng(3).normal(size=(900, 64)).astype(np.float32)
    x[200:260] = x[5]  # more copies than answers
    vectors(spark, x, "vec_id", parts=2).withColumnsRenamed({"emb": "embedding"}).selectExpr("*", "1 AS label").write.parquet(f"{tmp_path}/embeddings.parquet")
    blocks, packed = [], grid.packed
    monkeypatch.setattr(grid, "packed", lambda *args, **named: blocks.append(packed(*args, **named)) or blocks[-1])
    rows = queries.whole_truth(spark, str(tmp_path)).collect()
    assert [b.count() <= 2 for b in blocks] == [True, True]  # one for each part, not one for each 64 rows
    scaled = x.astype(float) * (1 + np.arange(len(x)) % 3)[:, None]
    got = [[r.neighbor for r in sorted((r for r in rows if r.id == i), key=lambda r: r.position)] for i in (0, 5, 230, 899)]
    assert got == [np.lexsort((np.arange(900), cosine_distance(scaled[i], scaled)))[:10].tolist() for i in (0, 5, 230, 899)]


@pytest.mark.parametrize("length", [1e-200, 1e-90, 1e-30, 1.0, 1e30, 1e90, 1e200])
def test_cosine_of_any_length(length):
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(300, 8)), rng.normal(size=(5, 8))
    x[::7] *= length
    x[3], x[11, 2], q[4] = 0, np.nan, q[4] * length
    dist = np.stack([cosine_distance(row, x) for row in q])
    best = TopK(Space("COSINE", q), 6)
    for part in np.array_split(np.arange(300), 4):
        best.add(part, x[part])
    assert best.ids.tolist() == [np.lexsort((np.arange(300), d))[:6].tolist() for d in dist]
    assert np.array_equal(best.dist, np.sort(dist, axis=1)[:, :6])


def test_frontier_takes_each_point_once(spark):
    rng = np.random.default_rng(5)
    rows = [("a" if i % 7 else "b", float(rng.integers(0, 40)) if i % 50 else None, float(rng.integers(0, 90)) if i % 31 else None, i) for i in range(3000)]
    points = spark.createDataFrame(rows, "db string, recall double, qps double, seq bigint").repartition(6)
    parts = dict(zip((True, False), frontier.split_frontier(points, ["db"])))
    for on, part in parts.items():
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan  # a frame that ends with the window is quadratic
        want, latest = [], {}
        for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[3]), reverse=True):
            later = latest.get(r[0])
            if (later is None or (None if r[2] is None else r[2] >= later)) is on:
                want.append(r)
            if r[2] is not None:
                latest[r[0]] = r[2] if later is None else max(later, r[2])
        assert sorted(map(tuple, part.collect()), key=lambda r: r[3]) == sorted(want, key=lambda r: r[3])


def test_points_of_one_position_keep_their_order(spark):
    points = spark.createDataFrame([("a", 0.5, q, 1) for q in (5.0, 3.0, 4.0)], "db string, recall double, qps double, seq bigint").coalesce(1)
    best, rest = frontier.split_frontier(points, ["db"])
    assert sorted(r.qps for r in best.collect()) == [4.0, 5.0] and [r.qps for r in rest.collect()] == [3.0]


@pytest.mark.parametrize("query, on", [(scoring.off_frontier, False), (scoring.frontier, True)])
def test_frontier_queries_over_one_large_group(spark, tmp_path, query, on):
    n = 40_000
    spark.range(n).selectExpr("id AS p_partkey", "'Brand#1' AS p_brand", "CAST(id * 7919 % 50 AS int) AS p_size", "CAST(id * 104729 % 10007 AS double) AS p_retailprice").write.parquet(
        f"{tmp_path}/part.parquet")
    got = query(spark, str(tmp_path))
    assert "unboundedfollowing" not in got._jdf.queryExecution().executedPlan().toString()
    i = np.arange(n)
    order = np.lexsort((i, i * 7919 % 50))
    speed = (i * 104729 % 10007)[order].astype(float)
    later = np.append(np.maximum.accumulate(speed[::-1])[::-1][1:], -1)
    assert sorted(r.seq for r in got.collect()) == sorted(order[(speed >= later) == on].tolist())


def written(root):
    """(files, bytes) of the parts below a folder."""
    parts = [os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.startswith("part-")]
    return len(parts), sum(map(os.path.getsize, parts))


def order_rows(spark, n, path):
    """Orders in two files; every run has several."""
    spark.range(0, n, 1, 2).selectExpr(
        "id AS o_orderkey", f"id * 31 % {n // 4} AS o_custkey", "element_at(array('F', 'O', 'P'), CAST(id % 3 AS int) + 1) AS o_orderstatus",
        "round(900 + id * 7919 % 100003 / 7, 2) AS o_totalprice", "timestamp_seconds(820454400 + id % 900 * 86400) AS o_orderdate",
        "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), CAST(id % 4 AS int) + 1) AS o_orderpriority").write.parquet(f"{path}/orders.parquet")


def test_written_results_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    order_rows(spark, 1200, tmp_path)
    monkeypatch.setattr(RS, "COMPRESSED", getattr(RS, "COMPRESSED", {}) | {"maxRecordsPerFile": 100}, raising=False)
    root, write = [], RS.write_results
    monkeypatch.setattr(RS, "write_results", lambda rows, path: root.append(path) or write(rows, path))
    got = {r.db: (r.n, r.qps) for r in results.write_results(spark, str(tmp_path)).collect()}
    prices = {db: [round(900 + i * 7919 % 100003 / 7, 2) for i in range(k, 1200, 4)] for k, db in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"))}
    assert {db: (n, round(qps, 1)) for db, (n, qps) in got.items()} == {db: (600, round(1.5 * sum(p), 1)) for db, p in prices.items()}
    files, size = written(root[0])
    assert files >= 24 and spark.read.text(root[0]).selectExpr("sum(length(value))").first()[0] > 5 * size


def test_archive_is_read_from_compressed_bounded_files(spark, tmp_path, monkeypatch):
    order_rows(spark, 1200, tmp_path)
    monkeypatch.setattr(RS, "COMPRESSED", getattr(RS, "COMPRESSED", {}) | {"maxRecordsPerFile": 100}, raising=False)
    root, read = [], RS.read_result_files
    monkeypatch.setattr(RS, "read_result_files", lambda spark, path, **named: root.append(path) or read(spark, path, **named))
    got = results.read_result_files(spark, str(tmp_path))
    direct = results.flatten_results(spark, str(tmp_path))
    assert got.count() == 2400 and sorted(map(repr, got.collect())) == sorted(map(repr, direct.select(got.columns).collect()))
    files, size = written(root[0])
    assert files >= 12 and spark.read.text(root[0]).selectExpr("sum(length(value))").first()[0] > 5 * size
