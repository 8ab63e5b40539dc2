import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import brute_force, found, vectors
from vectorlab.functions import metrics as M
from vectorlab.functions import vector as V
from vectorlab.operators import quantise as QZ
from vectorlab.operators import search as S
from vectorlab.operators import vectors as VV
from vectorlab.plans import ivf
from vectorlab.session import BROADCAST_BYTES_KEY, scratch_path
from vectorlab.sources import corpus as SRC

rng = np.random.default_rng(3)
CORPUS = rng.normal(size=(400, 24)).astype(np.float32)
QUERIES = rng.normal(size=(15, 24)).astype(np.float32)


@pytest.fixture(scope="module")
def c(spark):
    return vectors(spark, CORPUS).persist()


@pytest.fixture(scope="module")
def q(spark):
    return vectors(spark, QUERIES, "qid").persist()


def recall(a, b):
    return np.mean([len(set(x) & set(y)) / len(y) for x, y in zip(a, b)])


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_top_k_equals_brute_force(c, q, metric):
    assert found(S.top_k(q, c, 7, metric)) == brute_force(QUERIES, CORPUS, 7, metric)


def test_a_third_of_the_rows_are_copies(spark):
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[500:1700] = x[0]
    asked = np.vstack([x[0], x[0] + 0.01, x[2000]])
    got = found(S.top_k(vectors(spark, asked, "qid"), vectors(spark, x), 20))
    assert got == brute_force(asked, x, 20)
    assert got[0] == [0] + list(range(500, 519))


def test_near_ties_are_ranked_by_exact_distance(spark):
    base = rng.normal(size=16).astype(np.float32)
    x = np.stack([base + np.float32(1e-4) * i * rng.normal(size=16).astype(np.float32) for i in range(500)])
    assert found(S.top_k(vectors(spark, [base], "qid"), vectors(spark, x), 50)) == brute_force([base], x, 50)


def test_query_blocks_give_the_same_answers(spark, c, q):
    expected = found(S.top_k(q, c, 5))
    spark.conf.set(BROADCAST_BYTES_KEY, "1500")
    try:
        assert S.query_blocks(q, 5)[0] > 1
        assert found(S.top_k(q, c, 5)) == expected
        assert found(ivf.bit_top_k(q, c, 5, 80.0)) == expected
    finally:
        spark.conf.unset(BROADCAST_BYTES_KEY)


def test_fewer_rows_than_k(spark, q):
    few = vectors(spark, CORPUS[:3])
    assert [sorted(a) for a in found(S.top_k(q, few, 10))] == [[0, 1, 2]] * len(QUERIES)


def test_empty_corpus_and_empty_queries(spark, c, q):
    assert S.top_k(q, c.filter("id < 0"), 5).count() == 0
    assert S.top_k(q.filter("qid < 0"), c, 5).count() == 0


def test_zero_vector_sorts_last_under_cosine(spark):
    x = np.vstack([np.zeros(4), np.eye(4)]).astype(np.float32)
    rows = S.top_k(vectors(spark, [[1, 0, 0, 0]], "qid"), vectors(spark, x), 5, "COSINE").orderBy("rank").collect()
    assert [r["id"] for r in rows] == [1, 2, 3, 4, 0]
    assert rows[-1]["dist"] is None


def test_stored_vector_is_its_own_neighbour(c):
    for metric in ("L2", "COSINE"):
        near = S.top_k(c.withColumnRenamed("id", "qid"), c, 1, metric)
        assert near.filter("qid <> id").count() == 0 and near.count() == len(CORPUS)


def test_filter_is_applied_before_the_top_k(c, q):
    got = found(S.top_k(q, c, 10, "L2", F.col("id") >= 300))
    assert all(len(a) == 10 and min(a) >= 300 for a in got)


def test_vectors_of_different_lengths_are_an_error(spark, q):
    ragged = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "id bigint, emb array<float>")
    with pytest.raises(Exception, match="different lengths"):
        S.top_k(q.select("qid", F.slice("emb", 1, 2).alias("emb")), ragged.coalesce(1), 1).collect()


def test_bit_distances(spark):
    a, b = rng.integers(0, 2, (2, 30, 40)) * 2.0 - 1.0
    ha = (a > 0)[:, None, :] != (b > 0)[None]
    both, either = ((a > 0)[:, None, :] & (b > 0)[None]).sum(2), ((a > 0)[:, None, :] | (b > 0)[None]).sum(2)
    for metric, d in (("HAMMING", ha.sum(2)), ("JACCARD", 1 - both / either)):
        got = found(S.top_k(QZ.bit_codes(vectors(spark, a, "qid"), ["qid"]), QZ.bit_codes(vectors(spark, b)), 4, metric))
        assert got == [np.lexsort((np.arange(30), row))[:4].tolist() for row in d]


def test_packed_bits_equal_the_array_library(spark):
    x = rng.normal(size=(20, 21)).astype(np.float32)
    expected = np.packbits(x > 0, axis=1).astype(np.int8).tolist()
    df = vectors(spark, x)
    assert [r["emb"] for r in QZ.bit_codes(df).orderBy("id").collect()] == expected
    by_expression = df.select("id", V.pack_bytes(V.sign_bits(F.col("emb"))).alias("b")).orderBy("id")
    assert [r["b"] for r in by_expression.collect()] == expected


def test_empty_codes_are_at_jaccard_distance_one(spark):
    row = spark.range(1).select(V.jaccard_distance(F.array(F.lit(0)), F.array(F.lit(0))).alias("d")).first()
    assert row["d"] == 1.0


def test_normalising_keeps_the_cosine_order(c, q):
    name, first = M.after_normalising("COSINE", target="IP")
    assert (name, first) == ("IP", True) and M.after_normalising("COSINE", True) == ("COSINE", False)
    unit = [df.withColumn("emb", V.normalise(F.col("emb"))) for df in (q, c)]
    assert found(S.top_k(*unit, 10, name)) == found(S.top_k(q, c, 10, "COSINE"))


def test_zero_vector_normalises_to_nulls(spark):
    row = spark.range(1).select(V.normalise(F.array(F.lit(0.0), F.lit(0.0))).alias("v")).first()
    assert row["v"] == [None, None]


def test_unknown_metric_is_an_error():
    with pytest.raises(ValueError, match="unknown metric"):
        M.metric("MANHATTAN")
    assert M.metric("euclidean").name == "L2" and M.metric("dp") is M.metric("IP")


def test_single_query_equals_the_batch(c):
    got = [r["id"] for r in S.top_k_one(QUERIES[0].tolist(), c, 9).orderBy("dist", "id").collect()]
    assert got == brute_force(QUERIES[:1], CORPUS, 9)[0]


def test_radius_search(c, q):
    dist = np.sqrt(((QUERIES[:, None].astype(float) - CORPUS[None].astype(float)) ** 2).sum(2))
    radius = float(np.sort(dist, axis=1)[:, 6].mean())
    rows = S.radius_search(q, c, radius, 10, 4).collect()
    inside = (dist <= radius).sum(1)
    assert len(rows) == np.minimum(inside, 10).sum()
    assert all(r["enough"] == (min(inside[r["qid"]], 10) >= 4) for r in rows)


def test_candidate_width():
    assert S.candidate_width(10, 2.59) == 25 and S.candidate_width(10, 0.5) == 10
    assert S.candidate_width(100, 500, cap=10_000) == 10_000


def test_reranking_all_candidates_equals_flat_and_recall_grows(c, q):
    exact = found(S.top_k(q, c, 10))
    recalls = [recall(found(ivf.bit_top_k(q, c, 10, r)), exact) for r in (1.0, 4.0, 40.0)]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_scalar_codes_lose_little_and_rescoring_repairs(c, q):
    exact = found(S.top_k(q, c, 10))
    assert recall(found(ivf.scalar_top_k(q, c, 10, 1, rescore=False)), exact) > 0.95
    assert found(ivf.scalar_top_k(q, c, 10, 3.0)) == exact


def test_product_codes(c, q):
    books = QZ.fit_codebooks(c, 6, 5, iterations=4)
    assert books.shape == (6, 32, 4)
    codes = QZ.product_codes(c, books)
    got = found(S.product_top_k(q, codes, books, 10))
    stored = {r["id"]: r["emb"] for r in codes.collect()}
    decoded = np.stack([np.concatenate([books[s, code] for s, code in enumerate(stored[i])]) for i in range(len(CORPUS))])
    d = ((QUERIES[:, None].astype(float) - decoded[None]) ** 2).sum(2)
    assert recall(got, [np.argsort(row, kind="stable")[:10].tolist() for row in d]) > 0.99


@pytest.fixture(scope="module")
def lists(spark, c):
    cents = ivf.Centroids.train(c, 8, iterations=5)
    return ivf.write_lists(ivf.assign(c, cents), scratch_path(spark, "lists")), cents


def test_probing_every_list_equals_flat_and_recall_grows(c, q, lists):
    table, cents = lists
    exact = found(S.top_k(q, c, 10))
    recalls = [recall(found(ivf.ivf_top_k(q, table, cents, 10, n)), exact) for n in (1, 3, 8)]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_coded_lists(spark, c, q, lists):
    table, cents = lists
    exact = found(S.top_k(q, c, 10))
    stored = ivf.store_scalar_lists(c, cents, scratch_path(spark, "scalar-lists"))
    assert recall(found(ivf.ivf_scalar_top_k(q, stored, cents, 10, 8)), exact) > 0.95
    coded = ivf.write_lists(ivf.residual_codes(c, cents), scratch_path(spark, "bits"))
    assert found(ivf.ivf_bit_top_k(q, coded, cents, 10, 8, 40)) == exact
    books = QZ.fit_codebooks(c, 6, 5, iterations=4)
    products = ivf.store_product_lists(c, cents, books, scratch_path(spark, "product-lists"))
    assert found(ivf.ivf_product_top_k(q, products, cents, 10, 8, books)) == found(
        S.product_top_k(q, QZ.product_codes(c, books), books, 10))
    for got in (ivf.ivf_scalar_top_k(q, stored, cents, 10, 2), ivf.ivf_product_top_k(q, products, cents, 10, 2, books)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
        assert "list_id" in scan.split("PartitionFilters")[1].split("]")[0]  # unprobed lists are not read


def test_scalar_codes_are_stored_once(spark, c, q):
    exact = found(S.top_k(q, c, 10))
    stored, decode = ivf.store_scalar_codes(c, scratch_path(spark, "scalar"))
    assert found(ivf.scalar_top_k(q, stored, 10, 3.0, decode=decode)) == exact == found(ivf.scalar_top_k(q, c, 10, 3.0))
    coarse = ivf.scalar_top_k(q, stored, 10, 1, rescore=False, decode=decode)
    assert "emb" not in coarse._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]


def test_centroids_above_the_limit_are_refused(spark, c):
    spark.conf.set(BROADCAST_BYTES_KEY, "1000")
    try:
        with pytest.raises(ValueError, match="broadcast limit"):
            ivf.Centroids.from_frame(c.withColumnRenamed("id", "list_id"))
    finally:
        spark.conf.unset(BROADCAST_BYTES_KEY)


def test_mean_vectors(spark, c):
    keyed = c.withColumn("key", F.col("id") % 3)
    got = {r["key"]: r["emb"] for r in VV.mean_vectors(keyed, "key").collect()}
    for k in range(3):
        np.testing.assert_allclose(got[k], CORPUS[k::3].astype(float).mean(axis=0), atol=1e-12)


@pytest.mark.parametrize("outlier", [1.0, 1e6])
def test_dimension_quantiles(spark, outlier):
    x = rng.normal(size=(1500, 5)).astype(np.float32)
    x[7, 2] = outlier
    levels = [0.005, 0.5, 0.995]
    got = QZ.dimension_quantiles(vectors(spark, x), "emb", levels).orderBy("level", "dim").collect()
    np.testing.assert_allclose([r["value"] for r in got], np.quantile(x.astype(float), levels, axis=0).ravel(), rtol=1e-12)


def test_storage_types(spark):
    x = rng.normal(size=(10, 6)).astype(np.float32)
    rows = vectors(spark, x).select("id", V.half_precision("emb").alias("h"), V.bfloat16("emb").alias("b")).orderBy("id").collect()
    np.testing.assert_array_equal([r["h"] for r in rows], x.astype(np.float16).astype(np.float32))
    np.testing.assert_array_equal([r["b"] for r in rows], (x.view(np.uint32) & 0xFFFF0000).view(np.float32))


def plan(df):
    return df._jdf.queryExecution().toString()


def test_plans(spark, c, q, lists):
    stored = SRC.write_by_label(c.withColumn("labels", F.when(F.col("id") < 20, "label_5p").otherwise("label_50p")),
                                scratch_path(spark, "labels"))
    text = plan(S.top_k(q, stored, 10, "L2", F.col("labels") == "label_5p"))
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "PartitionFilters: [isnotnull(labels" in text
    table, cents = lists
    assert "PartitionFilters: [list_id" in plan(ivf.ivf_top_k(q, table, cents, 10, 2))
    text = plan(ivf.bit_top_k(q, c, 10, 5.0))
    assert "BroadcastHashJoin" in text and "SortMergeJoin [id" not in text
    pushed = plan(S.top_k(q, SRC.write_sorted(c, scratch_path(spark, "sorted")), 10, "L2", F.col("id") >= 300))
    assert "GreaterThanOrEqual(id,300)" in pushed


def test_small_batches_are_joined(spark, c, q):
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + n), pa.int64())], ["x"]) for i, n in ((0, 3), (3, 0), (3, 4), (7, 10), (17, 1))]
    joined = list(S.full_batches(iter(batches), 6))
    assert [b.num_rows for b in joined] == [7, 10, 1] and [v for b in joined for v in b["x"].to_pylist()] == list(range(18))
    assert list(S.full_batches(iter([]))) == []
    expected, key = found(S.top_k(q, c, 5)), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        assert found(S.top_k(q, c, 5)) == expected
    finally:
        spark.conf.set(key, before)
