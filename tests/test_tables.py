"""Versioned tables, lookups by id, and codebook training."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import brute_force, found, vectors
from vectorlab.operators import quantise as QZ
from vectorlab.operators import search as S
from vectorlab.operators.blocks import nearest
from vectorlab.session import BROADCAST_BYTES_KEY
from vectorlab.sources import lookup as LK
from vectorlab.sources.versioned import VersionedTable, compaction_plan

rng = np.random.default_rng(17)
ROWS = rng.normal(size=(2000, 16)).astype(np.float32)
SCHEMA = "id bigint, version bigint, v string"


# --- upserts

def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(table, version=None):
    return {r["file"]: r["bucket"] for r in table.files(version).collect()}


@pytest.fixture()
def table(spark, tmp_path):
    t = VersionedTable(spark, f"file:{tmp_path}/t")
    t.create(spark.createDataFrame([(i, 1, f"a{i}") for i in range(200)], SCHEMA).repartition(3), 16)
    return t


def test_upsert_writes_only_buckets_that_change(spark, table):
    before = files(table)
    assert len(set(before.values())) == 16 and table.read().count() == 200
    new = [(3, 2, "b3"), (3, 3, "c3"), (4, 0, "old"), (900, 1, "d900"), (None, 1, "null"), (5, 1, "same version")]
    assert table.upsert(spark.createDataFrame(new, SCHEMA), "version") == 1
    want = {i: (i, 1, f"a{i}") for i in range(200)} | {3: (3, 3, "c3"), 900: (900, 1, "d900"), None: (None, 1, "null"), 5: (5, 1, "same version")}
    assert rows(table.read()) == sorted(want.values(), key=str)
    touched = {r[0] for r in spark.createDataFrame(new, SCHEMA).select(table._bucket(16)).distinct().collect()}
    after = files(table)
    assert {f for f, b in before.items() if b not in touched} == {f for f in after if f in before} and len(touched) < 16
    assert rows(table.read(0)) == sorted(((i, 1, f"a{i}") for i in range(200)), key=str)  # an older version is still there


def test_upsert_without_an_order_takes_the_new_row_once(spark, table):
    table.upsert(spark.createDataFrame([(7, 1, "x"), (7, 1, "x"), (7, None, "y")], SCHEMA))
    got = [r for r in table.read().where("id = 7").collect()]
    assert len(got) == 1 and got[0]["v"] in ("x", "y") and table.read().count() == 200


def test_a_repeated_delivery_changes_nothing(spark, table):
    new = spark.createDataFrame([(1, 9, "once")], SCHEMA)
    assert table.upsert(new, "version", "batch 1") == 1
    assert table.upsert(new, "version", "batch 1") == 1
    assert table.upsert(new, "version", "batch 2") == 2
    assert table.upsert(new.where("id < 0"), "version", "empty") == 3 and table.read().count() == 200


def test_a_stopped_job_leaves_the_old_version(spark, table, monkeypatch):
    before = rows(table.read())
    new = spark.createDataFrame([(i, 2, "b") for i in range(50)], SCHEMA)

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", stopped)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(new, "version")
    assert table.version() == 0 and rows(table.read()) == before
    assert table.upsert(new, "version") == 1
    assert table.read().where("v = 'b'").count() == 50
    with pytest.raises(Exception, match="(?i)exists"):
        table._commit(1, table.files(), 16, SCHEMA, None)  # the number is taken


def test_tables_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    t = VersionedTable(spark, f"file:{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.create(none, 4)
    assert t.read().count() == 0 and t.read().columns == none.columns and t.compact() == 0
    t.upsert(spark.createDataFrame([(1, 1, "a")], SCHEMA))
    assert rows(t.read()) == [(1, 1, "a")]
    with pytest.raises(FileExistsError):
        t.create(none)


def test_compaction_joins_small_files_only(spark, tmp_path):
    t = VersionedTable(spark, f"file:{tmp_path}/t")
    t.create(vectors(spark, ROWS[:1500]), 2)
    for i in range(4):
        part = vectors(spark, ROWS[1500 + 10 * i:1510 + 10 * i]).withColumn("id", F.col("id") + 1500 + 10 * i)
        t._commit(i + 1, t.files().union(t._write(part.withColumn("_bucket", t._bucket(2)).coalesce(1))), 2, "id bigint, emb array<float>", None)
    before = files(t)
    lengths = {r["file"]: r["bytes"] for r in t.files().collect()}
    large = {f for f, n in lengths.items() if n > 20_000}
    assert len(before) == 10 and len(large) == 2
    q = vectors(spark, ROWS[:5], "qid")
    want = brute_force(ROWS[:5], ROWS[:1540], 6)
    t.compact(30_000)
    after = files(t)
    assert large < set(after) and len(after) == 4 and t.read().count() == 1540
    assert found(S.top_k(q, t.read(), 6)) == want
    assert t.compact(30_000) == t.version()


def test_compaction_plan(spark):
    listed = spark.createDataFrame([(f"f{i}", n) for i, n in enumerate([10, 20, 30, 900, 40, 50, 499, 60])], "file string, bytes bigint")
    plan = {r["file"]: (r["bytes"], r["bin"]) for r in compaction_plan(listed, [], 1000).collect()}
    assert "f3" not in plan and len(plan) == 7
    assert compaction_plan(listed.where("file = 'f0'"), [], 1000).count() == 0


# --- lookups

def rows_scanned(df):
    """Rows that the file scans of a plan handed on."""
    df.collect()

    def total(node):
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            return node.metrics().apply("numOutputRows").value()
        if kind == "AdaptiveSparkPlanExec":
            return total(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return total(node.plan())
        below = node.children()
        return sum(total(below.apply(i)) for i in range(below.size()))

    return total(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def lookup(spark, tmp_path_factory):
    x = rng.normal(size=(20_000, 16)).astype(np.float32)
    path = f"file:{tmp_path_factory.mktemp('lookup')}/t"
    return LK.write_lookup(vectors(spark, x).withColumn("id", F.col("id") * 3), path, 4, row_group_bytes=100_000)


def test_lookup_reads_only_where_ids_lie(spark, lookup):
    wanted = spark.createDataFrame([(30,), (33,), (33,), (30_000,), (59_997,), (31,), (None,), (-5,), (10 ** 12,)], "id bigint")
    df = lookup.candidates_of(wanted)
    got = {r["id"] for r in df.collect()}
    assert {30, 33, 30_000, 59_997} <= got and len(got) <= 9
    assert rows_scanned(df) < 6_000  # of 20,000: row groups that hold a wanted id
    assert len(lookup.files_with(np.array([30, 33]))) == 1 and len(lookup.files_with(np.array([30, 59_997]))) == 2
    assert lookup.files_with(np.array([10 ** 12])) == [] and lookup.candidates_of(wanted.where("id < 0")).count() == 0


def test_lookup_finds_every_id(spark, lookup, monkeypatch):
    some = rng.choice(20_000, 3000, replace=False) * 3
    wanted = spark.createDataFrame([(int(i),) for i in some], "id bigint")
    for most in (200, 7, 1):
        monkeypatch.setattr(LK.id_ranges, "__defaults__", (most,))
        assert set(some.tolist()) <= {r["id"] for r in lookup.candidates_of(wanted).select("id").collect()}
    spark.conf.set(BROADCAST_BYTES_KEY, "100")
    try:
        assert lookup.candidates_of(wanted).count() == 20_000
    finally:
        spark.conf.unset(BROADCAST_BYTES_KEY)


def test_rerank_by_lookup(spark, lookup):
    q = vectors(spark, rng.normal(size=(4, 16)).astype(np.float32), "qid")
    candidates = spark.createDataFrame([(i, int(j) * 3) for i in range(4) for j in rng.choice(20_000, 30, replace=False)], "qid bigint, id bigint")
    want = found(S.rerank(q, lookup.rows(), candidates, 5))
    assert found(LK.rerank_by_lookup(q, lookup, candidates, 5)) == want


def test_id_ranges():
    ids = np.array([1, 2, 3, 10, 11, 50, 100])
    assert LK.id_ranges(ids) == [(1, 3), (10, 11), (50, 50), (100, 100)]
    assert LK.id_ranges(ids, 2) == [(1, 50), (100, 100)] and LK.id_ranges(ids, 1) == [(1, 100)]
    assert LK.id_ranges(ids[:0]) == [] and LK.id_ranges(ids[:1]) == [(1, 1)]


# --- codebooks

def test_codebooks_equal_plain_k_means(spark):
    x = ROWS[:400]
    got = QZ.fit_codebooks(vectors(spark, x), 4, 3, iterations=4)
    first = QZ.first_codebooks(vectors(spark, x), 4, 8)
    for s in range(4):
        part, centres = x[:, 4 * s:4 * s + 4].astype(float), first[s].copy()
        for _ in range(4):
            code = nearest(centres, part)
            centres = np.array([part[code == c].mean(axis=0) if (code == c).any() else centres[c] for c in range(8)])
        assert np.allclose(got[s], centres)


def test_codebook_training_scans_once_an_iteration(spark, monkeypatch):
    calls = []
    sums = QZ.codebook_sums
    monkeypatch.setattr(QZ, "codebook_sums", lambda *a: calls.append(1) or sums(*a))
    QZ.fit_codebooks(vectors(spark, ROWS[:300]), 8, 2, iterations=3)
    assert len(calls) == 3
    parts = sums(vectors(spark, ROWS[:300]), QZ.first_codebooks(vectors(spark, ROWS[:300]), 8, 4))
    assert parts.count() <= 8 * 4 and {r["n"] for r in parts.groupBy("s").agg(F.sum("n").alias("n")).collect()} == {300}


def test_codebooks_of_few_rows_and_a_share(spark):
    few = QZ.fit_codebooks(vectors(spark, ROWS[:3]), 2, 3)
    assert few.shape == (2, 8, 8) and len(np.unique(few[0], axis=0)) == 3
    assert QZ.fit_codebooks(vectors(spark, ROWS), 4, 2, fraction=0.2).shape == (4, 4, 4)
    with pytest.raises(ValueError):
        QZ.fit_codebooks(vectors(spark, ROWS[:9]), 5, 2)
    with pytest.raises(ValueError):
        QZ.fit_codebooks(vectors(spark, ROWS[:9]).where("id < 0"), 4, 2)
