import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import vectors
from vectorlab.operators import search as S
from vectorlab.plans import performance as PF
from vectorlab.streaming import stages as ST
from vectorlab.streaming.ingest import StagedIngest

X = np.random.default_rng(11).normal(size=(250, 8)).astype(np.float32)


@pytest.fixture()
def source(spark, tmp_path):
    c = vectors(spark, X)
    for i in range(5):
        c.filter((F.col("id") >= i * 50) & (F.col("id") < i * 50 + 50)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")
    return c, str(tmp_path)


def ingest(spark, c, root, **kw):
    q = c.filter("id < 6").withColumnRenamed("id", "qid")
    return StagedIngest(spark, root, q, S.ground_truth(q, c, 5), len(X), 50, k=5, **kw)


def rows_of(run):
    return sorted((r["id"], tuple(r["emb"])) for r in run.rows().collect())


def test_stages_and_batches(spark, source):
    c, root = source
    many = ingest(spark, c, f"{root}/many", stages=(0.8, 0.4))
    many.run(f"{root}/source")
    stages = {r["stage"]: r for r in many.finish().collect()}
    assert sorted(stages) == [40, 80, 100, 110]
    assert [stages[s]["visible_rows"] for s in (40, 80, 100, 110)] == [100, 200, 250, 250]
    assert stages[40]["recall"] < stages[80]["recall"] <= 1.0 and stages[110]["recall"] == 1.0
    assert [r["rows"] for r in many.progress().orderBy("batch_id").collect()] == [50] * 5
    single = ingest(spark, c, f"{root}/single", stages=())
    single.run(f"{root}/source", files_per_trigger=100)
    assert single.progress().count() == 1 and rows_of(single) == rows_of(many)


def test_every_row_is_compared_once_and_answers_are_carried(spark, source):
    c, root = source
    compared = []

    def counting(queries, rows, k, metric):
        compared.append(rows.count())
        return S.top_k(queries, rows, k, metric)

    run = ingest(spark, c, f"{root}/run", stages=(0.2, 0.4, 0.6, 0.8), search=counting)
    run.run(f"{root}/source")
    assert {r["stage"] for r in run.finish(optimise=False).collect()} == {20, 40, 60, 80, 100}
    assert compared == [50] * 5
    for batch in range(5):
        seen = X[:50 * batch + 50]
        q = np.linalg.norm(seen[None] - X[:6, None], axis=2)
        want = [np.lexsort((np.arange(len(seen)), d))[:5].tolist() for d in q]
        lists = {r["qid"]: r["ids"] for r in S.answer_lists(run.answers(batch)).collect()}
        assert [lists[i] for i in range(6)] == want
    before = [sorted(map(tuple, run.answers(b).collect())) for b in range(5)]
    again = run.rows().filter("batch_id = 2").select("id", "emb").collect()
    run.take_batch(spark.createDataFrame(again, "id bigint, emb array<float>"), 2)
    assert [sorted(map(tuple, run.answers(b).collect())) for b in range(5)] == before


def test_repeated_batch_and_restart_change_nothing(spark, source):
    c, root = source
    run = ingest(spark, c, f"{root}/run", stages=(0.4,))
    run.run(f"{root}/source")
    before, stages = rows_of(run), run.stage_rows().select("stage", "visible_rows", "recall").collect()
    again = spark.createDataFrame(run.rows().filter("batch_id = 3").select("id", "emb").collect(), "id bigint, emb array<float>")
    run.take_batch(again, 3)
    resumed = ingest(spark, c, f"{root}/run", stages=(0.4,))
    resumed.run(f"{root}/source")
    assert rows_of(resumed) == before and len(before) == len(X)
    assert resumed.stage_rows().select("stage", "visible_rows", "recall").collect() == stages


def test_compacted_table_is_sorted_and_smaller(spark, source):
    c, root = source
    run = ingest(spark, c, f"{root}/run", stages=())
    run.run(f"{root}/source")
    table = run.optimise(files=2)
    assert table.count() == len(X) and len(table.inputFiles()) <= 2


def test_rows_per_second_as_a_stream(spark, source, tmp_path):
    c, root = source
    run = ingest(spark, c, f"{root}/run", stages=())
    run.run(f"{root}/source")
    plain = run.progress().select("rows", "done_ts").repartition(1)
    plain.write.parquet(f"{root}/log")
    stream = spark.readStream.schema(plain.schema).parquet(f"{root}/log")
    q = (ST.rows_per_second(stream, late="10 seconds").writeStream.outputMode("complete").format("memory").queryName("per_second")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT sum(rows) FROM per_second").first()[0] == len(X)


def test_every_search_method_through_one_call(spark, source):
    c, _ = source
    q = c.filter("id < 10").withColumnRenamed("id", "qid")
    methods = [PF.Flat(), PF.BitCodes(len(X) / 5), PF.ScalarCodes(3.0), PF.ProductCodes(4, 4), PF.InvertedFile(5, 5)]
    rows = {r["searcher"]: r for r in PF.sweep(methods, c, q, 5).collect()}
    assert len(rows) == 5 and all(rows[m]["recall"] == 1.0 for m in ("Flat", "BitCodes", "ScalarCodes", "InvertedFile"))
    assert 0.2 < rows["ProductCodes"]["recall"] < 1.0 and all(r["loaded_rows"] == len(X) for r in rows.values())
