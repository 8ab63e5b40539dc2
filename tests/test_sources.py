import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from vectorlab.functions import text as X
from vectorlab.operators import analytics as A
from vectorlab.operators import filters as FL
from vectorlab.plans import cases as CS
from vectorlab.session import scratch_path
from vectorlab.sources import corpus as SRC
from vectorlab.sources import results as RS


def metrics(**m):
    base = {"max_load_count": 0, "qps": 0.0, "serial_latency_p99": 0.0, "recall": 0.0}
    return {**base, **m}


def case(db, label, case_id, m, status=":)", **config):
    return {"metrics": m, "label": status, "task_config": {
        "db": db, "db_config": {"db_label": label, "version": "", "note": "", **config},
        "db_case_config": {"index": "FLAT", "null": None},
        "case_config": {"case_id": case_id, "custom_case": None, "k": 100}}}


@pytest.fixture()
def archive(tmp_path):
    """A new file, an old one, a broken one and two files of one run."""
    def put(name, value):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text(value if isinstance(value, str) else json.dumps(value, indent=1))

    new = metrics(qps=100.0, load_duration=5.0, serial_latency_p99=0.01, serial_latency_p95=0.008, recall=0.9,
                  conc_num_list=[1, 5, 10], conc_qps_list=[10.0, 50.0], conc_latency_p99_list=[0.1, 0.2, 0.3])
    old = metrics(qps=7.0, load_dur=3.0, serial_latency_p99=0.5, recall=0.8, max_load_count=4000)
    put("Alpha/result_20240101_standard_alpha.json",
        {"run_id": "aaaa1", "task_label": "standard", "timestamp": 1.7e9, "results": [case("Alpha", "4c", 5, new, password="p")]})
    put("Beta/result_20230701_old_beta.json", {"run_id": "bbbb2", "results": [case("Beta", "", 7, old), case("Beta", "", 5, old, "x")]})
    put("Gamma/result_20240102_a_gamma.json", {"run_id": "cccc3", "task_label": "first", "results": [case("Gamma", "s", 4, old)]})
    put("Gamma/result_20240103_b_gamma.json", {"run_id": "cccc3", "task_label": "second", "results": [case("Gamma", "s", 5, old)]})
    put("Gamma/result_20240104_c_gamma.json", '{"run_id": "dddd4", "results": [')
    put("Gamma/notes.json", "{}")
    return str(tmp_path)


def test_archive(spark, archive):
    good, bad = RS.read_result_files(spark, archive)
    assert good.count() == 4 and bad.count() == 1
    flat = {(r["run_id"], r["case_id"]): r for r in RS.flat_cases(good, change_units=True).collect()}
    assert len(flat) == 5
    a, b = flat["aaaa1", 5], flat["bbbb2", 7]
    assert (a["db_name"], a["load_duration"], a["serial_latency_p99"], a["serial_latency_p95"]) == ("Alpha-4c", 5.0, 10.0, 8.0)
    assert (b["db_name"], b["load_duration"], b["serial_latency_p95"], b["max_load_count"], b["task_label"]) == (
        "Beta", 3.0, 0.0, 4.0, "bbbb2")
    assert a["index_options"] == {"index": "FLAT"}
    assert {flat["cccc3", 4]["task_label"], flat["cccc3", 5]["task_label"]} == {"first"}
    headers = {r["run_id"]: r["files"] for r in RS.run_headers(good).collect()}
    assert headers["cccc3"] == 2


def test_flat_report(spark, archive):
    good, _ = RS.read_result_files(spark, archive)
    rows = RS.per_concurrency_rows(good).collect()
    assert list(rows[0].asDict()) == RS.REPORT
    alpha = sorted((r for r in rows if r["db"] == "standard_alpha"), key=lambda r: r["concurrency"])
    assert [(r["concurrency"], r["qps"], r["latency_p99"], r["recall"]) for r in alpha] == [
        (1, 10.0, 0.1, None), (5, 50.0, 0.2, None), (10, None, 0.3, None)]
    beta = [r for r in rows if r["db"] == "old_beta"]
    assert len(beta) == 2 and all(r["concurrency"] is None and r["qps"] == 7.0 and r["load_duration"] == 3.0 for r in beta)
    path = scratch_path(spark, "csv")
    RS.write_csv(RS.per_concurrency_rows(good), path)
    assert RS.read_csv(spark, path, "db string, task_label string").count() == len(rows)


def test_written_results_have_no_secrets(spark, archive):
    spec = ("run_id string, results array<struct<metrics: struct<qps: double>, task_config: struct<db: string, "
            "db_config: struct<db_label: string, password: string, api_key: string>>>>")
    raw = spark.read.schema(spec).option("multiLine", True).json(f"{archive}/Alpha")
    rows = raw.select("run_id", F.explode("results").alias("r")).withColumn("db", F.col("r.task_config.db"))
    assert rows.select("r.task_config.db_config.password").first()[0] == "p"
    root = scratch_path(spark, "out")
    RS.write_results(rows, root)
    text = spark.read.text(root).collect()
    assert len(text) == 1 and "password" not in text[0][0] and "4c" in text[0][0]


def test_merge_runs(spark):
    rows = [("a", "c", 1.0, "x", 1), ("a", "c", 9.0, ":)", 2), ("a", "c", 9.0, "x", 3), ("a", "d", 0.0, "x", 4), ("a", "d", 0.0, "?", 5)]
    df = spark.createDataFrame(rows, "db_name string, case_name string, qps double, status string, seq bigint")
    got = {r["case_name"]: (r["qps"], r["seq"], r["status"]) for r in A.merge_runs(df, ["db_name", "case_name"]).collect()}
    assert got == {"c": (9.0, 3, ":)"), "d": (0.0, 5, "?")}
    failed = A.failed_backends(A.merge_runs(df, ["db_name", "case_name"])).collect()
    assert [(r["case_name"], r["status"], r["db_name"]) for r in failed] == [("d", "?", "a")]


def test_prices(spark, tmp_path):
    (tmp_path / "prices.json").write_text(json.dumps({"Alpha": {"4c": 2.0}, "Beta": {"": 0.5}}, indent=2))
    prices = RS.read_prices(spark, str(tmp_path / "prices.json"))
    rows = spark.createDataFrame([("Alpha", "4c", 100.0), ("Alpha", "8c", 100.0), ("Free", "", 5.0)], "db string, db_label string, qps double")
    got = {r["db_label"]: r["qpd"] for r in A.dollar_chart(rows, prices).collect()}
    assert got == {"4c": 100.0 / 2 * 3.6, "8c": None, "": None}
    listed = A.price_list(rows, prices, ["Free"]).collect()
    assert [(r["db"], r["db_label"], r["price"]) for r in listed] == [("Alpha", "4c", 2.0), ("Alpha", "8c", 0.0)]


def test_leaderboard(spark, archive):
    good, _ = RS.read_result_files(spark, archive)
    rows = CS.with_case(RS.flat_cases(good), CS.case_table(spark))
    prices = spark.createDataFrame([("Alpha", "4c", 2.0)], "db string, db_label string, price double")
    board = A.leaderboard(rows, prices, list(CS.CAPACITY_CASES), {"Alpha": "2023-01-01"}).collect()
    assert [(r["db_name"], r["label"], r["test_time"], r["qp$"]) for r in board] == [("Alpha-4c", 1, "2023-11", 100.0 / 2 * 3600)]
    late = A.leaderboard(rows, prices, list(CS.CAPACITY_CASES), {"Alpha": "2024-06-01"})
    assert late.count() == 0


def test_stage_value_is_null_when_missing(spark):
    row = spark.range(1).select(A.at_stage(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(50), F.lit(90)), 90).alias("a"),
                                A.at_stage(F.array(F.lit(1.0)), F.array(F.lit(50)), 90).alias("b"),
                                A.at_stage(F.array(F.lit(1.0)), F.array(F.lit(50), F.lit(90)), 90).alias("c")).first()
    assert (row["a"], row["b"], row["c"]) == (2.0, None, None)


def test_cases(spark):
    rows = {r["case_id"]: r for r in CS.case_table(spark).collect()}
    assert len(rows) == 23
    assert rows[6]["case_name"] == "Filtering Search Performance Test (10M Dataset, 768 Dim, Filter 1%)"
    assert rows[2]["case_name"] == "Capacity Test (960 Dim Repeated)" and rows[3]["metric"] == "L2"
    assert CS.dataset("cohere", 1_000_000).folder == "cohere_medium_1m"
    assert CS.dataset_by_choice("Large OpenAI (1536dim, 5M)").file_count == 10
    for bad in (("Cohere", 7), ("Nothing", 100_000)):
        with pytest.raises(ValueError):
            CS.dataset(*bad)
    with pytest.raises(ValueError):
        CS.dataset_by_choice("Huge Cohere")


def test_old_filter_cases_become_parametric(spark):
    case_id, custom = CS.as_parametric(F.col("c"), F.col("m"))
    df = spark.createDataFrame([(14, None), (5, {"k": "1"})], "c int, m map<string,string>").select(case_id.alias("c"), custom.alias("m"))
    assert [tuple(r) for r in df.orderBy("c").collect()] == [
        (5, {"k": "1"}), (400, {"filter_rate": "0.99", "dataset_with_size_type": "Medium OpenAI (1536dim, 500K)"})]


def test_file_names():
    assert SRC.train_files(1) == ["train.parquet"] and SRC.train_files(1, True) == ["shuffle_train.parquet"]
    assert SRC.train_files(10, True)[9] == "shuffle_train-09-of-10.parquet"
    assert SRC.train_files(100)[99] == "train-99-of-100.parquet" and len(SRC.train_files(50)) == 50
    assert FL.NoFilter().truth_file == "neighbors.parquet"
    assert FL.IdFilter(100, 0.5).truth_file == "neighbors_int_50p.parquet"
    assert FL.IdFilter(100, 0.995).truth_file == "neighbors_int_99.5p.parquet"
    assert FL.IdFilter(100, 0.01, named_by_rate=False).truth_file == "neighbors_head_1p.parquet"
    assert FL.LabelFilter(0.05).truth_file == "neighbors_labels_label_5p.parquet"
    assert FL.LabelFilter(0.001).value == "label_0.1p"
    with pytest.raises(ValueError):
        FL.IdFilter(100, 0.5, named_by_rate=False).truth_file


def test_layouts(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, [1.0]), (2, [2.0])], "k int, v array<double>").write.parquet(f"{root}/a.parquet")
    spark.createDataFrame([(3, [3.0])], "k int, v array<double>").write.parquet(f"{root}/b.parquet")
    layout = SRC.Layout.custom(root, "a, b,", id_column="k", emb_column="v")
    assert sorted((r["id"], r["emb"]) for r in layout.read_corpus(spark).collect()) == [(1, [1.0]), (2, [2.0]), (3, [3.0])]
    with pytest.raises(FileNotFoundError):
        SRC.Layout.split(root, 2).read_corpus(spark)
    assert layout.read_truth(spark).count() == 0
    assert layout.read_labels(spark, FL.NoFilter()) is None and layout.read_labels(spark, FL.LabelFilter(0.1)).count() == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id bigint, emb array<float>")
    ok, bad = FL.split_by_dimension(df, 2)
    assert ok.count() == 1 and sorted(r["id"] for r in bad.collect()) == [2, 3]
    with pytest.raises(Exception, match="vector length is not 2"):
        df.select(FL.require_dimension(F.col("emb"), 2)).collect()
    assert FL.column_counts(df, "id", "emb").first()["equal"] is False


def test_paths_and_titles(spark):
    paths = ["r/Qdrant/result_20251118_bench_qdrantlocal.json", "r/Qdrant/result_2025.json", "r/Qdrant/result.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    label, db = X.file_label_and_db(F.col("p"))
    assert [tuple(r) for r in df.select(label, db).collect()] == [
        ("20251118", "bench_qdrantlocal"), ("2025", "Qdrant"), ("", "Qdrant")]
    titles = spark.createDataFrame([("abcdef", "abcdef"), ("label", "abcdef")], "l string, r string")
    assert [r[0] for r in titles.select(X.run_title(F.col("l"), F.col("r"))).collect()] == ["res-abcd", "label"]


def test_replicated_ids_stay_unique(spark):
    df = SRC.replicated(spark.range(10).withColumn("emb", F.array(F.lit(1.0))), 3, 10)
    assert df.select("id").distinct().count() == 30 and df.agg(F.max("id")).first()[0] == 29


def test_workers_know_the_package_wherever_the_driver_runs(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from vectorlab.session import build_session
from vectorlab.operators import search as S
spark = build_session("elsewhere", "local[2]", 2)
rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "id bigint, emb array<float>")
print("rows", S.top_k(rows.withColumnRenamed("id", "qid"), rows, 2, "L2").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "rows 40" in done.stdout, done.stderr[-2000:]
