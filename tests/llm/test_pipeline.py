"""Every stage against a brute-force version on its own input."""

import re

import corpus_pipeline
import pytest

from .conftest import odd_texts
from .test_dedup import slow_components, slow_fingerprint
from .test_text import slow_contamination


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows of `documents` and of each stage's result, as lists of dicts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [("documents", docs.columns, [r.asDict() for r in docs.collect()])]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file:{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append((name, docs.columns, [r.asDict() for r in docs.collect()]))
    return seen


def test_all_but_the_last_return_documents(stages):
    assert len(stages) == 6
    assert all(columns == stages[0][1] for _, columns, _ in stages[:-1])
    key = lambda r: (r["doc_id"], r["text"], r["n_chars"])
    for (_, _, before), (_, _, after) in zip(stages, stages[1:-1]):
        assert {key(r) for r in after} <= {key(r) for r in before}


def test_toxic_documents_go_and_few_clean_ones(spark, sf_dir, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in stages[0][2]} - {r["doc_id"] for r in stages[1][2]}
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in gone for i in clean) <= 0.1 * len(clean)
    assert sum(labels[i] for i in gone if i in labels) >= 5


def test_exact_copies(stages):
    first = {}
    for r in sorted(stages[1][2], key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert {r["doc_id"] for r in stages[2][2]} == set(first.values())


def test_near_copies(stages):
    rows = sorted(stages[2][2], key=lambda r: r["doc_id"])
    label = slow_components([slow_fingerprint(r["text"]) for r in rows])
    first = {}
    for r, c in zip(rows, label):
        first.setdefault(c, r["doc_id"])
    assert {r["doc_id"] for r in stages[3][2]} == set(first.values())


def test_benchmark_passages(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in stages[3][2] if not slow_contamination(r["text"], items)[1]}
    assert {r["doc_id"] for r in stages[4][2]} == clean and len(clean) < len(stages[3][2])


def test_everything_left_is_packed(stages):
    name, columns, rows = stages[5]
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stages[4][2]}
    full = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert full.get(r["sequence_id"], 0) == r["offset"]
        full[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(full.values()) <= 4096


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[5][2])


def test_odd_rows_and_empty_tables(spark, odd, nothing, odd_labels, tmp_path):
    texts = {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in odd_texts()}
    left = len(set(slow_components([slow_fingerprint(t) for t in texts])))
    for k, (docs, labels, want) in enumerate([(odd, odd_labels.limit(0), left), (nothing, odd_labels, 0)]):
        tables = {"documents": docs, "labels": labels, "benchmark": spark.createDataFrame([], "item_id string, text string")}
        for name, df in tables.items():
            df.write.parquet(f"file:{tmp_path}/{k}/{name}.parquet")
        rows = corpus_pipeline.run(spark, f"file:{tmp_path}/{k}").collect()
        assert sum(r.piece == 0 for r in rows) == want
