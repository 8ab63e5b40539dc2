"""Corpus files, stored tables, streaming ingest and whole cases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import vector as V
from ..functions.numbers import round4
from ..operators import filters as FL
from ..operators import frontier as FR
from ..operators import search as S
from ..plans import ivf as IVF
from ..plans import performance as PF
from ..session import materialise, scratch_path
from ..sources import corpus as SRC
from ..sources.versioned import VersionedTable
from ..streaming.ingest import StagedIngest
from .base import C, L2, Q, corpus, profiles, query, r6, table, top_sql
from .vectors import SHARE_SQL, _CENTRES, centroids, share_labels

_TOTALS = "SELECT vec_id AS id, len(embedding)::BIGINT AS dim, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings"


def _totals(df):
    total = F.aggregate(V.as_double(F.col("emb")), F.lit(0.0).cast("double"), lambda a, x: a + x)
    return df.select("id", F.size("emb").cast("bigint").alias("dim"), r6(total, "total"))


def _slices(df, parts: int):
    """The corpus in `parts` ranges of ids, equal ones where ids are dense; the outer ranges are open, so every row is in one."""
    size = -(-df.count() // parts)
    place = F.coalesce(F.least(F.greatest(F.floor(F.col("id") / size), F.lit(0)), F.lit(parts - 1)), F.lit(parts - 1))
    return [df.filter(place == i) for i in range(parts)], size


# --- files ---------------------------------------------------------------------------------------


@query("s1_corpus_in_parts", _TOTALS)
def corpus_in_parts(spark, sf):
    layout = SRC.Layout.split(scratch_path(spark, "dataset"), 3, shuffled=True)
    parts, _ = _slices(corpus(spark, sf).select("id", "emb"), 3)
    for name, part in zip(layout.files, parts):
        part.write.parquet(layout.path(name))
    return _totals(layout.read_corpus(spark))


@query("s2_query_file", _TOTALS.replace("AS id", "AS qid"))
def query_file(spark, sf):
    layout = SRC.Layout(sf, test_file="embeddings.parquet", test_id_column="vec_id", test_emb_column="embedding")
    return _totals(layout.read_queries(spark).withColumnRenamed("qid", "id")).withColumnRenamed("id", "qid")


@query("s3_truth_by_filter", f"""SELECT 'int_50p' AS file, qid AS id, rank AS position, id AS neighbor FROM ({top_sql(L2, where="c.id >= (SELECT count(*) // 2 FROM embeddings)")})
UNION ALL SELECT 'all', qid, rank, id FROM ({top_sql(L2)})""")
def truth_by_filter(spark, sf):
    """Truth lists written under the file names of their filters and read back by filter."""
    c, q = corpus(spark, sf), profiles(spark, sf)
    layout = SRC.Layout(scratch_path(spark, "dataset"))
    out = []
    for name, keep in (("all", FL.NoFilter()), ("int_50p", FL.IdFilter(c.count(), 0.5))):
        S.ground_truth(q, c, 10, "L2", keep.predicate()).write.parquet(layout.path(keep.truth_file))
        rows = layout.read_truth(spark, keep).select("id", F.posexplode("neighbors_id").alias("p", "neighbor"))
        out.append(rows.select(F.lit(name).alias("file"), "id", (F.col("p") + 1).cast("bigint").alias("position"), "neighbor"))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("s4_separate_labels", f"SELECT vec_id AS id, {SHARE_SQL.format(id='vec_id')} AS labels FROM embeddings WHERE {SHARE_SQL.format(id='vec_id')} = 'label_20p'")
def separate_labels(spark, sf):
    layout, keep = SRC.Layout(scratch_path(spark, "dataset")), FL.LabelFilter(0.2)
    share_labels(spark, sf).write.parquet(layout.path(layout.labels_file))
    assert layout.read_labels(spark, FL.NoFilter()) is None
    rows = SRC.attach_labels(corpus(spark, sf), layout.read_labels(spark, keep))
    return rows.filter(keep.predicate()).select("id", "labels")


@query("s5_custom_dataset", _TOTALS)
def custom_dataset(spark, sf):
    layout = SRC.Layout.custom(sf, " embeddings , ", id_column="vec_id", emb_column="embedding")
    return _totals(layout.read_corpus(spark))


@query("s7_missing_side_file", "SELECT vec_id AS id, NULL::VARCHAR AS labels FROM embeddings")
def missing_side_file(spark, sf):
    layout = SRC.Layout(sf, labels_file="no_such_labels.parquet")
    labels = layout.read_labels(spark, FL.LabelFilter(0.01))
    return SRC.attach_labels(corpus(spark, sf), labels).select("id", "labels")


@query("s9_fixed_batches", "SELECT event_id // 100 AS batch, count(*) AS rows FROM events GROUP BY 1")
def fixed_batches(spark, sf):
    return SRC.batch_sizes(table(spark, sf, "events").withColumnRenamed("event_id", "id"), 100)


@query("s10_replace_and_append", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def replace_and_append(spark, sf):
    """Written twice with replacement, then appended once: every row twice."""
    e, path = table(spark, sf, "events").select("event_id", "event_type"), scratch_path(spark, "table")
    SRC.write_table(e, path)
    SRC.write_table(e, path, drop_old=True)
    SRC.write_table(e, path, drop_old=False)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# --- streaming ---------------------------------------------------------------------------------------

PARTS, FILES = 5, 4


def _ingest(spark, sf, stages=(0.8, 0.5), k: int = 10):
    """A finished streaming run over the corpus, which comes in five deliveries of id ranges, each of several files."""
    c = corpus(spark, sf).select("id", "emb")
    parts, size = _slices(c, PARTS)
    root = scratch_path(spark, "stream")
    q = materialise(profiles(spark, sf), "queries")
    truth = materialise(S.ground_truth(q, c, k), "truth") if stages else SRC.empty(spark, SRC.TRUTH)
    run = StagedIngest(spark, f"{root}/run", q, truth, c.count(), size, stages, k)
    for part in parts:
        part.repartition(FILES).write.mode("append").parquet(f"{root}/source")
        run.run(f"{root}/source", None)
    return run


def _stage_sql(cut: str) -> str:
    return f"""SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rank FROM sc WHERE id < {cut} * size"""


_STAGES = f"""WITH {C}, {Q}, z AS (SELECT ceil(count(*) / 5)::BIGINT AS size, count(*) AS n FROM c), sc AS (SELECT q.qid, c.id, {L2} AS d, size FROM q, c, z),
t AS (SELECT * FROM ({_stage_sql('5')}) WHERE rank <= 10),
g AS (SELECT 50 AS stage, * FROM ({_stage_sql('2')}) WHERE rank <= 10 UNION ALL SELECT 80, * FROM ({_stage_sql('4')}) WHERE rank <= 10
UNION ALL SELECT 100, * FROM t UNION ALL SELECT 110, * FROM t),
ideal AS (SELECT sum(1 / log2(i + 2)) AS v FROM (SELECT unnest(range(0, 10)) AS i)),
pq AS (SELECT stage, g.qid, count(t.id) / 10.0 AS recall, coalesce(sum(1 / log2(t.rank + 1)), 0) / max(v) AS ndcg FROM g LEFT JOIN t ON t.qid = g.qid AND t.id = g.id, ideal GROUP BY 1, 2)
SELECT stage::BIGINT AS stage, least(n, CASE stage WHEN 50 THEN 2 WHEN 80 THEN 4 ELSE 5 END * size)::BIGINT AS visible_rows, round_even(round(avg(recall), 12), 4) AS recall, round_even(round(avg(ndcg), 12), 4) AS ndcg FROM pq, z GROUP BY stage, n, size"""


@query("x4_staged_search", _STAGES)
def staged_search(spark, sf):
    rows = _ingest(spark, sf).finish()
    return rows.select(F.col("stage").cast("bigint").alias("stage"), "visible_rows", "recall", "ndcg")


@query("x1_ingested_table", _TOTALS)
def ingested_table(spark, sf):
    return _totals(_ingest(spark, sf, stages=()).rows())


@query("x3_progress", """WITH z AS (SELECT ceil(count(*) / 5)::BIGINT AS size FROM embeddings) SELECT vec_id // size AS batch_id, count(*) AS rows FROM embeddings, z GROUP BY 1""")
def progress(spark, sf):
    return _ingest(spark, sf, stages=()).progress().select("batch_id", "rows")


@query("x9_optimised_table", _TOTALS)
def optimised_table(spark, sf):
    return _totals(_ingest(spark, sf, stages=()).optimise())


@query("x11_repeated_batch", """WITH z AS (SELECT ceil(count(*) / 5)::BIGINT AS size FROM embeddings) SELECT vec_id // size AS batch_id, count(*) AS rows, sum(vec_id)::BIGINT AS ids FROM embeddings, z GROUP BY 1""")
def repeated_batch(spark, sf):
    """A batch delivered a second time changes neither the table nor the progress."""
    run = _ingest(spark, sf, stages=())
    again = run.rows().filter(F.col("batch_id") == 2).select("id", "emb")
    path = scratch_path(spark, "again")
    again.write.parquet(path)
    run.take_batch(spark.read.parquet(path), 2)
    ids = run.rows().groupBy("batch_id").agg(F.sum("id").alias("ids"))
    return run.progress().join(ids, "batch_id").select("batch_id", "rows", "ids")


@query("e3_streaming_case", f"SELECT stage, recall FROM ({_STAGES}) WHERE stage < 110")
def streaming_case(spark, sf):
    rows = _ingest(spark, sf).finish(optimise=False)
    return rows.select(F.col("stage").cast("bigint").alias("stage"), "recall")


# --- cases ----------------------------------------------------------------------------------------------


@query("n10_layout_job", f"SELECT qid, id, rank FROM ({top_sql(L2)})")
def layout_job(spark, sf):
    """The table rewritten as one id-sorted layout answers as before."""
    stored = SRC.write_sorted(corpus(spark, sf), scratch_path(spark, "layout"), files=4)
    return S.top_k(profiles(spark, sf), stored, 10).select("qid", "id", F.col("rank").cast("bigint").alias("rank"))


@query("n10_compaction", f"SELECT qid, id, rank FROM ({top_sql(L2)})")
def compaction(spark, sf):
    """A table that grew by five upserts, its small files joined, answers as before."""
    c = corpus(spark, sf).select("id", "emb")
    parts, _ = _slices(c, PARTS)
    stored = VersionedTable(spark, scratch_path(spark, "grown"))
    stored.create(parts[0], 4)
    for i, part in enumerate(parts[1:]):
        stored.upsert(part, token=str(i))
    stored.compact()
    return S.top_k(profiles(spark, sf), stored.read(), 10).select("qid", "id", F.col("rank").cast("bigint").alias("rank"))


def _sweep_sql(probes: str) -> str:
    return f"""{_CENTRES}, al AS (SELECT c.id, arg_min(cent.list_id, (list_distance(c.emb, cent.emb), cent.list_id)) AS list_id FROM c, cent GROUP BY c.id),
pr AS (SELECT q.qid, cent.list_id, row_number() OVER (PARTITION BY q.qid ORDER BY list_distance(q.emb, cent.emb), cent.list_id) AS r FROM q, cent),
ts AS (SELECT q.qid, c.id, {L2} AS d FROM q, c),
t AS (SELECT * FROM (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rank FROM ts) WHERE rank <= 10),
np AS (SELECT unnest({probes})::BIGINT AS nprobe),
gs AS (SELECT nprobe, ts.qid, ts.id, row_number() OVER (PARTITION BY nprobe, ts.qid ORDER BY d, ts.id) AS rank FROM np JOIN pr ON pr.r <= nprobe JOIN al USING (list_id) JOIN ts ON ts.qid = pr.qid AND ts.id = al.id),
pq AS (SELECT nprobe, gs.qid, count(t.id) / 10.0 AS recall FROM gs LEFT JOIN t ON t.qid = gs.qid AND t.id = gs.id WHERE gs.rank <= 10 GROUP BY 1, 2)"""


@query("n11_probe_sweep", f"WITH {C}, {Q}, {_sweep_sql('[1, 2, 4, 10]')} SELECT nprobe, round_even(round(avg(recall), 12), 4) AS recall FROM pq GROUP BY nprobe")
def probe_sweep(spark, sf):
    cents, probes = centroids(spark, sf), [1, 2, 4, 10]
    runs = PF.sweep([PF.InvertedFile(nprobe=n, centroids=cents) for n in probes], corpus(spark, sf).select("id", "emb"),
                    profiles(spark, sf), 10)
    return runs.select(F.array(*[F.lit(n) for n in probes])[F.col("seq")].cast("bigint").alias("nprobe"), "recall")


@query("n11_sweep_frontier")
def sweep_frontier(spark, sf):
    """Frontier over the measured speeds of a sweep; the speeds differ from run to run."""
    cents = centroids(spark, sf)
    runs = PF.sweep([PF.Flat(), PF.BitCodes(5.0), PF.ScalarCodes(2.0), PF.InvertedFile(nprobe=3, centroids=cents)],
                    corpus(spark, sf).select("id", "emb"), profiles(spark, sf), 10)
    best, _ = FR.split_frontier(runs.withColumn("db", F.lit("all")), ["db"])
    return best.select("searcher", "recall", "qps", "load_duration")


@query("n11_frontier_by_cost", f"""WITH {C}, {Q}, {_sweep_sql('[1, 2, 4, 10]')}, cost AS (SELECT nprobe, count(*) AS rows FROM np JOIN pr ON pr.r <= nprobe JOIN al USING (list_id) GROUP BY nprobe),
m AS (SELECT nprobe, round_even(round(avg(recall), 12), 4) AS recall, round_even(1e6 / any_value(rows), 4) AS qps FROM pq JOIN cost USING (nprobe) GROUP BY nprobe)
SELECT nprobe, recall, qps FROM m a WHERE NOT EXISTS (SELECT 1 FROM m b WHERE b.nprobe <> a.nprobe AND b.recall >= a.recall AND b.qps >= a.qps AND (b.recall > a.recall OR b.qps > a.qps))""")
def frontier_by_cost(spark, sf):
    """Frontier of a sweep whose speeds are the rows that each setting compares, so that they don't differ from run to run."""
    cents, probes = centroids(spark, sf), [1, 2, 4, 10]
    c, q = corpus(spark, sf).select("id", "emb"), materialise(profiles(spark, sf), "queries")
    runs = PF.sweep([PF.InvertedFile(nprobe=n, centroids=cents) for n in probes], c, q, 10)
    sizes = IVF.assign(c, cents).groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))
    probed = IVF.probe_lists(q, cents, max(probes)).join(F.broadcast(sizes), "list_id")  # one row per list
    settings = F.array(*[F.lit(n).cast("bigint") for n in probes])
    cost = probed.withColumn("nprobe", F.explode(settings)).where("rank <= nprobe").groupBy("nprobe").agg(F.sum("n").alias("rows"))
    rows = runs.select(settings[F.col("seq")].alias("nprobe"), "seq", "recall", F.lit("all").alias("db")).join(cost, "nprobe")
    best, _ = FR.split_frontier(rows.withColumn("qps", round4(F.lit(1e6) / F.col("rows"))), ["db"])
    return best.select("nprobe", "recall", "qps")


class LabelMeans:
    """A plug-in method: compare a query with the rows of the label whose mean is nearest."""

    def __init__(self, cents):
        self.inner = PF.InvertedFile(nprobe=1, centroids=cents)

    def build(self, rows):
        return self.inner.build(rows)

    def search(self, queries, rows, k, metric, where=None):
        return self.inner.search(queries, rows, k, metric, where)


@query("e7_plug_in_method", f"WITH {C}, {Q}, {_sweep_sql('[1]')} SELECT 'LabelMeans' AS searcher, round_even(round(avg(recall), 12), 4) AS recall FROM pq")
def plug_in_method(spark, sf):
    row = PF.run_case(LabelMeans(centroids(spark, sf)), corpus(spark, sf).select("id", "emb"), profiles(spark, sf), k=10)
    return row.select("searcher", "recall")
