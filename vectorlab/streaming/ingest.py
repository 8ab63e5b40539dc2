"""Streaming ingest of a corpus with searches at chosen stages.

State lives in four tables under one root and never in driver memory, so a restarted stream
goes on where it stopped:

    rows/batch_id=N        the rows of a micro-batch
    answers/batch_id=N     the k best rows of every query among all rows up to this micro-batch
    progress/batch_id=N    its row count, the seconds its search took and its finish time
    stages/stage=P         the scores of the search at P percent

A micro-batch is searched by itself, and its answers are merged with those of the batch before: every
row is compared once, however many stages there are, and a stage reads k rows per query.
Every folder is written with overwrite and depends on earlier batches only, so a repeated micro-batch
changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import search as S
from ..operators.querylog import per_query_scores, run_scores
from ..sources.corpus import path_exists
from .stages import AFTER_INSERT, AFTER_OPTIMISE, sorted_stages, total_batches

ROWS = "id bigint, emb array<float>, batch_id bigint"
ANSWERS = "qid bigint, id bigint, dist double, rank int"
PROGRESS = "rows bigint, search_seconds double, done_ts timestamp, batch_id bigint"
STAGES = ("batch_id bigint, visible_rows bigint, search_time double, seconds double, qps double, recall double, "
          "ndcg double, stage int")


@dataclass
class StagedIngest:
    """One streaming run: where it writes, what it searches and when."""

    spark: SparkSession
    root: str
    queries: DataFrame
    truth: DataFrame
    size: int
    insert_rate: int
    stages: tuple[float, ...] = (0.5, 0.8)
    k: int = 100
    metric: str = "L2"
    search: Callable[[DataFrame, DataFrame, int, str], DataFrame] = S.top_k

    def __post_init__(self):
        self.stages = tuple(sorted_stages(self.stages))

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def rows(self, up_to: int | None = None) -> DataFrame:
        df = self._read("rows", ROWS)
        return df if up_to is None else df.filter(F.col("batch_id") <= up_to)

    def progress(self) -> DataFrame:
        return self._read("progress", PROGRESS)

    def stage_rows(self) -> DataFrame:
        return self._read("stages", STAGES)

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.table(name)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def run(self, source: str, files_per_trigger: int | None = 1, interval: str | None = None) -> None:
        """Ingest the parquet files of `source` that are not read yet.

        `files_per_trigger` and `interval` set the insert rate; without an interval the backlog
        is worked off at once in batches of that many files, or in one batch for None.
        """
        reader = self.spark.readStream.schema("id bigint, emb array<float>")
        stream = (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(source)
        writer = (stream.writeStream.foreachBatch(self.take_batch)
                  .option("checkpointLocation", self.table("_stream")))
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        query = writer.trigger(**trigger).start()
        if interval:
            query.processAllAvailable()
            query.stop()
        else:
            query.awaitTermination()

    def take_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch, bring the answers up to date, note the progress, score if it reached a stage."""
        seen = Observation(f"batch-{batch_id}-{time.monotonic_ns()}")
        path = f"{self.table('rows')}/batch_id={batch_id}"
        batch.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        begin = time.time()
        if self.stages:
            self._carry_answers(self.spark.read.schema("id bigint, emb array<float>").parquet(path), batch_id)
        note = self.spark.range(1).select(F.lit(seen.get["rows"]).cast("bigint").alias("rows"), F.lit(time.time() - begin).alias("search_seconds"),
                                          F.current_timestamp().alias("done_ts"))
        note.write.mode("overwrite").parquet(f"{self.table('progress')}/batch_id={batch_id}")
        for percent in self._newly_reached(batch_id):
            self._score(percent, batch_id)

    def answers(self, batch_id: int) -> DataFrame:
        """(qid, id, dist, rank) among all rows up to a micro-batch; a stream without stages has none."""
        return self._read(f"answers/batch_id={batch_id}", ANSWERS)

    def _carry_answers(self, rows: DataFrame, batch_id: int) -> None:
        """Merge the batch's answers with the state of the batch before; an id that comes again keeps its better distance once."""
        new = self.search(self.queries, rows, self.k, self.metric).select("qid", "id", "dist")
        if batch_id:  # micro-batches are numbered from 0 without gaps
            new = new.union(self.answers(batch_id - 1).select("qid", "id", "dist")).groupBy("qid", "id").agg(F.min("dist").alias("dist"))
        merged = new.withColumn("rank", S.rank_within(["qid"])).filter(F.col("rank") <= self.k)
        merged.select("qid", "id", "dist", "rank").write.mode("overwrite").parquet(f"{self.table('answers')}/batch_id={batch_id}")

    def _newly_reached(self, batch_id: int) -> list[int]:
        done = self.progress().filter(F.col("batch_id") <= batch_id).agg(F.sum("rows")).first()[0] or 0
        scored = {r["stage"] for r in self.stage_rows().filter(F.col("batch_id") != batch_id).select("stage").collect()}
        total = total_batches(self.size, self.insert_rate)
        reached = [int(s * 100) for s in self.stages if done >= int(total * s) * self.insert_rate]
        return [p for p in reached if p not in scored]

    def _score(self, percent: int, batch_id: int) -> None:
        """Score the carried answers; a stage took as long as the searches of all batches up to it."""
        upto = self.progress().filter(F.col("batch_id") <= batch_id).agg(F.sum("rows").alias("rows"), F.sum("search_seconds").alias("seconds")).first()
        self._note(percent, batch_id, self.answers(batch_id), upto["rows"], time.time(), upto["seconds"])

    def _search(self, percent: int, rows: DataFrame, batch_id: int) -> None:
        """Search a whole table and score its answers."""
        begin = time.time()
        path = f"{self.table('answers')}-{percent}"
        self.search(self.queries, rows.select("id", "emb"), self.k, self.metric).write.mode("overwrite").parquet(path)
        self._note(percent, batch_id, self.spark.read.parquet(path), rows.count(), begin, time.time() - begin)

    def _note(self, percent: int, batch_id: int, answers: DataFrame, visible: int, at: float, seconds: float) -> None:
        started = self.progress().agg(F.min("done_ts").cast("double")).first()[0]
        scores = run_scores(per_query_scores(S.answer_lists(answers), self.truth, self.k)).first()
        row = [(batch_id, visible, round(at - started, 4), seconds, round(self.queries.count() / max(seconds, 1e-9), 4),
                scores["recall"], scores["ndcg"])]
        schema = STAGES.rsplit(",", 1)[0]
        (self.spark.createDataFrame(row, schema).write.mode("overwrite")
         .parquet(f"{self.table('stages')}/stage={percent}"))

    def finish(self, optimise: bool = True, files: int | None = None) -> DataFrame:
        """Score the answers of all rows, compact the table, search that; returns all stage rows."""
        last = self.progress().agg(F.max("batch_id")).first()[0]
        if self.stages:
            self._score(AFTER_INSERT, last)
        else:  # no answers were carried
            self._search(AFTER_INSERT, self.rows(), last)
        if optimise:
            self._search(AFTER_OPTIMISE, self.optimise(files), last)
        return self.stage_rows()

    def optimise(self, files: int | None = None) -> DataFrame:
        """Rewrite the small per-batch files as one id-sorted table."""
        from ..sources.corpus import write_sorted

        return write_sorted(self.rows().select("id", "emb"), self.table("optimised"), "id", files)
