"""Top-k for query sets of any size: a grid of query blocks against corpus blocks.

Both sides are packed into rows that hold a few thousand vectors each and written to the shared folder. A task reads a
range of query blocks and a range of corpus blocks from there, keeps k rows for each query of the block at hand, and
sends one row per query block: the k best ids and distances as matrices. These are mergeable in any order; the answers
of a block are folded one by one. No query passes the driver, nothing is broadcast, and it is one job however many
queries there are.

The product of the two tables is one of packed blocks: its rows are the cells of the grid, not pairs of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import metric as metric_of
from ..session import materialise
from .blocks import BIT_METRICS, NO_ID, Space, TopK, k_copies, matrix

RESULT = "qid bigint, id bigint, dist double, rank int"
#: Blocks of a few rows cost more to move and to call than to compare; larger ones take more memory and save little.
BLOCK_BYTES = 2 << 20
#: Bytes of corpus blocks that a task holds, and tasks wanted for each core.
RANGE_BYTES, WAVES = 256 << 20, 4


def packed(rows: DataFrame, name: str, block_bytes: int = BLOCK_BYTES, copies: int | None = None) -> DataFrame:
    """`rows(id, emb)` as written blocks (block, ids, vectors, type, dim); ids are 64-bit, vectors keep their element type.

    With `copies`, a block keeps that many rows of one vector, lowest ids first.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block():
            x = np.concatenate([m for _, m in held])
            ids = np.concatenate([i for i, _ in held])
            held.clear()
            if copies is not None and x.shape[1]:
                keep = k_copies(ids, x, copies)
                ids, x = ids[keep], x[keep]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([x.dtype.str]), pa.array([x.shape[1]], pa.int32())],
                ["ids", "vectors", "type", "dim"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1), None)
            if held and held[0][1].shape[1] != x.shape[1]:
                raise ValueError("vectors of different lengths")
            step = max(1, block_bytes // max(1, x.shape[1] * x.itemsize))
            while len(ids):
                room = step - sum(len(i) for i, _ in held)
                held.append((ids[:room], x[:room]))
                ids, x = ids[room:], x[room:]
                if sum(len(i) for i, _ in held) >= step:
                    yield block()
        if held:
            yield block()

    blocks = rows.where(F.col("emb").isNotNull()).select("id", "emb").mapInArrow(run, "ids binary, vectors binary, type string, dim int")
    return materialise(blocks.withColumn("block", F.monotonically_increasing_id()), name)


def _matrix(raw: pa.Buffer, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.dtype(kind)).reshape(-1, dim)


def _cells(name: str, k: int):
    """Answers (block, qids, ids, dist) of a task; the corpus blocks of one query block come in a row."""
    def run(batches: Iterator[pa.RecordBatch]):
        now, qids, best = None, None, None

        def answer():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in (qids, best.ids, best.dist))], ["block", "qids", "ids", "dist"])

        for batch in batches:
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                if (block := columns["block"][i].as_py()) != now:
                    if now is not None:
                        yield answer()
                    now, qids = block, np.frombuffer(columns["qids"][i].as_buffer(), np.int64)
                    asked = _matrix(columns["queries"][i].as_buffer(), columns["q_type"][i].as_py(), columns["q_dim"][i].as_py())
                    best = TopK(Space(name, asked), k)
                x = _matrix(columns["vectors"][i].as_buffer(), columns["type"][i].as_py(), columns["dim"][i].as_py())
                best.add(np.frombuffer(columns["ids"][i].as_buffer(), np.int64), best.space._bits(x) if name in BIT_METRICS else x)
        if now is not None:
            yield answer()

    return run


def _merged(k: int):
    """Final answers from all tasks' answers, sorted by block."""
    def run(batches: Iterator[pa.RecordBatch]):
        now, qids, ids, dist = None, None, None, None

        def rows():
            at, rank = np.nonzero(ids != NO_ID)
            far = dist[at, rank]
            return pa.RecordBatch.from_arrays(
                [pa.array(qids[at]), pa.array(ids[at, rank]), pa.array(far, mask=~np.isfinite(far)), pa.array((rank + 1).astype(np.int32))], ["qid", "id", "dist", "rank"])

        for batch in batches:
            for i, block in enumerate(batch.column(0).to_pylist()):
                new_ids = np.frombuffer(batch.column(2)[i].as_py(), np.int64).reshape(-1, k)
                new_dist = np.frombuffer(batch.column(3)[i].as_py(), np.float64).reshape(-1, k)
                if block != now:
                    if now is not None:
                        yield rows()
                    now, qids, ids, dist = block, np.frombuffer(batch.column(1)[i].as_py(), np.int64), new_ids, new_dist
                    continue
                ids, dist = np.concatenate([ids, new_ids], axis=1), np.concatenate([dist, new_dist], axis=1)
                order = np.lexsort((ids, dist), axis=-1)[:, :k]
                ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        if now is not None:
            yield rows()

    return run


def grid_top_k(queries: DataFrame, corpus: DataFrame, k: int = 100, metric: str = "L2", where: Column | None = None,
               block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Exact k nearest rows of `corpus(id, emb)` for every row of `queries(qid, emb)`, whatever the number of queries."""
    spark = queries.sparkSession
    asked = packed(queries.select(F.col("qid").cast("bigint").alias("id"), "emb"), "query-blocks", block_bytes)
    rows = corpus if where is None else corpus.where(where)
    stored = packed(rows.select(F.col("id").cast("bigint").alias("id"), "emb"), "corpus-blocks", block_bytes, k)
    left = asked.select("block", F.col("ids").alias("qids"), F.col("vectors").alias("queries"), F.col("type").alias("q_type"), F.col("dim").alias("q_dim"))
    size = stored.agg(F.coalesce(F.sum(F.octet_length("vectors")), F.lit(0))).first()[0]
    ranges = max(-(-size // range_bytes), -(-WAVES * spark.sparkContext.defaultParallelism // max(1, left.rdd.getNumPartitions())))
    right = stored.select("ids", "vectors", "type", "dim").coalesce(max(1, ranges))
    cells = left.hint("shuffle_replicate_nl").crossJoin(right)
    partial = cells.mapInArrow(_cells(metric_of(metric).name, k), "block bigint, qids binary, ids binary, dist binary")
    return partial.repartition("block").sortWithinPartitions("block").mapInArrow(_merged(k), RESULT)
