"""Registered queries: a Spark callable per operator and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vectors as VV

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole embeddings table as (id, emb, label)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("emb"), F.col("label").cast("bigint").alias("label"))


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus with lengths 1 to 3, so that the metrics give different orders."""
    factor = (F.lit(1) + F.col("id") % 3).cast("double")
    emb = F.transform(F.col("emb").cast("array<double>"), lambda x: x * factor)
    return corpus(spark, sf_dir).withColumn("emb", emb)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query set: mean vectors of 80 groups over the whole corpus, so its size does not grow."""
    keyed = corpus(spark, sf_dir).withColumn("qid", F.col("label") * 8 + F.col("id") % 8)
    return VV.mean_vectors(keyed, "qid").select(F.col("key").alias("qid"), "emb")


def r6(c: Column | str, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column.cast("double"), 6).alias(name or str(c))


def answer(df: DataFrame) -> DataFrame:
    return df.select(F.col("qid").cast("bigint").alias("qid"), F.col("id").cast("bigint").alias("id"),
                     r6("dist", "dist"), F.col("rank").cast("bigint").alias("rank"))


# SQL pieces shared by the oracles
C = "c AS (SELECT vec_id AS id, embedding::DOUBLE[] AS emb, label::BIGINT AS label FROM embeddings)"
SC = ("c AS (SELECT vec_id AS id, [x * (1 + vec_id % 3) for x in embedding::DOUBLE[]] AS emb, label::BIGINT AS label "
      "FROM embeddings)")
Q = ("qparts AS (SELECT label::BIGINT * 8 + vec_id % 8 AS qid, unnest(embedding)::DOUBLE AS x, "
     "generate_subscripts(embedding, 1) AS d FROM embeddings), "
     "qmeans AS (SELECT qid, d, avg(x) AS x FROM qparts GROUP BY qid, d), "
     "q AS (SELECT qid, list(x ORDER BY d) AS emb FROM qmeans GROUP BY qid)")


def top_sql(distance: str, k: int = 10, ctes: str = f"{C}, {Q}", where: str = "true", source: str = "c") -> str:
    return (f"WITH {ctes}, scored AS (SELECT q.qid, c.id, {distance} AS dist FROM q, {source} c WHERE {where}), "
            "ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist NULLS LAST, id) AS rank FROM scored) "
            f"SELECT qid, id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= {k}")


L2 = "list_distance(q.emb, c.emb)"
COS = "list_cosine_distance(q.emb, c.emb)"
IP = "list_negative_inner_product(q.emb, c.emb)"
