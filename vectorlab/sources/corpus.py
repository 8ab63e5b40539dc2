"""Readers for corpora, query sets, ground truth and labels; writers for vector tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.filters import LabelFilter, NoFilter

CORPUS = "id bigint, emb array<float>"
LABELS = "id bigint, labels string"
TRUTH = "id bigint, neighbors_id array<bigint>"


def train_files(count: int, shuffled: bool = False) -> list[str]:
    """File names of a corpus split into `count` parts."""
    prefix = "shuffle_train" if shuffled else "train"
    if count <= 1:
        return [f"{prefix}.parquet"]
    return [f"{prefix}-{i:02d}-of-{count}.parquet" for i in range(count)]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def side_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A side file, or an empty table when it is missing."""
    return spark.read.parquet(path) if path_exists(spark, path) else empty(spark, schema)


@dataclass(frozen=True)
class Layout:
    """Where a dataset lies and how its columns are called."""

    root: str
    files: list[str] = field(default_factory=lambda: train_files(1))
    test_file: str = "test.parquet"
    labels_file: str = "scalar_labels.parquet"
    truth_file: str | None = None
    id_column: str = "id"
    emb_column: str = "emb"
    test_id_column: str = "id"
    test_emb_column: str = "emb"
    truth_column: str = "neighbors_id"
    labels_separate: bool = True

    @classmethod
    def split(cls, root: str, count: int, shuffled: bool = False, **names) -> "Layout":
        return cls(root, train_files(count, shuffled), **names)

    @classmethod
    def custom(cls, root: str, file_names: str = "train", **names) -> "Layout":
        """User dataset: comma-separated file stems and own column names."""
        stems = [s.strip() for s in file_names.split(",") if s.strip()]
        return cls(root, [f"{s}.parquet" for s in stems], **names)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read_corpus(self, spark: SparkSession) -> DataFrame:
        """All parts as (id, emb[, labels]); a missing part is an error."""
        paths = [self.path(f) for f in self.files]
        missing = [p for p in paths if not path_exists(spark, p)]
        if missing:
            raise FileNotFoundError(f"no such file: {missing[0]}")
        df = spark.read.parquet(*paths)
        keep = [] if self.labels_separate or "labels" not in df.columns else ["labels"]
        return canonical(df, self.id_column, self.emb_column, keep)

    def read_queries(self, spark: SparkSession) -> DataFrame:
        df = spark.read.parquet(self.path(self.test_file))
        return canonical(df, self.test_id_column, self.test_emb_column).withColumnRenamed("id", "qid")

    def read_truth(self, spark: SparkSession, filters=NoFilter()) -> DataFrame:
        """Ground truth for a filter; an empty table when its file is missing."""
        df = side_table(spark, self.path(self.truth_file or filters.truth_file), TRUTH)
        return df.select(F.col("id").cast("bigint").alias("id"),
                         F.col(self.truth_column).cast("array<bigint>").alias("neighbors_id"))

    def read_labels(self, spark: SparkSession, filters) -> DataFrame | None:
        """Separate labels, read only when the filter needs them."""
        if not isinstance(filters, LabelFilter) or not self.labels_separate:
            return None
        return side_table(spark, self.path(self.labels_file), LABELS)


def canonical(df: DataFrame, id_column: str, emb_column: str, keep: list[str] | None = None) -> DataFrame:
    """(id bigint, emb array<float>) from any column names."""
    return df.select(F.col(id_column).cast("bigint").alias("id"), F.col(emb_column).cast("array<float>").alias("emb"),
                     *(keep or []))


def attach_labels(corpus: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels joined on id; rows without a label keep null."""
    return corpus.join(labels.select("id", "labels"), "id", "left")


def replicated(corpus: DataFrame, copies: int, n: Column | int) -> DataFrame:
    """`copies` of a corpus with ids kept unique by the corpus size `n`; a narrow row expansion."""
    size = n if isinstance(n, Column) else F.lit(n)
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return (corpus.withColumn("_copy", copy).withColumn("id", F.col("id") + F.col("_copy") * size.cast("bigint"))
            .drop("_copy"))


def size_mismatches(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Entries of `remote(path, length)` that are missing locally or have another length."""
    return remote.join(local, ["path", "length"], "left_anti")


def batch_sizes(corpus: DataFrame, rows: int) -> DataFrame:
    """(batch, rows) when the corpus is read in batches of a fixed id range."""
    return (corpus.groupBy(F.floor(F.col("id") / rows).cast("bigint").alias("batch"))
            .agg(F.count(F.lit(1)).alias("rows")))


def write_table(df: DataFrame, path: str, drop_old: bool = True, partition_by: str | None = None) -> None:
    """Store a vector table, replacing or extending what is there."""
    writer = df.write.mode("overwrite" if drop_old else "append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def newest_per_id(old: DataFrame, new: DataFrame, id_column: str = "id", version: str = "version") -> DataFrame:
    """Upsert: one row per id, the highest version wins.

    An aggregate rather than a window, so versions of a hot id are reduced before the shuffle.
    """
    both = old.unionByName(new)
    rest = [c for c in both.columns if c != id_column]
    best = both.groupBy(id_column).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
    return best.select(id_column, "_row.*")


def write_by_label(df: DataFrame, path: str, label: str = "labels") -> DataFrame:
    """Table partitioned by label; a label filter then reads one folder."""
    df.hint("rebalance", label).write.mode("overwrite").partitionBy(label).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_sorted(df: DataFrame, path: str, column: str = "id", files: int | None = None) -> DataFrame:
    """Table range-partitioned and sorted, so that range filters skip files and row groups."""
    ranged = df.repartitionByRange(files, column) if files else df.repartitionByRange(column)
    ranged.sortWithinPartitions(column).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

