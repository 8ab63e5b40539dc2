"""Vector tables that change in place: rows bucketed by id, files listed in a versioned log.

    data/<run>/bucket=B/...    files of one write
    log/v=N/                   one small file: the files of version N with their buckets and lengths

A version is the list in its log folder, and the appearance of that one file is the commit. A job that is stopped
before leaves files that no version names; readers go on with the version they know. One writer at a time: a second
one that wants the same version number fails and leaves the first one's version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.running import running_sum
from ..session import materialise

LOG = "file string, bucket int, bytes bigint, buckets int, columns string, token string, v int"
BUCKET = "_bucket"


class VersionedTable:
    """A table under `path` with one row per id, or null id."""

    def __init__(self, spark: SparkSession, path: str, id_column: str = "id"):
        self.spark, self.path, self.id_column = spark, path.rstrip("/"), id_column

    def log(self) -> DataFrame:
        """(file, bucket, bytes, buckets, columns, token, v) of all versions."""
        from .corpus import path_exists

        if not path_exists(self.spark, f"{self.path}/log"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.path}/log")

    def version(self) -> int | None:
        return self.log().agg(F.max("v")).first()[0]

    def files(self, version: int | None = None) -> DataFrame:
        """(file, bucket, bytes) of a version, the newest by default; files are named below the table's folder."""
        at = self.version() if version is None else version
        return self.log().where((F.col("v") == at) & F.col("file").isNotNull()).select("file", "bucket", "bytes")

    def _about(self):
        at = self.version()
        if at is None:
            raise FileNotFoundError(f"no table at {self.path}")
        row = self.log().where(F.col("v") == at).first()
        return at, row["buckets"], row["columns"]

    def _rows(self, files: DataFrame, columns: str) -> DataFrame:
        paths = [f"{self.path}/{r['file']}" for r in files.select("file").collect()]
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.files(version), self._about()[2])

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.id_column), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, *by: str) -> DataFrame:
        """Write rows that have a bucket; the new files (file, bucket, bytes)."""
        run = f"data/{uuid.uuid4().hex}"
        rows.write.partitionBy(BUCKET, *by).parquet(f"{self.path}/{run}")
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.path}/{run}")
        file = F.regexp_extract("path", rf"({run}/.*)$", 1)
        return listed.select(file.alias("file"), F.regexp_extract("path", rf"/{BUCKET}=(\d+)/", 1).cast("int").alias("bucket"), F.col("length").alias("bytes"))

    def _commit(self, version: int, files: DataFrame, buckets: int, columns: str, token: str | None) -> int:
        none = self.spark.createDataFrame([(None, None, None)], "file string, bucket int, bytes bigint")  # a version without files is one, too
        entries = files.union(none).select("*", F.lit(buckets).alias("buckets"), F.lit(columns).alias("columns"), F.lit(token).cast("string").alias("token"))
        entries.coalesce(1).write.parquet(f"{self.path}/log/v={version}")  # a list of files; one task makes it one file
        return version

    def create(self, df: DataFrame, buckets: int = 64, token: str | None = None) -> int:
        """Store `df`, which has one row per id, as version 0."""
        if self.version() is not None:
            raise FileExistsError(f"there is a table at {self.path}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        rows = df.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET)
        return self._commit(0, self._write(rows), buckets, columns, token)

    def upsert(self, new: DataFrame, order: str | None = None, token: str | None = None) -> int:
        """Add or replace rows by id and return the version; only buckets that get rows are read and written.

        Of rows with one id the greatest `order` stays, on a tie or without one a new row rather than the stored one;
        equal new rows count once. A `token` that the log knows changes nothing, so a delivery may be repeated.
        """
        at, buckets, columns = self._about()
        if token is not None and not self.log().where(F.col("token") == token).isEmpty():
            return at
        names = self.spark.createDataFrame([], columns).columns
        fresh = materialise(new.select(*names).withColumn(BUCKET, self._bucket(buckets)), "upsert")
        touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most the number of buckets
        files = self.files(at)
        stored = self._rows(files.where(F.col("bucket").isin(touched)), columns).withColumn(BUCKET, self._bucket(buckets))
        both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
        rest = [c for c in names if c != self.id_column]
        by = F.struct(*([order] if order else []), "_new", *[F.hash(c).alias(f"_h{i}") for i, c in enumerate(rest)])
        best = both.groupBy(self.id_column, BUCKET).agg(F.max_by(F.struct(F.lit(1).alias("_"), *rest), by).alias("_row"))
        rows = best.select(*[F.col(self.id_column) if c == self.id_column else F.col(f"_row.`{c}`").alias(c) for c in names], BUCKET)
        kept = files.where(~F.col("bucket").isin(touched))
        return self._commit(at + 1, kept.union(self._write(rows.hint("rebalance", BUCKET))), buckets, columns, token)

    def compact(self, target_bytes: int = 128 << 20) -> int:
        """Join small files of a bucket into files of about `target_bytes`; files of half that size or more stay as they are."""
        at, buckets, columns = self._about()
        files = self.files(at)
        plan = compaction_plan(files.withColumnRenamed("bucket", BUCKET), [BUCKET], target_bytes)
        plan = materialise(plan, "compaction")
        if plan.isEmpty():
            return at
        rows = self._rows(plan, columns).select("*", F.regexp_extract("_metadata.file_path", r"(data/[0-9a-f]{32}/.*)$", 1).alias("_file"))
        joined = rows.join(F.broadcast(plan.select(F.col("file").alias("_file"), BUCKET, "bin")), "_file").drop("_file")  # a list of files
        written = self._write(joined.repartition(BUCKET, "bin"), "bin")
        kept = files.join(F.broadcast(plan.select("file")), "file", "left_anti")
        return self._commit(at + 1, kept.select("file", "bucket", "bytes").union(written), buckets, columns, None)


def compaction_plan(files: DataFrame, keys: list[str], target_bytes: int) -> DataFrame:
    """(file, keys, bytes, bin) of the small files that are worth joining: bins of about `target_bytes` with two files or more."""
    small = files.where(F.col("bytes") < target_bytes // 2).select("file", *keys, "bytes")
    summed = running_sum(small, keys, ["bytes", "file"], "bytes", "upto")
    binned = summed.withColumn("bin", F.floor((F.col("upto") - F.col("bytes")) / target_bytes)).drop("upto")
    many = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return binned.join(many, [*keys, "bin"]).select("file", *keys, "bytes", "bin")
