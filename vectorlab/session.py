"""Session settings, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its proven size stays under this many bytes.
BROADCAST_BYTES_KEY = "vectorlab.broadcast.maxBytes"
BROADCAST_BYTES_DEFAULT = 64 * 1024 * 1024


def build_session(app: str = "vectorlab", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library is written for and this package on its workers; a cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # methods above 8000 bytes are not compiled by the JVM; wide result rows run faster split up
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_KEY, str(BROADCAST_BYTES_DEFAULT)))


def check_broadcast(spark: SparkSession, size: int, what: str) -> None:
    """Error if a value of `size` bytes is too large to send to every worker."""
    if size > broadcast_limit(spark):
        raise ValueError(f"{what}: {size} bytes exceed {BROADCAST_BYTES_KEY}")


def broadcast_if_small(df: DataFrame, max_rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast hint only when the caller's row bound keeps the side under the limit."""
    if max_rows * bytes_per_row <= broadcast_limit(df.sparkSession):
        return F.broadcast(df)
    return df


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only on a local master where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file:" + tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per context, unless their PYTHONPATH has it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    if getattr(context, "_vectorlab_shipped", False) or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "vectorlab"), "zip", root, "vectorlab")
    context.addPyFile(archive)
    context._vectorlab_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/vectorlab/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage so that a lost executor costs one task, fixes values that depend on the
    partitioning, and gives the planner true sizes for its join choice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
