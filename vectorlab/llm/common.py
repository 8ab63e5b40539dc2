"""What the text operators share: row numbers, texts as bytes, written tables and size-checked broadcasts.

Conventions that hold for every operator here, unless its docstring says otherwise:
* a null text counts as empty;
* ids may be null or repeated, each row counts for itself; where rows are ordered by id, nulls come last and
  equal ids are ordered by row number;
* only the named columns are read, so further columns of any name do no harm;
* an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry.base import table  # noqa: F401
from ..session import broadcast_limit, materialise

#: Rows of an Arrow batch of texts. Spark's own number suits narrow rows; long texts would make batches of gigabytes.
BATCH_ROWS, BATCH_KEY, SPARK_ROWS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def text_bytes(text: str) -> Column:
    """A text column as UTF-8 bytes, null as empty. Lowers the session's rows per Arrow batch, unless they were set."""
    spark = SparkSession.getActiveSession()
    if spark and spark.conf.get(BATCH_KEY) == SPARK_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def free_name(df: DataFrame, wanted: str) -> str:
    """The wanted column name, with underscores added until no column of df has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(df: DataFrame, *columns: Column, name: str) -> DataFrame:
    """The given columns and a unique `row` number, written to the shared folder so that the numbers stay."""
    return materialise(df.select(*columns).withColumn("row", F.monotonically_increasing_id()), name)


def numbered_whole(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """All columns of df with a row number in a column of a free name, written to the shared folder; and that name."""
    row = free_name(df, "_row")
    return materialise(df.withColumn(row, F.monotonically_increasing_id()), name), row


def first_row(id_column: str = "doc_id") -> Column:
    """Sort key of rows: smallest id first, null ids last, then the row number."""
    return F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col("row").alias("row"))


def broadcast_checked(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """Broadcast hint if the counted rows fit the limit; else df as it is, for a shuffled join."""
    small = df.count() * bytes_per_row <= broadcast_limit(df.sparkSession)
    return F.broadcast(df) if small else df


def keep_rows(whole: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """Rows of a numbered table whose number is among `kept.row`, without the number."""
    keys = broadcast_checked(kept.select(F.col("row").alias(row)), 16)
    return whole.join(keys, row, "left_semi").drop(row)


def byte_texts(array: pa.Array) -> Iterator[bytes]:
    """Values of an Arrow binary array one by one, nulls as empty."""
    for value in array:
        yield value.as_py() or b""
