"""Corpus predicates, ground-truth file names and input checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NoFilter:
    truth_file: str = "neighbors.parquet"
    rate: float = 0.0

    def predicate(self) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class IdFilter:
    """Keep ids from `int(size * rate)` upwards; `strict` drops the bound itself."""

    size: int
    rate: float
    field: str = "id"
    strict: bool = False
    named_by_rate: bool = True

    @property
    def value(self) -> int:
        return int(self.size * self.rate)

    def predicate(self) -> Column:
        bound = F.lit(self.value)
        return F.col(self.field) > bound if self.strict else F.col(self.field) >= bound

    @property
    def truth_file(self) -> str:
        if self.named_by_rate:
            return f"neighbors_{rate_name('int', self.rate * 100, whole_up_to=99)}.parquet"
        # fixed values: the two rates with a file of their own name
        names = {0.01: "neighbors_head_1p.parquet", 0.99: "neighbors_tail_1p.parquet"}
        if self.rate not in names:
            raise ValueError(f"no ground truth file for the id filter rate {self.rate}")
        return names[self.rate]


@dataclass(frozen=True)
class LabelFilter:
    """Keep rows with the label that marks the given share of the corpus."""

    share: float
    field: str = "labels"

    @property
    def rate(self) -> float:
        return 1.0 - self.share

    @property
    def value(self) -> str:
        return rate_name("label", self.share * 100)

    def predicate(self) -> Column:
        return F.col(self.field) == F.lit(self.value)

    @property
    def truth_file(self) -> str:
        return f"neighbors_{self.field}_{self.value}.parquet"


def rate_name(prefix: str, percent: float, whole_up_to: float = float("inf")) -> str:
    """`int_50p`, `int_99.5p`, `label_0.1p`: whole percents from 1 on, else one decimal."""
    text = str(int(percent)) if 1 <= percent <= whole_up_to else f"{percent:.1f}"
    return f"{prefix}_{text}p"


def id_is(value: int, field: str = "id") -> Column:
    return F.col(field) == F.lit(value)


def all_of(*predicates: Column) -> Column:
    result = F.lit(True)
    for p in predicates:
        result = result & p
    return result


def split_by_dimension(df: DataFrame, dim: int, emb: str = "emb") -> tuple[DataFrame, DataFrame]:
    """(rows of the declared length, rejected rows)."""
    ok = F.coalesce(F.size(emb) == dim, F.lit(False)) & F.col(emb).isNotNull()
    return df.filter(ok), df.filter(~ok)


def require_dimension(emb: Column, dim: int) -> Column:
    """The vector itself, or an error that names the wrong length."""
    message = F.concat(F.lit(f"vector length is not {dim}: "), F.coalesce(F.size(emb).cast("string"), F.lit("no vector")))
    return F.when(F.size(emb) == dim, emb).otherwise(F.raise_error(message))


def column_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Non-null count per column and whether they are all equal."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns])
    first = F.col(columns[0])
    return counts.withColumn("equal", all_of(*[first == F.col(c) for c in columns[1:]]))


def unsupported(tasks: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Tasks whose backend does not support their filter type."""
    return tasks.join(capabilities, ["db", "filter_type"], "left_anti")
