"""Datasets and test cases as small tables, and the parameter matrices built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: published datasets (name, dimensions, metric, shuffled, ground truth, labels) and
# their sizes (rows, size label, file count)
DATASETS = {
    "LAION": (768, "L2", False, True, False, [(100_000_000, "LARGE", 100)]),
    "GIST": (960, "L2", False, False, False, [(100_000, "SMALL", 1), (1_000_000, "MEDIUM", 1)]),
    "Cohere": (768, "COSINE", True, True, True,
               [(100_000, "SMALL", 1), (1_000_000, "MEDIUM", 1), (10_000_000, "LARGE", 10)]),
    "Bioasq": (1024, "COSINE", True, True, True, [(1_000_000, "MEDIUM", 1), (10_000_000, "LARGE", 10)]),
    "Glove": (200, "COSINE", False, False, False, [(1_000_000, "MEDIUM", 1)]),
    "SIFT": (128, "L2", False, False, False, [(500_000, "SMALL", 1), (5_000_000, "MEDIUM", 1)]),
    "OpenAI": (1536, "COSINE", True, True, True,
               [(50_000, "SMALL", 1), (500_000, "MEDIUM", 1), (5_000_000, "LARGE", 10)]),
}
# fixed values: shares of rows per label, and the rates of id filters
LABEL_SHARES = [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5]
ID_RATES = [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99,
            0.995, 0.998, 0.999]
# fixed values: case ids of the unfiltered, 1 % and 99 % cases by dataset and size, and the other ids
PLAIN_CASES = {3: ("LAION", 100_000_000), 4: ("Cohere", 10_000_000), 5: ("Cohere", 1_000_000), 16: ("Cohere", 100_000),
               10: ("OpenAI", 500_000), 11: ("OpenAI", 5_000_000), 17: ("Bioasq", 1_000_000),
               20: ("Bioasq", 10_000_000), 50: ("OpenAI", 50_000)}
FILTER_CASES = {6: ("Cohere", 10_000_000, 0.01), 7: ("Cohere", 1_000_000, 0.01), 8: ("Cohere", 10_000_000, 0.99),
                9: ("Cohere", 1_000_000, 0.99), 12: ("OpenAI", 500_000, 0.01), 13: ("OpenAI", 5_000_000, 0.01),
                14: ("OpenAI", 500_000, 0.99), 15: ("OpenAI", 5_000_000, 0.99)}
CAPACITY_CASES = {1: ("SIFT", 500_000), 2: ("GIST", 100_000)}
CUSTOM_DATASET, STREAMING, LABEL_FILTER, ID_FILTER = 101, 200, 300, 400


def short(n: int) -> str:
    for bound, unit, suffix in ((1_000, 1, ""), (1_000_000, 1_000, "K"), (1_000_000_000, 1_000_000, "M")):
        if n < bound:
            return f"{n // unit}{suffix}"
    return f"{n // 1_000_000_000}B"


@dataclass(frozen=True)
class Dataset:
    name: str
    size: int
    size_label: str
    dim: int
    metric: str
    file_count: int
    shuffled: bool
    has_truth: bool
    has_labels: bool

    @property
    def folder(self) -> str:
        return f"{self.name}_{self.size_label}_{short(self.size)}".lower()

    @property
    def title(self) -> str:
        return f"{self.name.capitalize()} ({self.size_label.capitalize()})"

    @property
    def choice(self) -> str:
        """Name used in case parameters, such as `Small Cohere (768dim, 100K)`."""
        return f"{self.size_label.capitalize()} {self.name} ({self.dim}dim, {short(self.size)})"


def all_datasets() -> list[Dataset]:
    return [Dataset(name, size, label, dim, metric, files, shuffled, truth, labels)
            for name, (dim, metric, shuffled, truth, labels, sizes) in DATASETS.items()
            for size, label, files in sizes]


def dataset(name: str, size: int) -> Dataset:
    """A dataset by name and size; unknown names and sizes are errors."""
    known = [d for d in all_datasets() if d.name.lower() == name.lower()]
    if not known:
        raise ValueError(f"unknown dataset {name!r}, expected one of {list(DATASETS)}")
    for d in known:
        if d.size == size:
            return d
    raise ValueError(f"size {size} not supported for {name}, expected one of {[d.size for d in known]}")


def dataset_by_choice(choice: str) -> Dataset:
    for d in all_datasets():
        if d.has_labels and d.choice == choice:
            return d
    raise ValueError(f"unknown dataset choice {choice!r}")


def dataset_table(spark: SparkSession) -> DataFrame:
    rows = [(d.name, d.size, d.size_label, d.dim, d.metric, d.file_count, d.shuffled, d.has_truth, d.has_labels,
             d.folder, d.title, d.choice) for d in all_datasets()]
    return spark.createDataFrame(rows, "name string, size bigint, size_label string, dim int, metric string, "
                                       "file_count int, shuffled boolean, has_truth boolean, has_labels boolean, "
                                       "folder string, title string, choice string")


def _case(case_id: int, kind: str, name: str, d: Dataset | None, rate: float | None) -> tuple:
    if d is None:
        return case_id, kind, name, None, None, None, None, None, rate
    return case_id, kind, name, d.name, d.size, d.dim, d.metric, d.title, rate


def case_rows() -> list[tuple]:
    rows = []
    for case_id, (name, size) in CAPACITY_CASES.items():
        d = dataset(name, size)
        rows.append(_case(case_id, "load", f"Capacity Test ({d.dim} Dim Repeated)", d, None))
    for case_id, (name, size) in PLAIN_CASES.items():
        d = dataset(name, size)
        rows.append(_case(case_id, "performance",
                          f"Search Performance Test ({short(size)} Dataset, {d.dim} Dim)", d, None))
    for case_id, (name, size, rate) in FILTER_CASES.items():
        d = dataset(name, size)
        rows.append(_case(case_id, "performance", f"Filtering Search Performance Test ({short(size)} Dataset, "
                                                  f"{d.dim} Dim, Filter {rate * 100:.0f}%)", d, rate))
    rows.append(_case(CUSTOM_DATASET, "performance", "Performance With Custom Dataset", None, None))
    rows.append(_case(STREAMING, "streaming", "Streaming-Perf", None, None))
    rows.append(_case(LABEL_FILTER, "performance", "Label-Filter", None, None))
    rows.append(_case(ID_FILTER, "performance", "Int-Filter", None, None))
    return sorted(rows)


def case_table(spark: SparkSession) -> DataFrame:
    """The named cases: id, kind, name, dataset, filter rate."""
    return spark.createDataFrame(case_rows(), "case_id int, kind string, case_name string, dataset string, size bigint, "
                                              "dim int, metric string, dataset_title string, filter_rate double")


def with_case(rows: DataFrame, cases: DataFrame, case_id: str = "case_id") -> DataFrame:
    """Case metadata by id; unknown ids keep nulls."""
    return rows.join(cases.withColumnRenamed("case_id", case_id), case_id, "left")


def as_parametric(case_id: Column, custom: Column) -> tuple[Column, Column]:
    """Old fixed filter cases as the id-filter case with its dataset and rate.

    `custom` is the case's parameter map; other cases keep their id and map.
    """
    old = case_id.isin(list(FILTER_CASES))
    pairs = [(F.lit(str(i)), F.struct(F.lit(str(rate)).alias("rate"), F.lit(dataset(n, s).choice).alias("choice")))
             for i, (n, s, rate) in FILTER_CASES.items()]
    known = F.create_map(*[x for pair in pairs for x in pair])
    found = known[case_id.cast("string")]
    base = F.map_filter(F.coalesce(custom, F.create_map().cast("map<string,string>")),
                        lambda key, _: ~key.isin("filter_rate", "dataset_with_size_type"))
    params = F.map_concat(base, F.create_map(F.lit("filter_rate"), found["rate"],
                                             F.lit("dataset_with_size_type"), found["choice"]))
    return F.when(old, F.lit(ID_FILTER)).otherwise(case_id), F.when(old, params).otherwise(custom)


def expand(rows: DataFrame, **settings: list) -> DataFrame:
    """Task matrix: every row once per combination of the listed settings.

    A narrow row expansion; nulls in a list stand for "not set".
    """
    for name, values in settings.items():
        rows = rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return rows


def filter_cases(rows: DataFrame, choice: str = "choice") -> DataFrame:
    """One row per dataset and filter: id rates, then label shares."""
    from ..functions.text import filter_case_name, int_rate_name, label_value

    ids = rows.withColumn("rate", F.explode(F.array(*[F.lit(r) for r in ID_RATES])))
    labels = rows.withColumn("rate", F.explode(F.array(*[F.lit(r) for r in LABEL_SHARES])))
    return (ids.withColumn("filter", int_rate_name(F.col("rate")))
            .withColumn("case_name", filter_case_name("Int", F.col("rate"), F.col(choice)))
            .unionByName(labels.withColumn("filter", label_value(F.col("rate")))
                         .withColumn("case_name", filter_case_name("Label", F.col("rate"), F.col(choice)))))
