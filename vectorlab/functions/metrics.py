"""Metric names, their column expressions and their sort direction."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vector as V


@dataclass(frozen=True)
class Metric:
    """`distance` grows with dissimilarity; `score` is what a report shows."""

    name: str
    distance: Callable[[Column, Column], Column]
    score: Callable[[Column, Column], Column]
    higher_is_closer: bool = False
    on_bits: bool = False

    def order(self, column: str) -> Column:
        """Best first, missing values last."""
        c = F.col(column)
        return c.desc_nulls_last() if self.higher_is_closer else c.asc_nulls_last()


METRICS = {
    "L2": Metric("L2", V.l2_distance, V.l2_distance),
    "L2_SQUARED": Metric("L2_SQUARED", V.l2_squared, V.l2_squared),
    "COSINE": Metric("COSINE", V.cosine_distance, V.cosine_similarity, higher_is_closer=True),
    "IP": Metric("IP", V.negative_inner_product, V.inner_product, higher_is_closer=True),
    "HAMMING": Metric("HAMMING", V.hamming_distance, V.hamming_distance, on_bits=True),
    "JACCARD": Metric("JACCARD", V.jaccard_distance, V.jaccard_distance, on_bits=True),
}
METRICS["DP"] = METRICS["IP"]
METRICS["EUCLIDEAN"] = METRICS["L2"]


def metric(name: str) -> Metric:
    try:
        return METRICS[name.upper()]
    except KeyError:
        raise ValueError(f"unknown metric {name!r}, expected one of {sorted(METRICS)}") from None


def after_normalising(name: str, store_supports_cosine: bool = False, target: str = "IP") -> tuple[str, bool]:
    """(metric to search with, whether to normalise first).

    On unit vectors cosine, L2 and inner product give one order, so a store without cosine
    searches normalised vectors under L2 or IP.
    """
    m = metric(name)
    if m.name != "COSINE" or store_supports_cosine:
        return m.name, False
    return metric(target).name, True
