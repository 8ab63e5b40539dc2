"""Recall and NDCG of an answer list against the true neighbours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncated(ids: Column, k: int) -> Column:
    return F.slice(ids, 1, k)


def recall_at(truth: Column, got: Column, k: int) -> Column:
    """Answers found among the first k true ids, over k; a short answer scores lower."""
    top = truncated(truth, k)
    found = F.filter(truncated(got, k), lambda x: F.array_contains(top, x))
    return F.size(found).cast("double") / F.lit(float(k))


def shared_ids(truth: Column, got: Column) -> Column:
    return F.array_intersect(truth, got)


def distinct_ids(got: Column) -> Column:
    return F.array_distinct(got)


def ideal_dcg(k: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(0.0).cast("double"),
                       lambda total, i: total + F.lit(1.0) / F.log2(i + 2))


def set_ndcg_at(truth: Column, got: Column, k: int) -> Column:
    """NDCG with the gain of an answer taken from its true rank; answer order has no effect.

    Gains are added in true-rank order, so a full answer scores exactly 1.
    """
    answers = distinct_ids(got)
    gains = F.transform(truncated(truth, k), lambda x, i: F.when(
        F.array_contains(answers, x), F.lit(1.0) / F.log2(i + 2)).otherwise(F.lit(0.0)))
    dcg = F.aggregate(gains, F.lit(0.0).cast("double"), lambda total, gain: total + gain)
    return dcg / ideal_dcg(F.lit(k))
