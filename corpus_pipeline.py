"""Cleaning and packing of a corpus of documents, stage by stage.

Null texts count as empty; rows with null or repeated ids each count for themselves, of equal texts one row stays, nulls
last. Further columns of any name are carried through all stages but the last. Without labels no document is toxic, without
benchmark items none is contaminated; no documents give no pieces.
"""

from __future__ import annotations

from vectorlab.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from vectorlab.llm.common import table
from vectorlab.session import materialise


def without_toxic(spark, docs, sf_dir):
    """Documents scored as toxic go; the labels outside the held-out fold teach the model."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark, docs, sf_dir):
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark, docs, sf_dir):
    """One document of each near-duplicate component stays."""
    return simhash.drop_near_duplicates(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_matches(docs, table(spark, sf_dir, "benchmark"))


def packed(spark, docs, sf_dir):
    """What is left, in sequences of 4096 tokens: one row per piece."""
    return packing.pack(docs)


STAGES = [("toxicity", without_toxic), ("exact dedup", without_copies), ("simhash near-dedup", without_near_copies),
          ("benchmark decontamination", without_benchmark), ("best-fit packing", packed)]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order; each stage's result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name.replace(" ", "-"))
    return docs
