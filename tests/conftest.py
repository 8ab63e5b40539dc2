import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from vectorlab.session import build_session, ship_package  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


def vectors(spark, x, name="id", parts=3):
    """A matrix as a (name, emb) table over several partitions."""
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(np.asarray(x, np.float32))]
    return spark.createDataFrame(rows, f"{name} bigint, emb array<float>").repartition(parts)


def brute_force(q, c, k, metric="L2"):
    """Reference top-k: lists of ids per query, ties by id."""
    q, c = np.asarray(q, np.float32).astype(float), np.asarray(c, np.float32).astype(float)
    out = []
    for row in q:
        if metric == "L2":
            d = np.sqrt(((c - row) ** 2).cumsum(axis=1)[:, -1])
        elif metric == "IP":
            d = -(c * row).cumsum(axis=1)[:, -1]
        else:
            with np.errstate(divide="ignore", invalid="ignore"):
                d = 1 - (c * row).cumsum(axis=1)[:, -1] / np.sqrt(
                    (c * c).cumsum(axis=1)[:, -1] * (row * row).cumsum()[-1])
            d = np.where(np.isfinite(d), d, np.inf)
        out.append(np.lexsort((np.arange(len(c)), d))[:k].tolist())
    return out


def found(df):
    """Answers as lists of ids per query in rank order."""
    lists = {}
    for r in sorted(df.select("qid", "rank", "id").collect()):
        lists.setdefault(r["qid"], []).append(r["id"])
    return [lists[q] for q in sorted(lists)]
