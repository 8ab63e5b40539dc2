"""All registered queries by name."""

from . import base, results, scoring, tables, vectors  # noqa: F401


def queries():
    return base.QUERIES


def oracles():
    return base.ORACLES
