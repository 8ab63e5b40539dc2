"""Rounding, number text, unit changes and price figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-7


def round_even(x: Column, digits: int) -> Column:
    """Round the scaled value half to even, as array libraries do."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def round4(x: Column) -> Column:
    return round_even(x, 4)


def short_number(n: Column) -> Column:
    """1000 -> 1K, 2500000 -> 2M; truncating, and B has no upper bound."""
    def part(divisor: float, suffix: str) -> Column:
        return F.concat((n / F.lit(divisor)).cast("bigint").cast("string"), F.lit(suffix))

    return (F.when(n < 1e3, part(1.0, "")).when(n < 1e6, part(1e3, "K"))
            .when(n < 1e9, part(1e6, "M")).otherwise(part(1e9, "B")))


def scaled_if_positive(x: Column, factor: float) -> Column:
    """Unit change that leaves zero and negative markers alone."""
    return F.when(x > 0, x * factor).otherwise(x)


def seconds_to_ms(x: Column) -> Column:
    return scaled_if_positive(x, 1000.0)


def rows_to_thousands(x: Column) -> Column:
    return F.when(x.cast("bigint") > 0, x / 1000.0).otherwise(x)


def thousand_queries_per_dollar(qps: Column, price: Column) -> Column:
    """Chart form: thousands of queries per dollar, null unless both are positive."""
    return F.when((qps > 0) & (price > 0), qps / price * 3.6)


def queries_per_dollar(qps: Column, price: Column) -> Column:
    """Leaderboard form: queries per dollar of an hourly price, zero without a price."""
    return F.when(price > 0, qps / price * 3600).otherwise(0.0)


def stage_adjusted(x: Column, stage: Column) -> Column:
    """A score relative to the share of rows inserted so far, full after stage 100."""
    return round4(x / F.least(stage, F.lit(100)) * 100)


def rows_per_batch(budget_bytes: Column, dim: Column) -> Column:
    """Rows of 4-byte components that fit in a byte budget."""
    return (budget_bytes / (dim * 4)).cast("bigint")


def better_of(a: Column, b: Column, lower_is_better: bool) -> Column:
    """Better of two values; near-zero counts as missing."""
    left = F.when(a >= TINY, a)
    right = F.when(b >= TINY, b)
    best = F.least(left, right) if lower_is_better else F.greatest(left, right)
    return F.coalesce(best, b)


def above_noise(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0)) > TINY
