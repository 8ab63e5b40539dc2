"""Vector expressions: distances, normalisation and bit codes as Spark columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def as_double(vec: Column) -> Column:
    """All arithmetic is done in double precision."""
    return vec.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda total, x: total + x)


def _count(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def squared_norm(a: Column) -> Column:
    return dot(a, a)


def norm(a: Column) -> Column:
    return F.sqrt(squared_norm(a))


def normalise(vec: Column) -> Column:
    """Unit-length vector; a zero vector gives null components instead of an error."""
    # the norm is bound once, or it would be computed anew for every component
    return F.transform(F.array(norm(vec)), lambda n: F.transform(as_double(vec), lambda x: F.try_divide(x, n)))[0]


def l2_squared(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(l2_squared(a, b))


def cosine_similarity(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(squared_norm(a) * squared_norm(b)))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def inner_product(a: Column, b: Column) -> Column:
    return dot(a, b)


def negative_inner_product(a: Column, b: Column) -> Column:
    return -dot(a, b)


def sign_bits(vec: Column) -> Column:
    """Binary quantisation: 1 where the component is above zero."""
    return F.transform(as_double(vec), lambda x: F.when(x > 0, 1).otherwise(0))


def _groups(bits: Column, width: int) -> Column:
    starts = F.sequence(F.lit(0), F.ceil(F.size(bits) / F.lit(width)).cast("int") - 1)
    return F.transform(starts, lambda i: F.slice(bits, i * width + 1, width))


def _fold(group: Column, width: int) -> Column:
    """Bits of one group as a number, first bit highest, missing bits zero."""
    value = F.aggregate(group, F.lit(0).cast("bigint"), lambda acc, b: acc * 2 + b)
    return F.call_function("shiftleft", value, F.lit(width) - F.size(group))


def pack_bytes(bits: Column) -> Column:
    """Eight bits to one signed byte, high bit first."""
    def signed(value: Column) -> Column:
        return F.when(value > 127, value - 256).otherwise(value).cast("tinyint")

    return F.transform(_groups(bits, 8), lambda g: signed(_fold(g, 8)))


def pack_words(bits: Column) -> Column:
    """Thirty-two bits to one non-negative long, for word-wise Hamming and Jaccard."""
    return F.transform(_groups(bits, 32), lambda g: _fold(g, 32))


def hamming_distance(a: Column, b: Column) -> Column:
    """Differing bits of two packed codes (byte or word arrays of one width)."""
    return _count(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("bigint")))


def jaccard_distance(a: Column, b: Column) -> Column:
    """1 - shared bits / set bits; two empty codes are at distance 1."""
    both = _count(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("bigint")))
    either = _count(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y)).cast("bigint")))
    return F.lit(1.0) - F.coalesce(F.try_divide(both.cast("double"), either.cast("double")), F.lit(0.0))


@F.pandas_udf(ArrayType(FloatType()))
def half_precision(vecs: pd.Series) -> pd.Series:
    """Round components through 16-bit floats."""
    return vecs.map(lambda v: None if v is None else np.asarray(v, np.float32).astype(np.float16).astype(np.float32))


@F.pandas_udf(ArrayType(FloatType()))
def bfloat16(vecs: pd.Series) -> pd.Series:
    """Keep the upper 16 bits of each 32-bit float."""
    def cut(v):
        if v is None:
            return None
        bits = np.ascontiguousarray(v, dtype=np.float32).view(np.uint32)
        return (bits & np.uint32(0xFFFF0000)).view(np.float32)

    return vecs.map(cut)
