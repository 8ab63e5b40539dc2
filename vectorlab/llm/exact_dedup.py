"""Exact deduplication by content-defined chunk recipes.

A text is cut where its content says so. Every chunk gets a 64-bit hash and the SHA-256 of its bytes, and one pass
writes these lists; from there on no text moves again. The chunk table groups all chunks of the corpus by hash. Where
one hash stands for different chunks, they are told apart by numbers, in order of their digests; hash and number are the
chunk's verified identifier. Texts are equal when their ordered lists of identifiers are; the length and the SHA-256 of the
whole text are compared besides, as a check. A chunk that a third of the texts share is counted before the shuffle and is
never a key that texts are joined on: only the few hashes with several chunks go back to the texts.

White-space runs `[\\x20\\x09-\\x0D]+` count as one space. Null texts are empty texts and equal to each other.
Rows with null ids take part and come last; of rows with equal ids the first by row number stays.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from . import common as C

SPACES = re.compile(rb"[\x20\x09-\x0D]+")
#: A chunk ends after a byte position whose last WINDOW bytes hash to zero in the masked bits: 1 KB on average.
WINDOW, MASK, LONGEST = 32, np.uint64(1023 << 40), 8192
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: recipe: hashes of the chunks; digests: four numbers for each chunk, its SHA-256
RECIPE = (T.StructType().add("recipe", T.ArrayType(T.LongType())).add("digests", T.ArrayType(T.LongType()))
          .add("sha", T.BinaryType()).add("size", T.LongType()))
DIGEST = ["d0", "d1", "d2", "d3"]


def normalise(data: bytes) -> bytes:
    return SPACES.sub(b" ", data)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text: content-defined, at most LONGEST bytes apart, the last at its end."""
    size = len(data)
    if size <= WINDOW:
        return [size] if size else []
    # rolling sum of mixed 4-byte words over WINDOW bytes, for all positions at once
    x = np.frombuffer(data, np.uint8).astype(np.uint64)
    word = (x[3:] | x[2:-1] << np.uint64(8) | x[1:-2] << np.uint64(16) | x[:-3] << np.uint64(24)) * FACTOR
    word ^= word >> np.uint64(29)
    total = np.cumsum(word * FACTOR)
    span = WINDOW - 3
    rolled = total[span - 1:].copy()
    rolled[1:] -= total[:-span]
    rolled *= FACTOR
    found = np.flatnonzero((rolled & MASK) == 0) + WINDOW
    ends, at = [], 0
    for end in [*found.tolist(), size]:
        while end - at > LONGEST:
            at += LONGEST
            ends.append(at)
        if end > at:
            ends.append(end)
            at = end
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def recipe_of(data: bytes, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the chunks in order, and their SHA-256 as four numbers each."""
    cut = chunks(data)
    found = np.fromiter(map(xxhash.xxh64_intdigest, cut), np.uint64, len(cut)) >> np.uint64(64 - bits)
    return found.view(np.int64), np.frombuffer(b"".join(hashlib.sha256(c).digest() for c in cut), np.int64)


def _recipes(bits: int):
    @F.arrow_udf(RECIPE)
    def cut(texts: pa.Array) -> pa.Array:
        found, sha, size = [], [], []
        for data in C.byte_texts(texts):
            data = normalise(data)
            found.append(recipe_of(data, bits))
            sha.append(hashlib.sha256(data).digest())
            size.append(len(data))
        lists = [pa.ListArray.from_arrays(np.cumsum([0, *(len(r[k]) for r in found)]).astype(np.int32),
                                          np.concatenate([np.empty(0, np.int64), *(r[k] for r in found)])) for k in range(2)]
        return pa.StructArray.from_arrays([*lists, pa.array(sha, pa.binary()), pa.array(size, pa.int64())], RECIPE.fieldNames())

    return cut


def recipes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = 64) -> DataFrame:
    """(doc_id, recipe, digests, sha, size, row): one row per document, written once. `bits` of a chunk's hash are kept."""
    cut = docs.select(F.col(doc_id).alias("doc_id"), _recipes(bits)(C.text_bytes(text)).alias("r"))
    return C.numbered(cut, F.col("doc_id"), F.col("r.*"), name="recipes")


def occurrences(rows: DataFrame) -> DataFrame:
    """(row, place, chunk_id, d0, d1, d2, d3): every chunk of every text."""
    at = F.explode(F.sequence(F.lit(0), F.size("recipe") - 1)).alias("place")
    each = rows.where(F.size("recipe") > 0).select("row", "recipe", "digests", at)
    return each.select("row", "place", F.get("recipe", F.col("place")).alias("chunk_id"),
                       *(F.get("digests", 4 * F.col("place") + k).alias(d) for k, d in enumerate(DIGEST)))


def chunk_table(rows: DataFrame) -> DataFrame:
    """A row per hash of a chunk: (chunk_id, uses, several). several: chunks of different content share the hash."""
    same = [F.min(d) == F.max(d) for d in DIGEST]
    return occurrences(rows).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("uses"), (~(same[0] & same[1] & same[2] & same[3])).alias("several"))


def identified(rows: DataFrame) -> DataFrame:
    """Rows of `recipes` with `numbers`: of each chunk whose hash stands for several, its place and its number among them.

    Recipe and numbers together are the list of verified identifiers.
    """
    several = materialise(chunk_table(rows).where("several").select("chunk_id"), "several")
    many, none = several.count(), F.array().cast("array<struct<place:int,number:int>>")
    if not many:  # every hash stands for one chunk
        return rows.withColumn("numbers", none)
    mine = occurrences(rows).join(C.broadcast_checked(several, 16), "chunk_id", "left_semi")
    order = Window.partitionBy("chunk_id").orderBy(*DIGEST)
    number = mine.select("chunk_id", *DIGEST).distinct().withColumn("number", F.row_number().over(order))
    lists = mine.join(number, ["chunk_id", *DIGEST]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("numbers"))
    return rows.join(lists, "row", "left").withColumn("numbers", F.coalesce("numbers", none))


KEY = ["size", "recipe", "numbers", "sha"]


def firsts(rows: DataFrame) -> DataFrame:
    """(size, recipe, numbers, sha, first, group_size): the row that stays of each group of equal texts.

    The groups are aggregated before the shuffle, so a group of any size is one row per task.
    """
    return rows.groupBy(*KEY).agg(F.min(C.first_row()).alias("first"), F.count(F.lit(1)).alias("group_size"))


def groups(rows: DataFrame) -> DataFrame:
    """Every identified row with the row that stays of its group: (doc_id, row, sha, keep_id, keep_row, group_size).

    The join back is on the group's key, whose other side has one row, and may be split by the planner.
    """
    found = firsts(rows).select(*KEY, F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    return rows.join(found, KEY).select("doc_id", "row", "sha", "keep_id", "keep_row", "group_size")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return groups(identified(recipes(docs, text, doc_id, bits)).drop("digests")).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with all their columns."""
    whole, row = C.numbered_whole(docs, "documents")
    cut = whole.select(F.col(doc_id).alias("doc_id"), F.col(row).alias("row"), _recipes(64)(C.text_bytes(text)).alias("r"))
    rows = identified(materialise(cut.select("doc_id", "row", "r.*"), "recipes"))
    return C.keep_rows(whole, row, firsts(rows.drop("digests")).select("first.row"))
