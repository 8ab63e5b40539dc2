"""Packing of tokenised documents into sequences by bounded-space online best-fit.

Every scan task packs its own documents while it reads them; nothing is shuffled. A fixed number of bins is
open at a time. A bitset has one bit per amount of free space for which a bin is open, so the bin that fits a
piece best is the lowest bit at or above its length. When a new bin is needed and all are open, the fullest
closes. Pieces of one batch of documents go in longest first.

Null texts are documents of the end token only. Rows with equal or null ids are packed each for itself.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .tokens import text_tokenizer, tokenizer_path

LENGTH, OPEN, END_ID = 4096, 1024, 1
ROWS = "row bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class BestFit:
    """Bins of one size; `add` returns the bin of a piece and the place in it."""

    def __init__(self, size: int = LENGTH, most_open: int = OPEN, first: int = 0):
        self.size, self.most_open, self.next = size, most_open, first
        self.bits, self.open, self.bins = 0, 0, defaultdict(list)

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def add(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            if self.open >= self.most_open:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, found = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            self.bins[left].append(found)
            self.bits |= 1 << left
            self.open += 1
        return found, self.size - free


def pieces(ids: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of a document; only longer ones are cut. ids: 4 bytes each."""
    for piece, at in enumerate(range(0, len(ids), 4 * length)):
        yield piece, at // 4, ids[at:at + 4 * length]


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, most_open: int, end_id: int) -> Iterator[pa.RecordBatch]:
    tokenizer, end = text_tokenizer(path), end_id.to_bytes(4, "little")
    bins = BestFit(length, most_open, TaskContext.get().partitionId() << 40)
    for batch in batches:
        cut = [(len(part) // 4, row, piece, start, zlib.crc32(part))
               for row, ids in zip(batch.column(0).to_pylist(), tokenizer.ids_of(C.byte_texts(batch.column(1))))
               for piece, start, part in pieces(ids + end, length)]
        cut.sort(key=lambda p: -p[0])
        placed = [(row, piece, start, size, crc, *bins.add(size)) for size, row, piece, start, crc in cut]
        if placed:
            types = (pa.int64(), pa.int32(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*placed), types)], [x.split()[0] for x in ROWS.split(", ")])


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None, length: int = LENGTH,
         most_open: int = OPEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    path: a tokenizer file on every worker. Sequence ids are unique, not dense.
    """
    path = path or tokenizer_path()
    read = docs.select(F.col(doc_id).cast("bigint").alias("row"), C.text_bytes(text))
    packed = read.mapInArrow(lambda batches: _pack(batches, path, length, most_open, end_id), ROWS)
    return packed.withColumnRenamed("row", "doc_id")
