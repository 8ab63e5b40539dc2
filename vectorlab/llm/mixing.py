"""Scores of texts by logistic context mixing.

A text is its words (ASCII letters in lower case) and an end. A word is coded as its bytes and a space, the end as one
byte, each byte as eight binary decisions. Seven predictors know the decision's counts in a hashed context:
the last one, two, three or five bytes of the word, the whole word so far, and two of these together with the accent
class, which is the last non-ASCII letter that the text had before the word and tells languages apart. Their logits are mixed
by weights gated by bit, place in the word and the longest context that is known; the result is refined by an adaptive map from (partial byte,
mixed logit) to observed frequency. The decisions' probabilities multiply to that of the text.

A decision depends only on the accent class and the word up to there, so each distinct pair of the corpus is computed once, and
what neighbours in word order begin with alike is computed once for all of them.

Passes: a scan task cuts its texts into blocks, numbers a block's words by falling count, and splits its distinct (word, accent class)
pairs over buckets by a hash of the word, one compressed row for each. A word is at most once in a block, so no bucket is hot however
often the word occurs. Buckets sum the pairs over all blocks; the pairs fill the hashed counts, which are summed by slot. Buckets then
price their pairs and send each block the prices of its own; blocks add them up by text.

Contexts seen less than SEEN times have no say, whatever the size of the corpus; the times are summed over all tasks. Contexts that
fall on one slot share its counts. The weights and the map are learned
online over mini-batches of the texts with remainder 1, in parallel, and averaged, on the counts of the other
training texts, so the weights see contexts as new texts do; the final counts are those of all training texts. One pass makes both. The model has a fixed size of SLOTS and is broadcast.

A null text is the end alone; a null id belongs to no fold and is learned from; repeated ids are scored row by row; an empty table gives
an empty one. Words may be as long as texts.
"""

from __future__ import annotations

import copy
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from . import common as C

END = b"\n"
SLOTS = (20, 22, 22, 22, 22, 22, 22)  # bits of each predictor's table
SEEN, BLOCK_BYTES, CHUNK = 3, 16 << 20, 1 << 15
SLICE = 40_000  # words that are coded at once
BATCH, EPOCHS = 1 << 12, 3  # of online learning: coded bytes of a mini-batch, passes
LEARNER_PAIRS = 100_000  # each learner has as many pairs at least, unless there are fewer
TOGETHER, COUNTED = 2, 20_000  # predictors and words that are counted at once: a worker's memory
CLASSES, PLACES, ORDERS, CELLS = 17, 4, 5, 33
INPUTS = len(SLOTS) + 1
RATE, FIRST_WEIGHT, MAP_PRIOR, LEAST = 0.04, 0.2, 32.0, 2.0**-16
SCALE = 127 / 8  # logits from -8 to 8 in a byte
MULTIPLY, NODE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
POWER, INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)
ACCENT = re.compile(rb"[\xc2-\xf4][\x80-\xbf]+")

BUCKETS, PER_TASK = (16, 1 << 14), 2  # least and most buckets of words, buckets for each scan task
TEXTS = 2000  # of a row of the block table
DEEP = 24  # bytes of a word up to which its beginning is shared with its neighbours

BLOCKS = "block bigint, docs array<bigint>, held array<boolean>, sizes array<int>, words binary, bucket int, pairs binary"
PAIRS = "word binary, accent int, main bigint, tune bigint, first boolean"


# --- words and contexts

def accent_class(word: bytes) -> int:
    """Class 1 to 16 of a word's last non-ASCII letter, 0 for none."""
    found = None if word.isascii() else ACCENT.findall(word)
    return 1 + (xxhash.xxh32_intdigest(found[-1]) & 15) if found else 0


def classes_before(accents: np.ndarray) -> np.ndarray:
    """Class before each word of a text, from the words' own classes."""
    at = np.maximum.accumulate(np.where(accents > 0, np.arange(len(accents)), -1))
    before = np.concatenate([[-1], at[:-1]])
    return np.where(before >= 0, accents[before], 0)


def _powers(n: int, factor: int, kept: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006  kept from call to call
    if len(kept.get(factor, ())) < n:
        steps = np.full(2 * n, factor, np.uint64)
        steps[:1] = 1
        kept[factor] = np.cumprod(steps)
    return kept[factor][:n]


class Bytes:
    """The coded bytes of a list of words with their places, words and context hashes."""

    def __init__(self, words: list[bytes], accents: np.ndarray):
        coded = [w if w == END else w + b" " for w in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        self.byte = np.frombuffer(b"".join(coded), np.uint8)
        self.word = np.repeat(np.arange(len(coded)), size)
        first = np.cumsum(size) - size
        self.place = np.arange(len(self.byte)) - np.repeat(first, size)
        self.accent = np.repeat(accents.astype(np.int64), size)
        x = self.byte.astype(np.uint64)
        before = [self._before(x, k) for k in range(1, 6)]
        start = np.repeat(first, size)
        total = np.zeros(len(x), np.uint64)
        total[1:] = np.cumsum((x + np.uint64(1)) * _powers(len(x), POWER))[:-1]
        prefix = (total - total[start]) * _powers(len(x), INVERSE)[start]
        language = self.accent.astype(np.uint64) << np.uint64(48)
        two = before[0] | before[1] << np.uint64(9)
        three = two | before[2] << np.uint64(18)
        five = three | before[3] << np.uint64(27) | before[4] << np.uint64(36)
        every = (before[0], two, three, three ^ language, five, prefix, prefix ^ language * MULTIPLY)
        self.contexts = [(c + np.uint64(k + 1)) * MULTIPLY for k, c in enumerate(every)]

    def _before(self, x: np.ndarray, k: int) -> np.ndarray:
        """The byte k places before within the word, plus one; zero before its start."""
        moved = np.zeros(len(x), np.uint64)
        moved[k:] = x[:-k] + np.uint64(1)
        moved[self.place < k] = 0
        return moved

    def distinct(self) -> tuple[Bytes, np.ndarray]:
        """Each beginning that consecutive words share, with its accent class, once; and where each byte went."""
        at = np.arange(len(self.byte))
        early = self.place < DEEP
        rows, columns = self.word[early], self.place[early]
        n = int(self.word[-1]) + 1 if len(self.word) else 0
        grid, first = np.full((n, DEEP), -1, np.int32), np.zeros(at.shape, bool)
        grid[rows, columns] = self.byte[early] + (self.accent[early].astype(np.int32) << 8)
        same = np.zeros((n, DEEP), bool)
        same[1:] = np.logical_and.accumulate((grid[1:] == grid[:-1]) & (grid[1:] >= 0), axis=1)
        grid.fill(-1)
        grid[rows, columns] = at[early]
        grid[same] = -1
        leader = at.copy()
        leader[early] = np.maximum.accumulate(grid, axis=0)[rows, columns]
        first[leader] = True
        return self.taken(first), (np.cumsum(first) - 1)[leader]

    def taken(self, order: np.ndarray) -> Bytes:
        some = copy.copy(self)
        some.byte, some.place, some.accent, some.word = (x[order] for x in (self.byte, self.place, self.accent, self.word))
        some.contexts = [c[order] for c in self.contexts]
        return some

    def slots(self, predictor: int, part: slice, node: np.ndarray) -> np.ndarray:
        h = self.contexts[predictor][part] + node * NODE
        h *= MULTIPLY
        h >>= np.uint64(64 - SLOTS[predictor])
        return h.view(np.int64)


#: Logit by the unsigned value of its byte.
LOGIT = (np.arange(256, dtype=np.uint8).view(np.int8) / SCALE).astype(np.float32)


def decisions(byte: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(partial byte with a leading one, next bit) of each byte at a bit position."""
    x = byte.astype(np.int64)
    return (256 | x) >> (8 - bit), x >> (7 - bit) & 1


# --- the model

def logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Counts as logits in a byte; zero where there are none."""
    value = np.log((ones + 0.4) / (zeros + 0.4))
    return np.where(zeros + ones > 0, np.clip(np.rint(value * SCALE), -127, 127), 0).astype(np.int8)


class Model:
    def __init__(self, tables: list[np.ndarray], weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.tables = tables
        self.weights = np.full((8, PLACES * ORDERS, INPUTS), FIRST_WEIGHT) if weights is None else weights
        self.refined = np.tile(squash(np.linspace(-8, 8, CELLS)), (256, 1)) if refined is None else refined

    def inputs(self, data: Bytes, part: slice, node: np.ndarray) -> list[np.ndarray]:
        u = node.astype(np.uint64)
        return [LOGIT.take(table.view(np.uint8).take(data.slots(k, part, u))) for k, table in enumerate(self.tables)]

    def mixed(self, inputs: list[np.ndarray], bit: int, gate: np.ndarray) -> np.ndarray:
        w = self.weights[bit]
        total = w[gate, INPUTS - 1] - FIRST_WEIGHT
        for k, x in enumerate(inputs):
            total += w[gate, k] * x
        return np.clip(total, -7.999, 7.999)

    def probability(self, mixed: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Probability that the bit is one, after refinement."""
        at = (mixed + 8) * ((CELLS - 1) / 16)
        low = at.astype(np.int64)
        cell = self.refined.ravel()
        low += node * CELLS
        part = at - np.floor(at)
        refined = cell[low] * (1 - part) + cell[low + 1] * part
        return np.clip((squash(mixed) + refined) / 2, LEAST, 1 - LEAST)

    def bits(self, words: list[bytes], accents: np.ndarray) -> np.ndarray:
        """Bits that each word takes."""
        parts = [self._bits(words[at:at + SLICE], accents[at:at + SLICE]) for at in range(0, len(words), SLICE)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _bits(self, words: list[bytes], accents: np.ndarray) -> np.ndarray:
        whole = Bytes(words, accents)
        data, node_of = whole.distinct()
        cost = np.zeros(len(data.byte))
        for at in range(0, len(data.byte), CHUNK):
            part = slice(at, at + CHUNK)
            for bit in range(8):
                node, one = decisions(data.byte[part], bit)
                inputs = self.inputs(data, part, node)
                p = self.probability(self.mixed(inputs, bit, gates(data, part, inputs)), node)
                cost[part] -= np.log2(np.where(one == 1, p, 1 - p))
        return np.bincount(whole.word, cost[node_of], len(words))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def gates(data: Bytes, part: slice, inputs: list[np.ndarray]) -> np.ndarray:
    """Weight set of each decision: its place in the word, and the longest of the last four contexts that is known."""
    order = np.zeros(len(inputs[0]), np.int64)
    for k, x in enumerate(inputs[-ORDERS + 1:], 1):
        order[x != 0] = k
    return np.minimum(data.place[part], PLACES - 1) * ORDERS + order


class Learner:
    """Online learning of the weights by mini-batches, with a step size per weight, and of the refinement's frequencies."""

    def __init__(self, model: Model):
        self.model, self.seen = model, 0.0
        self.square = np.full(model.weights.shape, 1e-3)
        self.ones, self.count = np.zeros((256, CELLS)), np.zeros((256, CELLS))

    def learn(self, words: list[bytes], accents: np.ndarray, times: np.ndarray) -> None:
        order = np.lexsort((np.argsort(np.argsort(np.array(words, object))), accents))
        whole, model = Bytes([words[i] for i in order], accents[order]), self.model
        data, node_of = whole.distinct()
        n = np.bincount(node_of, times[order][whole.word].astype(float))
        mixed_up = np.random.default_rng(len(n)).permutation(len(n))
        data, n = data.taken(mixed_up), n[mixed_up]
        for at in range(0, len(data.byte), BATCH):
            part = slice(at, at + BATCH)
            weight = n[part]
            self.seen += weight.sum()
            for bit in range(8):
                node, one = decisions(data.byte[part], bit)
                inputs = model.inputs(data, part, node)
                gate = gates(data, part, inputs)
                mixed = model.mixed(inputs, bit, gate)
                cell = np.rint((mixed + 8) * ((CELLS - 1) / 16)).astype(np.int64) + node * CELLS
                self.count += np.bincount(cell, weight, 256 * CELLS).reshape(256, CELLS)
                self.ones += np.bincount(cell, weight * one, 256 * CELLS).reshape(256, CELLS)
                error = (one - squash(mixed)) * weight
                slope = np.stack([np.bincount(gate, error * x, PLACES * ORDERS) for x in [*inputs, np.ones(len(error))]], axis=1)
                self.square[bit] += slope * slope
                model.weights[bit] += RATE * slope / np.sqrt(self.square[bit])


# --- passes

class _Numbers(dict):
    """Number of each word, given out in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0, or of floats, in their least width; compressed byte plane by byte plane."""
    head, parts = [len(arrays)], []
    for x in arrays:
        wide = np.ascontiguousarray(x, "<f4" if x.dtype.kind == "f" else np.min_scalar_type(max(int(x.max(initial=0)), 0)).newbyteorder("<"))
        head += [len(x), ord(wide.dtype.kind), wide.itemsize]
        parts.append(np.ascontiguousarray(wide.view(np.uint8).reshape(len(x), wide.itemsize).T))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array(head, "<u4").tobytes(), *parts]))


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    head, at, arrays = np.frombuffer(raw, "<u4", 3 * count, 4).reshape(count, 3).tolist(), 4 + 12 * count, []
    for n, kind, width in head:
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        values = np.ascontiguousarray(planes.T).view(f"<{chr(kind)}{width}").ravel()
        arrays.append(values if chr(kind) == "f" else values.astype(np.int64))
        at += n * width
    return arrays


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                          ("words", pa.binary()), ("bucket", pa.int32()), ("pairs", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of texts, as numbers of their block's words by falling count, and of a block's pairs in a bucket."""
    block, size, docs, number = TaskContext.get().partitionId() << 32, 0, [], _Numbers({END: 0})

    def flush() -> Iterator[pa.RecordBatch]:
        n = len(number)
        words = pa.array(number, pa.binary())
        accents = np.fromiter(map(accent_class, number), np.int64, n)
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in number), np.int64, n)
        counts = [np.zeros(CLASSES * n, np.int64) for _ in range(3)]
        for fold, total in enumerate(counts):  # main, tuning, held out
            mine = [ids for _, f, ids in docs if f == fold]
            for at in range(0, len(mine), TEXTS):
                keys = np.concatenate([ids * CLASSES + classes_before(accents[ids]) for ids in mine[at:at + TEXTS]])
                np.add.at(total, keys, 1)
        seen = sum(counts).reshape(n, CLASSES).sum(axis=1)
        order = pc.sort_indices(pa.table({"bucket": bucket, "word": words}), [("bucket", "ascending"), ("word", "ascending")]).to_numpy().astype(np.int64)
        place = np.empty(n, np.int64)
        place[order[np.argsort(-seen[order], kind="stable")]] = np.arange(n)
        for at in range(0, len(docs), TEXTS):
            some = docs[at:at + TEXTS]
            yield _batch(BLOCK_SCHEMA, block=[block], docs=[[d for d, _, _ in some]], held=[[f == 2 for _, f, _ in some]],
                         sizes=[[len(ids) for _, _, ids in some]], words=[packed(place[np.concatenate([ids for _, _, ids in some])])])
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            mine = order[edges[b]:edges[b + 1]]
            cells = (mine[:, None] * CLASSES + np.arange(CLASSES)).ravel()
            main, tune, held = (c[cells] for c in counts)
            used = np.flatnonzero(main + tune + held)
            text = b"\n".join(b"" if w == END else w for w in words.take(pa.array(mine)).to_pylist())
            numbers = packed(np.diff(used // CLASSES, prepend=0), used % CLASSES, main[used], tune[used], held[used])
            yield _batch(BLOCK_SCHEMA, block=[block], bucket=[b],
                         pairs=[len(numbers).to_bytes(4, "little") + numbers + zstandard.ZstdCompressor(level=3).compress(text)])

    for batch in batches:
        for doc_id, data in zip(batch.column(0).to_pylist(), C.byte_texts(batch.column(1))):
            words = data.lower().split()
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            # a null id belongs to no fold and is learned from
            fold = {0: 2, 1: 1}.get(zlib.crc32(str(doc_id).encode()) % 10, 0) if doc_id is not None else 0
            docs.append((doc_id, fold, np.append(ids, 0)))
            size += len(data) + 64
            if size >= BLOCK_BYTES:
                yield from flush()
                block, size, docs, number = block + 1, 0, [], _Numbers({END: 0})
    if docs:
        yield from flush()


class Bucket:
    """The pairs of a bucket's rows, distinct and summed; `pair` says of each row which ones it holds."""

    def __init__(self, rows: list[bytes]):
        self.rows, texts, base = [], [], 0
        for data in rows:
            size = int.from_bytes(data[:4], "little")
            step, accent, *counts = unpacked(data[4:4 + size])
            words = zstandard.ZstdDecompressor().decompress(data[4 + size:]).split(b"\n")
            texts.append(pa.array([w or END for w in words], pa.binary()))
            self.rows.append((np.cumsum(step), accent, counts, slice(base, base + len(words))))
            base += len(words)
        coded = pa.chunked_array(texts, pa.binary()).combine_chunks().dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words = coded.dictionary.take(pa.array(order))
        self.word = rank[coded.indices.to_numpy()]
        # by class, then word: neighbours begin alike
        keys = np.concatenate([accent * len(order) + self.word[span][place] for place, accent, _, span in self.rows])
        key, self.pair = np.unique(keys, return_inverse=True)
        self.accent, self.of = key // len(order), key % len(order)
        self.main, self.tune = (np.zeros(len(key), np.int64) for _ in range(2))
        for k, total in enumerate((self.main, self.tune)):
            np.add.at(total, self.pair, np.concatenate([counts[k] for _, _, counts, _ in self.rows]))
        self.count = np.zeros(len(order), np.int64)
        np.add.at(self.count, self.of, self.main + self.tune)

    def own_words(self) -> list[bytes]:
        return self.words.take(pa.array(self.of)).to_pylist()


def _summed_pairs(table: pa.Table) -> pa.Table:
    """Pairs of the training texts, by class and word; the first of a word is marked."""
    bucket = Bucket(table["pairs"].to_pylist())
    keep = np.flatnonzero(bucket.main + bucket.tune)
    first = np.zeros(len(keep), bool)
    first[np.unique(bucket.of[keep], return_index=True)[1]] = True
    return pa.table({"word": bucket.words.take(pa.array(bucket.of[keep])), "accent": pa.array(bucket.accent[keep], pa.int32()), "main": bucket.main[keep],
                     "tune": bucket.tune[keep], "first": first})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the hashed contexts of a range of words: (predictor, range of slots, packed slots and counts)."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    read = pa.Table.from_batches(rows)
    main, tune = (read[c].to_numpy() for c in ("main", "tune"))
    accents, words = read["accent"].to_numpy(), read["word"].combine_chunks()
    keep = pc.sort_indices(pa.table({"accent": accents, "word": words}), [("accent", "ascending"), ("word", "ascending")]).to_numpy()
    keep = keep[(main + tune)[keep] > 0]
    words, accents, main, tune = words.take(pa.array(keep)), accents[keep], main[keep], tune[keep]
    for first in range(0, len(SLOTS), TOGETHER):
        some = range(first, min(first + TOGETHER, len(SLOTS)))
        counts = {k: np.zeros((4, 1 << SLOTS[k]), np.int64) for k in some}  # zeros and ones of the main folds, zeros and ones of the tuning fold
        for at in range(0, len(keep), COUNTED):
            whole = Bytes(words.slice(at, COUNTED).to_pylist(), accents[at:at + COUNTED])
            data, node_of = whole.distinct()
            nodes, next_bits = zip(*(decisions(data.byte, bit) for bit in range(8)))
            one = np.concatenate(next_bits)
            times = []
            for x in (main, tune):
                sums = np.zeros(len(data.byte), np.int64)
                np.add.at(sums, node_of, x[at:at + COUNTED][whole.word])
                times.append(np.tile(sums, 8))
            chosen = [np.flatnonzero(t) for t in times]
            for predictor in some:
                cell = np.concatenate([data.slots(predictor, slice(None), node.astype(np.uint64)) for node in nodes])
                cell += one << SLOTS[predictor]
                for fold, (t, c) in enumerate(zip(times, chosen)):
                    np.add.at(counts[predictor][2 * fold:2 * fold + 2].reshape(-1), cell[c], t[c])
        for predictor in some:
            for part in range(1 << SLOTS[predictor] - 18):
                x = counts[predictor][:, part << 18:(part + 1) << 18]
                used = np.flatnonzero(x.any(axis=0))
                content = packed(np.diff(used, prepend=0), *x[:, used])
                yield pa.RecordBatch.from_arrays([pa.array([predictor], pa.int32()), pa.array([part], pa.int32()), pa.array([content], pa.binary())],
                                                 ["predictor", "part", "counts"])


def _summed(table: pa.Table, least: int) -> pa.Table:
    """Logits of one range of slots from the tasks' counts, of the main folds and of all."""
    total = np.zeros((4, 1 << 18), np.int64)
    for counts in table["counts"]:
        steps, *x = unpacked(counts.as_py())
        total[:, np.cumsum(steps)] += x
    total[:, total.sum(axis=0) < least] = 0
    folds = [logits(*total[:2]).tobytes(), logits(*(total[:2] + total[2:])).tobytes()]
    return pa.table({"predictor": table["predictor"][:1], "part": table["part"][:1], "main": pa.array(folds[:1], pa.binary()), "every": pa.array(folds[1:], pa.binary())})


def tables(pairs: DataFrame, least: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The predictors' tables from the counts of the main folds, and those of all training folds; each together sum(2 ** SLOTS) bytes."""
    counts = pairs.mapInArrow(_counted, "predictor int, part int, counts binary")
    found = counts.groupBy("predictor", "part").applyInArrow(lambda table: _summed(table, least), "predictor int, part int, main binary, every binary")
    main, every = ([np.zeros(1 << bits, np.int8) for bits in SLOTS] for _ in range(2))
    for row in found.toArrow().to_pylist():
        for made, fold in ((main, row["main"]), (every, row["every"])):
            made[row["predictor"]][row["part"] << 18:(row["part"] + 1) << 18] = np.frombuffer(fold, np.int8)
    return main, every


def _learned(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Learn online from a task's pairs; rows (at, total, weight) of weights and refinement cells."""
    learner = Learner(Model(sent.value))
    for batch in batches:
        if batch.num_rows:
            for _ in range(EPOCHS):
                learner.learn(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False))
    w, seen = learner.model.weights.ravel(), learner.seen
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w) + learner.ones.size)), pa.array(np.concatenate([w * seen, learner.ones.ravel()])),
                                          pa.array(np.concatenate([np.full(len(w), seen), learner.count.ravel()]))], ["at", "total", "weight"])


def tuned(pairs: DataFrame, made: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refinement, averaged over the tasks that learned them."""
    sent = pairs.sparkSession.sparkContext.broadcast(made)
    mine = pairs.where("tune > 0")
    # pairs come in word order: deal them out so that every learner sees all kinds, and enough of them
    mixed = mine.repartition(max(1, mine.count() // LEARNER_PAIRS), "word", "accent").sortWithinPartitions(F.xxhash64("word", "accent"))
    learned = mixed.mapInArrow(lambda batches: _learned(batches, sent), "at bigint, total double, weight double")
    found = learned.groupBy("at").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight")).toArrow()
    start = Model(made)
    both = np.concatenate([start.weights.ravel(), start.refined.ravel()])
    cells = start.weights.size
    at, total, weight = (found[c].to_numpy() for c in ("at", "total", "weight"))
    prior = np.where(at < cells, 0.0, MAP_PRIOR)
    both[at] = (total + prior * both[at]) / np.maximum(weight + prior, 1e-9)
    return both[:cells].reshape(start.weights.shape), both[cells:].reshape(start.refined.shape)


def fit(pairs: DataFrame, total: int) -> Model:
    """The model of `total` training words; without any, its start."""
    if not total:
        return Model([np.zeros(1 << bits, np.int8) for bits in SLOTS])
    main, every = tables(pairs, SEEN)
    return Model(every, *tuned(pairs, main))


def _priced(table: pa.Table, sent) -> pa.Table:
    """What the model takes for a bucket's pairs, by block: its words' sizes, classes, training counts and own counts, its pairs' bits."""
    bucket = Bucket(table["pairs"].to_pylist())
    bits = sent.value.bits(bucket.own_words(), bucket.accent).astype(np.float32)
    own = np.fromiter(map(accent_class, bucket.words.to_pylist()), np.int64, len(bucket.words))
    size = pc.binary_length(bucket.words).to_numpy() + (np.arange(len(bucket.words)) != _place_of(bucket.words, END))
    prices, start = [], 0
    for place, accent, counts, span in bucket.rows:
        word, pair = bucket.word[span], bucket.pair[start:start + len(place)]
        start += len(place)
        seen = np.zeros(len(word), np.int64)
        np.add.at(seen, place, sum(counts))
        prices.append(packed(size[word], own[word], bucket.count[word], seen, np.diff(place, prepend=0), accent, bits[pair]))
    return pa.table({"block": table["block"], "bucket": table["bucket"], "prices": pa.array(prices, pa.binary())})


def _place_of(words: pa.Array, word: bytes) -> int:
    return pc.index(words, pa.scalar(word, pa.binary())).as_py()


def _scored(texts: pa.Table, prices: pa.Table, total: int, distinct: int) -> pa.Table:
    """Scores of the texts of a block, given the training counts and bits of its words."""
    rows = [unpacked(x) for x in prices.sort_by("bucket")["prices"].to_pylist()]
    base = np.cumsum([0, *(len(r[0]) for r in rows)])
    size, own, count, seen = (np.concatenate([r[k] for r in rows]) for k in range(4))
    order = np.argsort(-seen, kind="stable")  # word numbers go by falling count
    bits = np.zeros((len(size), CLASSES), np.float32)
    for start, (*_, step, accent, taken) in zip(base.tolist(), rows):
        bits[start + np.cumsum(step), accent] = taken
    size, own, count, bits = size[order], own[order], count[order], bits[order]
    known, gained = (count > 0).astype(np.int64), np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))
    made = []
    for docs, held, sizes, words in zip(*(texts[c].to_pylist() for c in ("docs", "held", "sizes", "words"))):
        ids, starts = unpacked(words)[0], np.cumsum([0, *sizes])
        taken = [bits[ids[a:b], classes_before(own[ids[a:b]])] for a, b in zip(starts[:-1], starts[1:])]
        starts = starts[:-1]
        made.append(pa.table({
            "doc_id": pa.array(docs, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": np.add.reduceat(known[ids], starts), "base_score": np.add.reduceat(gained[ids], starts),
            "score": -np.add.reduceat(np.concatenate(taken).astype(float), starts) * math.log10(2), "n_bytes": np.add.reduceat(size[ids], starts)}))
    return pa.concat_tables(made)


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark, at = docs.sparkSession, scratch_path(docs.sparkSession, "blocks")
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), C.text_bytes(text))
    least, most = BUCKETS
    buckets = min(most, max(least, PER_TASK * read.rdd.getNumPartitions()))
    read.mapInArrow(lambda batches: _blocks(batches, buckets), BLOCKS).write.parquet(at)
    blocks = spark.read.schema(BLOCKS).parquet(at)
    parts = blocks.where(F.col("bucket").isNotNull()).select("block", "bucket", "pairs")
    pairs = materialise(parts.groupBy("bucket").applyInArrow(_summed_pairs, PAIRS), "pairs")
    total, distinct = pairs.agg(F.coalesce(F.sum(F.col("main") + F.col("tune")), F.lit(0)), F.count_if("first")).first()
    sent = spark.sparkContext.broadcast(fit(pairs, total))
    priced = parts.groupBy("bucket").applyInArrow(lambda table: _priced(table, sent), "block bigint, bucket int, prices binary")
    texts = blocks.where(F.col("bucket").isNull()).select("block", "docs", "held", "sizes", "words")
    scored = texts.groupBy("block").cogroup(priced.groupBy("block")).applyInArrow(
        lambda left, right: _scored(left, right, total, distinct),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score",
                         bits_per_byte(F.col("score"), F.col("n_bytes")).alias("bits_per_byte"))


def bits_per_byte(score: Column, n_bytes: Column) -> Column:
    return -score / F.lit(math.log10(2)) / n_bytes
