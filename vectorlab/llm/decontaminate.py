"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Words are runs of ASCII digits and letters, in lower case, and of bytes above ASCII. The items' words build one
suffix automaton, which is broadcast; the documents stream through it where they are read. After each word the
automaton knows the longest string of item words that ends there. Where that length reaches WINDOW, the last
WINDOW words are a window of an item and are hit; an item shorter than that is one window.

Only words of items can be in a match, so the automaton runs over stretches of such words that are at least as
long as the shortest window. Items are taken in blocks of at most BLOCK_WORDS words (a longer item is a block
of its own), so a broadcast has a known bound; each further block is another pass over the documents, and
the passes' spans are joined by row.

A null text has no words. An item without words never occurs. Items with equal ids are one item; a null id
counts as the empty string.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from . import common as C
from .toxicity import WORDS

WINDOW, BLOCK_WORDS = 10, 200_000
SPAN = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
FOUND = (T.StructType().add("n_words", T.LongType()).add("spans", T.ArrayType(SPAN)).add("items", T.ArrayType(T.StringType())))
FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         ("items", pa.list_(pa.string()))])


def words(data: bytes) -> list[bytes]:
    return data.translate(WORDS).split()


class Automaton:
    """Suffix automaton over the words of several items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ids = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item]) for name, item in items if item]
        ends = []
        for _, item in ids:
            last = 0
            for w in item:
                last = self._extend(last, w)
            ends.append(last)
        self.shortest = min((min(window, len(item)) for _, item in ids), default=0)
        self._mark(ids)

    def _new(self, length: int, link: int, go: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.go.append(go)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state that `word` leads to, cut so that its longest string is one word longer than the state's."""
        to = self.go[state][word]
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._new(self.length[state] + 1, self.link[to], dict(self.go[to]))
        self.link[to] = copy
        while state >= 0 and self.go[state].get(word) == to:
            self.go[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.go[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.go[last]:
            self.go[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def _mark(self, ids: list[tuple[str, list[int]]]) -> None:
        """window_state: the state of the last WINDOW words of a longer match. owners: items of these. short: short items that end there."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.window_state = [0] * len(self.length)
        for s in order:
            if self.length[s] >= self.window:
                up = self.link[s]
                self.window_state[s] = s if self.length[up] < self.window else self.window_state[up]
        self.owners: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, item in ids:
            state, size = 0, 0
            for w in item:
                state, size = self.step(state, size, w)
                if size >= self.window:
                    self.owners.setdefault(self.window_state[state], set()).add(name)
            if len(item) < self.window:
                self.short.setdefault(state, []).append((len(item), name))
        for s in order:
            above = self.short.get(self.link[s])
            if above:
                self.short[s] = self.short.get(s, []) + above

    def step(self, state: int, size: int, word: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while word not in self.go[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            size = self.length[state]
        return self.go[state][word], size + 1

    def search(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans of words, apart from each other and in order, and the names of the items found."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        ids = np.fromiter(map(self.vocabulary.get, text, repeat(-1)), np.int64, len(text))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin < self.shortest:
                continue
            state = size = 0
            for at, word in enumerate(ids[begin:end].tolist(), begin + 1):
                state, size = self.step(state, size, word)
                hit = 0
                if size >= self.window:
                    hit = self.window
                    names |= self.owners[self.window_state[state]]
                for length, name in self.short.get(state, ()):
                    if length <= size:
                        hit = max(hit, length)
                        names.add(name)
                if hit:
                    start = at - hit
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, at))
        return spans, names


def blocks(items: DataFrame, text: str, item_id: str, block_words: int) -> list[list[tuple[str, list[bytes]]]]:
    """Items as word lists in blocks of a bounded number of words; the items come to the driver one after the other."""
    made: list[list[tuple[str, list[bytes]]]] = [[]]
    size = 0
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), C.text_bytes(text).alias("data"))
    for row in named.sort("name", "data").toLocalIterator():
        item = words(bytes(row["data"]))
        if made[-1] and size + len(item) > block_words:
            made.append([])
            size = 0
        made[-1].append((row["name"], item))
        size += len(item)
    return made


def _search(docs: DataFrame, automaton: Automaton, text: str) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(automaton)

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for data in C.byte_texts(texts):
            text_words = words(data)
            spans, names = sent.value.search(text_words)
            rows.append({"n_words": len(text_words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(names)})
        return pa.array(rows, FOUND_ARROW)

    # or a filter on the result would be pushed below it and search every text twice
    return found.asNondeterministic()(C.text_bytes(text))


@F.arrow_udf(T.ArrayType(SPAN))
def _joined(spans: pa.Array) -> pa.Array:
    """Spans in any order as spans apart from each other."""
    rows = []
    for each in spans.to_pylist():
        apart: list[list[int]] = []
        for s in sorted((s["start"], s["end"]) for s in each or []):
            if apart and s[0] <= apart[-1][1]:
                apart[-1][1] = max(apart[-1][1], s[1])
            else:
                apart.append([*s])
        rows.append([{"start": a, "end": b} for a, b in apart])
    return pa.array(rows, pa.list_(FOUND_ARROW.field("spans").type.value_type))


def matches(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
            window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, str]:
    """docs with one more column, of the returned name: struct n_words, spans (of words), items (ids as strings, sorted)."""
    automata = [Automaton(block, window) for block in blocks(items, item_text, item_id, block_words)]
    name = C.free_name(docs, "_matches")
    if len(automata) == 1:
        return docs.withColumn(name, _search(docs, automata[0], text)), name
    whole, row = C.numbered_whole(docs, "documents")
    found = None
    for automaton in automata:
        one = materialise(whole.select(F.col(row).alias("row"), _search(whole, automaton, text).alias("m")).where("size(m.spans) > 0"), "matches")
        found = one if found is None else found.union(one)
    both = found.groupBy("row").agg(F.flatten(F.collect_list("m.spans")).alias("spans"), F.flatten(F.collect_list("m.items")).alias("items"))
    extra = C.free_name(whole, "_found")
    both = both.select(F.col("row").alias(row), F.struct(_joined("spans").alias("spans"), F.array_sort(F.array_distinct("items")).alias("items")).alias(extra))
    joined = whole.withColumn(name, _search(whole, Automaton([], window), text)).join(both, row, "left")
    m = F.struct(F.col(name)["n_words"].alias("n_words"), F.coalesce(F.col(extra)["spans"], F.col(name)["spans"]).alias("spans"),
                 F.coalesce(F.col(extra)["items"], F.col(name)["items"]).alias("items"))
    return joined.withColumn(name, m).drop(row, extra), name


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, m = matches(docs.select("doc_id", "text"), items, window=window, block_words=block_words)
    found = found.select("doc_id", F.col(m).alias("m"))
    hit = F.aggregate("m.spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("bigint")
    return found.select("doc_id", "m.n_words", hit.alias("n_hit"), F.size("m.items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("m.items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("m.spans") > 0).alias("contaminated"))


def _cut(data: bytes, spans: list[dict]) -> str:
    """The text without the bytes of its hit words and what stands between them."""
    mapped = np.frombuffer(data.translate(WORDS), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mapped, [False]]).astype(np.int8)))
    kept, at = [], 0
    for s in spans:
        begin, end = int(edge[2 * s["start"]]), int(edge[2 * s["end"] - 1])
        kept.append(data[at:begin])
        at = end
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


@F.arrow_udf(T.StringType())
def _cuts(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([_cut(data, s or []) for data, s in zip(C.byte_texts(texts), spans.to_pylist())], pa.string())


def remove_matches(docs: DataFrame, items: DataFrame, text: str = "text", longest: int = 0, coverage: float = 0.0,
                   item_text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Documents without benchmark passages, with all their columns.

    A hit span of more than `longest` words is cut out of its text. A document of whose words more than the
    share `coverage` is hit is dropped; at the default every document with a hit is. Documents without a hit stay as they are.
    """
    found, m = matches(docs, items, text, item_text, item_id, window)
    hit = F.aggregate(F.col(m)["spans"], F.lit(0), lambda n, s: n + s["end"] - s["start"])
    kept = found.where(hit <= coverage * F.col(m)["n_words"])
    if coverage <= 0:  # no document with a span is left
        return kept.drop(m)
    long = F.filter(F.col(m)["spans"], lambda s: s["end"] - s["start"] > longest)
    return kept.withColumn(text, F.when(F.size(long) > 0, _cuts(C.text_bytes(text), long)).otherwise(F.col(text))).drop(m)

