"""Phrases whose words keep company, from exact counts of all word sequences of up to five words.

Texts are split into pieces at PIECES and these into words. All counts are per language (null: `und`).

1. Tasks count words; words seen `least` times or more get numbers, as no candidate has any other. Texts are written
   once as lists of these numbers, with 0 for all else and between pieces.
2. For two words, then three, up to `longest`: every task counts its n-grams in a counting quotient filter (see
   quotient_filter.py), cuts it by leading bits of the permuted n-grams and sends the parts; the parts of one range
   are merged like sorted lists. An n-gram is counted only if both (n-1)-grams inside it are marked in a bitmap of
   bounded size that marks all frequent ones and perhaps a few others; so nothing frequent is lost, and the counts are
   exact however full the bitmap is. What is frequent is written with its count.
3. Scores come from joins of the phrases with their parts. Products are decimals of 38 digits.

Hot phrases are added up inside each task before anything is shuffled, and ranges of permuted n-grams are even. The word
numbers are broadcast only if they fit the limit; else words are numbered by a shuffled join. Filters hold at most
128 bits of ids, so phrases of five words allow 2^25 frequent words; more are an error.

Null text counts as empty; ids are not read; equal rows count each; texts of any length are taken in slices. Further
columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter as Tally
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_limit, materialise
from . import common as C
from . import quotient_filter as Q

LEAST, LONGEST, TOP, SCALE, COVER = 100, 5, 2000, 1000, 100
BREAK = b"\xff"  # never part of UTF-8
PIECES = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(0xFF if b in PIECES else b + 32 if 65 <= b <= 90 else b for b in range(256))
SLICE, WORDS = 1 << 20, 1 << 20
BITMAP_BITS, RANGE, RANGES = 27, 18, 17
SHARES = 64  # parts of a language that are ranked by themselves first
ENTRY_BYTES = 120  # a word in a worker's dictionary, besides its letters


def slices(data: bytes, size: int = SLICE) -> Iterator[bytes]:
    """Parts of a text, cut at blanks."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size) if at + size < len(data) else len(data)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def tokens(data: bytes) -> list[bytes]:
    """Words of a text or slice, BREAK where a piece ends."""
    return data.translate(TABLE).replace(BREAK, b" " + BREAK + b" ").split()


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for lang, text in zip(batch.column(0).to_pylist(), C.byte_texts(batch.column(1))):
        yield lang, text


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, a) of a task, and its words per language with a null word."""
    held: dict[str, Tally] = {}
    total: Tally = Tally()

    def rows():
        langs, words, counts = [], [], []
        for lang, tally in held.items():
            langs += [lang] * len(tally)
            words += [w.decode("utf-8", "replace") for w in tally]
            counts += tally.values()
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "a"])

    for batch in batches:
        for lang, text in _rows(batch):
            for part in slices(text):
                found = tokens(part)
                tally = held.setdefault(lang, Tally())
                tally.update(found)
                total[lang] += len(found) - tally.pop(BREAK, 0)
        if sum(map(len, held.values())) > WORDS:
            yield rows()
    yield rows()
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([None] * len(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                     ["lang", "word", "a"])


def vocabulary(texts: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of `texts(lang, data)`, and the words seen `least` times as (id, lang, word, a), numbered from 1 without gaps."""
    counts = texts.mapInArrow(_tallied, "lang string, word string, a bigint").groupBy("lang", "word").agg(F.sum("a").alias("a"))
    found = materialise(counts.where(F.col("word").isNull() | (F.col("a") >= least)).withColumn("at", F.monotonically_increasing_id()), "words")
    words = found.where("word is not null")
    part = F.shiftrightunsigned("at", 33)
    in_part = Window.partitionBy("part").orderBy("at")
    words = words.withColumn("part", part).withColumn("place", F.row_number().over(in_part))
    sizes = words.groupBy("part").count().orderBy("part").collect()  # one row per task of the word count
    starts, upto = [], 0
    for r in sizes:
        starts.append((r["part"], upto))
        upto += r["count"]
    offsets = texts.sparkSession.createDataFrame(starts, "part bigint, start int")
    numbered = words.join(F.broadcast(offsets), "part").select((F.col("start") + F.col("place")).cast("int").alias("id"), "lang", "word", "a")
    return found.where("word is null").select("lang", F.col("a").alias("n")), materialise(numbered, "vocabulary")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32), pa.int32()))


def _encode_broadcast(texts: DataFrame, words: DataFrame) -> DataFrame:
    table: dict[str, dict[bytes, int]] = {}
    for r in words.select("lang", "word", "id").toArrow().to_pylist():  # checked by the caller
        table.setdefault(r["lang"], {})[r["word"].encode()] = r["id"]
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            out = []
            for lang, text in _rows(batch):
                known = shared.value.get(lang, {}).get
                parts = [np.fromiter((known(w, 0) for w in tokens(part)), np.int32) for part in slices(text)]
                out.append(np.concatenate([*parts, np.zeros(1, np.int32)]))
            yield pa.RecordBatch.from_arrays([_lists(out)], ["ids"])

    return texts.mapInArrow(run, "ids array<int>")


def _encode_shuffled(texts: DataFrame, words: DataFrame) -> DataFrame:
    def spread(batches):
        for batch in batches:
            for row, (lang, text) in zip(batch.column(2).to_pylist(), _rows(batch)):
                at = 0
                for part in slices(text):
                    found = tokens(part)
                    place = [i for i, w in enumerate(found) if w != BREAK]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(place), pa.int64()), pa.array([at + i for i in place], pa.int64()), pa.array([lang] * len(place), pa.string()),
                         pa.array([found[i].decode("utf-8", "replace") for i in place], pa.string())], ["row", "at", "lang", "word"])
                    at += len(found)

    def dense(batches):
        for batch in batches:
            out = []
            for places, ids in zip(batch.column(0), batch.column(1)):
                at = places.values.to_numpy()
                at = np.arange(len(at)) + np.append(0, np.cumsum(np.diff(at) > 1))  # one 0 for a gap
                line = np.zeros(at[-1] + 2, np.int32)
                line[at] = ids.values.to_numpy()
                out.append(line)
            yield pa.RecordBatch.from_arrays([_lists(out)], ["ids"])

    rows = materialise(texts.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    known = rows.mapInArrow(spread, "row bigint, at bigint, lang string, word string").join(words.select("lang", "word", "id"), ["lang", "word"])
    lines = known.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("l"))
    return lines.select(F.col("l.at").alias("at"), F.col("l.id").alias("id")).mapInArrow(dense, "ids array<int>")


def encoded(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(ids): each text as the numbers of its frequent words, 0 for others and where pieces end, and 0 at the end."""
    size = words.agg(F.count(F.lit(1)) * ENTRY_BYTES + F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()[0]
    small = size <= broadcast_limit(texts.sparkSession)
    return materialise(_encode_broadcast(texts, words) if small else _encode_shuffled(texts, words), "encoded-texts")


def _place(high: np.ndarray, low: np.ndarray, width: int, log: int) -> np.ndarray:
    """Leading `log` bits of permuted numbers."""
    if log <= width:
        return high >> np.uint64(width - log)
    return high << np.uint64(log - width) | low >> np.uint64(2 * width - log)


def _marked(place: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _starts(ids: np.ndarray, n: int, bits: int, known: tuple[np.ndarray, int] | None) -> np.ndarray:
    """Positions where n frequent words begin whose inner (n-1)-grams are marked."""
    good = ids > 0
    run = good.copy()
    for step in range(1, n - 1):
        run[:-step] &= good[step:]
        run[len(run) - step:] = False
    if known is not None:
        bitmap, log = known
        at = np.flatnonzero(run)
        width = Q.half_bits(n - 1, bits)
        run[at] = _marked(_place(*Q.permute(*Q.pack([ids[at + i] for i in range(n - 1)], bits), width), width, log), bitmap)
    both = run[:-1] & run[1:]
    return np.flatnonzero(both)


def _counting(n: int, bits: int, prefix: int, known):
    """Filters (range, data) of a task's n-grams."""
    width = Q.half_bits(n, bits)

    def parts(counter: Q.Counter):
        high, low, counts = counter.merge()
        block = (high >> np.uint64(width - prefix)).astype(np.int64)
        cut = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.empty(0, int)
        ends = np.append(cut[1:], len(block))
        for at in range(0, len(cut), 1024):
            some = list(zip(cut[at:at + 1024], ends[at:at + 1024]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[cut[at:at + 1024]]), pa.array([Q.write(high[a:b], low[a:b], counts[a:b], width, prefix) for a, b in some], pa.binary())], ["range", "data"])
        counter.clear()

    def run(batches):
        counter = Q.Counter(width)
        marks = known and (known[0].value, known[1])
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            at = _starts(ids, n, bits, marks)
            if len(at):
                counter.add(*Q.permute(*Q.pack([ids[at + i] for i in range(n)], bits), width))
            if counter.full():
                yield from parts(counter)
        yield from parts(counter)

    return run


def _merging(n: int, bits: int, least: int):
    """Frequent n-grams (ids, a, high, low) from the filters of ranges, sorted by range."""
    width = Q.half_bits(n, bits)

    def entries(counter: Q.Counter) -> pa.RecordBatch:
        high, low, counts = counter.merge()
        often = counts >= least
        high, low, counts = high[often], low[often], counts[often]
        counter.clear()
        ids = np.stack(Q.unpack(*Q.restore(high, low, width), n, bits), axis=1).astype(np.int32).ravel()
        lists = pa.ListArray.from_arrays(pa.array((np.arange(len(high) + 1) * n).astype(np.int32)), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([lists, pa.array(counts), pa.array(high.view(np.int64)), pa.array(low.view(np.int64))], ["ids", "a", "high", "low"])

    def run(batches):
        counter, now = Q.Counter(width), None
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now and now is not None:
                    yield entries(counter)
                now = block
                part = Q.read(data.as_py(), width, block)
                counter.add(*part)
        if now is not None:
            yield entries(counter)

    return run


def _bitmap(frequent: DataFrame, size: int, width: int, bits: int = BITMAP_BITS) -> tuple[np.ndarray, int]:
    """A bitmap of 2^log bits that marks `frequent(high, low)`; its size is bounded, whatever the number of rows."""
    log = min(2 * width, bits, max(6, (16 * size).bit_length()))

    def run(batches):
        for batch in batches:
            high, low = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2))
            place = _place(high, low, width, log)
            word, at = np.unique(place >> np.uint64(6), return_inverse=True)
            mask = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(mask, at, np.uint64(1) << (place & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])

    table = frequent.select("high", "low").mapInArrow(run, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(max(1, 1 << max(0, log - 6)), np.uint64)  # at most 2^21 rows of 64 bits
    bitmap[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return bitmap, log


def frequent_phrases(texts: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Word totals (lang, n), words (id, lang, word, a) and all sequences of 1 to `longest` words seen `least` times as (ids, a)."""
    spark = texts.sparkSession
    totals, words = vocabulary(texts, least)
    size = words.count()
    bits = max(1, size.bit_length())
    found = words.select(F.array("id").alias("ids"), "a")
    if size == 0:
        return totals, words, found
    Q.half_bits(longest, bits)
    lines = encoded(texts, words)
    length = lines.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    known = None
    for n in range(2, longest + 1):
        width = Q.half_bits(n, bits)
        prefix = min(width, RANGES, max(4, (length >> RANGE).bit_length()))
        parts = lines.mapInArrow(_counting(n, bits, prefix, known), "range bigint, data binary")
        merged = parts.repartition("range").sortWithinPartitions("range").mapInArrow(_merging(n, bits, least), "ids array<int>, a bigint, high bigint, low bigint")
        grams = materialise(merged, f"phrases-{n}")
        found = found.union(grams.select("ids", "a"))
        many = grams.count()
        if not many or n == longest:
            break
        bitmap, log = _bitmap(grams, many, width)
        known = spark.sparkContext.broadcast(bitmap), log
    return totals, words, found


def _scored(phrases: DataFrame, totals: DataFrame, words: DataFrame, scale: int) -> DataFrame:
    """(ids, lang, n, a, score, l, r) of every phrase of two words or more, by its lowest-scoring cut."""
    longer = phrases.where(F.size("ids") > 1).withColumn("first", F.col("ids")[0])
    langs = words.select(F.col("id").alias("first"), "lang").join(C.broadcast_checked(totals, 64), "lang")
    longer = longer.join(C.broadcast_checked(langs, 64), "first").drop("first")
    cut = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cut = cut.withColumn("left", F.slice("ids", F.lit(1), F.col("k"))).withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
    cut = cut.join(phrases.select(F.col("ids").alias("left"), F.col("a").alias("l")), "left").join(phrases.select(F.col("ids").alias("right"), F.col("a").alias("r")), "right")
    whole = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    cut = cut.withColumn("top", whole["a"] * whole["n"] * F.lit(scale).cast("decimal(38,0)")).withColumn("below", whole["l"] * whole["r"])
    cut = cut.withColumn("score", F.expr("top div below"))
    return cut.groupBy("ids", "lang", "n", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select("ids", "lang", "n", "a", "best.score", "best.l", "best.r")


def _uncovered(scored: DataFrame, phrases: DataFrame, cover: int) -> DataFrame:
    """Phrases that no longer phrase holds `cover` percent of whose count or more."""
    n = F.size("ids")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(
        F.sequence(F.lit(1), n - m + 1), lambda at: F.slice("ids", at, m))))
    held = phrases.where(n > 2).select(F.explode(inner).alias("ids"), F.col("a").alias("longer")).groupBy("ids").agg(F.max("longer").alias("longer"))
    kept = scored.join(held, "ids", "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, scale: int = SCALE,
                 cover: int = COVER) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), C.text_bytes(text).alias("data"))
    totals, words, phrases = frequent_phrases(texts, least, longest)
    scored = _uncovered(_scored(phrases, totals, words, scale), phrases, cover)
    order = [F.col("score").desc(), F.col("a").desc()]
    first = scored.withColumn("share", F.pmod(F.xxhash64("ids"), F.lit(SHARES)))  # a language may hold most phrases
    for within in (["lang", "share"], ["lang"]):
        first = first.withColumn("rank", F.rank().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("rank") <= top).drop("rank")
    spelled = first.select("ids", F.posexplode("ids").alias("at", "id")).join(C.broadcast_checked(words.select("id", "word"), 64), "id")
    spelled = spelled.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")).select("ids", F.concat_ws(" ", "w.word").alias("phrase"))
    ranked = first.drop("share").join(spelled, "ids").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def sql(least: int = LEAST, longest: int = LONGEST, top: int = TOP, scale: int = SCALE, cover: int = COVER) -> str:
    """The same over `documents` in DuckDB."""
    grams = "\nUNION ALL ".join(f"SELECT lang, w[p:p + {n - 1}] AS g FROM (SELECT lang, w, unnest(range(1, len(w) - {n} + 2)) AS p FROM pieces WHERE len(w) >= {n})"
                                for n in range(1, longest + 1))
    return rf"""
        WITH lines AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS line FROM documents),
        pieces AS (SELECT lang, regexp_extract_all(line, '[^\x20\x09]+') AS w FROM lines),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
        grams AS ({grams}),
        f AS (SELECT lang, g, count(*)::BIGINT AS a FROM grams GROUP BY lang, g HAVING count(*) >= {least}),
        c AS (SELECT lang, g, a FROM f WHERE len(g) > 1),
        cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM c),
        cut AS (SELECT x.lang, x.g, x.a, x.k, l.a AS l, r.a AS r, (({scale}::HUGEINT * x.a * t.n) // (l.a::HUGEINT * r.a)) AS s, t.n
                FROM cuts x JOIN f l ON l.lang = x.lang AND l.g = x.g[1:x.k] JOIN f r ON r.lang = x.lang AND r.g = x.g[x.k + 1:] JOIN totals t ON t.lang = x.lang),
        best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY s, k) AS place FROM cut) WHERE place = 1),
        spans AS (SELECT lang, g, a, unnest(range(2, len(g))) AS m FROM c WHERE len(g) > 2),
        inner_ AS (SELECT lang, g[p:p + m - 1] AS g, a FROM (SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS p FROM spans)),
        held AS (SELECT lang, g, max(a) AS longer FROM inner_ GROUP BY lang, g),
        kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.g = b.g WHERE h.longer IS NULL OR 100 * h.longer < {cover} * b.a),
        ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY s DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, s FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, s::BIGINT AS score FROM ranked WHERE rank <= {top}"""
