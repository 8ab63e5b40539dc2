import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from vectorlab.llm import components, exact_dedup, simhash, suffix_dedup, suffix_sort

from .conftest import odd_texts


# --- exact copies

def test_exact_duplicates(odd):
    rows = odd_texts()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    want = Counter((i, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())
                   for i, t in rows)
    got = exact_dedup.exact_duplicates(odd).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_exact_duplicates_keeps_columns(odd, nothing):
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in odd_texts()})
    assert exact_dedup.drop_exact_duplicates(nothing).count() == exact_dedup.exact_duplicates(nothing).count() == 0


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 60_000, np.uint8).tobytes()
    whole = exact_dedup.chunks(data)
    assert b"".join(whole) == data and max(map(len, whole)) <= exact_dedup.LONGEST
    moved = exact_dedup.chunks(b"some more bytes before " + data)
    assert len(set(whole) & set(moved)) > 0.8 * len(whole)
    assert exact_dedup.chunks(b"") == [] and exact_dedup.chunks(b"short") == [b"short"]


def odd_chunks():
    return [exact_dedup.chunks(exact_dedup.normalise((t or "").encode())) for _, t in odd_texts()]


@pytest.mark.parametrize("bits", [64, 3])
def test_chunk_table(odd, bits):
    rows = {r.chunk_id: r for r in exact_dedup.chunk_table(exact_dedup.recipes(odd, bits=bits)).collect()}
    uses = Counter(c for chunks in odd_chunks() for c in chunks)
    want = defaultdict(list)
    for c in uses:
        want[xxhash.xxh64_intdigest(c) >> 64 - bits].append(c)
    assert {i & (1 << bits) - 1 for i in rows} == set(want)
    for i, r in rows.items():
        mine = want[i & (1 << bits) - 1]
        assert r.uses == sum(uses[c] for c in mine) and r.several == (len(mine) > 1)


def test_identifiers_tell_chunks_of_one_hash_apart(odd):
    # three bits leave eight hashes: nearly every chunk shares one, and the numbers alone must decide
    rows = exact_dedup.identified(exact_dedup.recipes(odd, bits=3)).collect()
    found = {}
    for r in rows:
        number = {x.place: x.number for x in r.numbers}
        found.setdefault(tuple((i, number.get(k, 0)) for k, i in enumerate(r.recipe)), set()).add(bytes(r.sha))
    assert all(len(shas) == 1 for shas in found.values())
    assert len(found) == len({b"".join(c) for c in odd_chunks()})
    key = lambda r: (r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept, r.text_sha256)
    assert sorted(map(key, exact_dedup.exact_duplicates(odd, bits=3).collect())) == sorted(map(key, exact_dedup.exact_duplicates(odd).collect()))


def test_a_chunk_s_identifier_is_one_for_the_corpus(odd):
    found = defaultdict(set)
    for r in exact_dedup.occurrences(exact_dedup.recipes(odd)).collect():
        found[r.chunk_id].add((r.d0, r.d1, r.d2, r.d3))
    assert all(len(x) == 1 for x in found.values())
    assert {b"".join(d.to_bytes(8, "little", signed=True) for d in x) for y in found.values() for x in y} == {
        hashlib.sha256(c).digest() for chunks in odd_chunks() for c in chunks}


# --- near copies

def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(fps, distance=3):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_near_duplicates(odd, nothing):
    rows = odd_texts()
    fps = [slow_fingerprint(t) for _, t in rows]
    label = slow_components(fps)
    first = {c: min((rows[i][0] for i in range(len(rows)) if label[i] == c and rows[i][0] is not None), default=None) for c in label}
    want = Counter((i, f"{fp:016x}", first[c]) for (i, _), fp, c in zip(rows, fps, label))
    assert Counter(map(tuple, simhash.near_duplicates(odd).collect())) == want
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(label))
    assert simhash.near_duplicates(nothing).count() == simhash.drop_near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("largest", [100, 4096])
def test_links_find_every_component(spark, largest):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 60, np.uint64)
    for _ in range(3):  # close ones around each, and many that share a quarter
        near = fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64))
        fps = np.concatenate([fps, near])
    fps = np.unique(np.concatenate([fps, (np.uint64(0xABCD) << np.uint64(48)) | rng.integers(0, 1 << 40, 300, np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint").repartition(3)
    found = {r.node: r.root for r in components.components(simhash.links(df, largest=largest), "a", "b").collect()}
    label = slow_components([int(x) for x in fps])
    signed = fps.view(np.int64).tolist()
    want = defaultdict(set)
    for x, c in zip(signed, label):
        want[c].add(x)
    got = defaultdict(set)
    for x in signed:
        got[found.get(x, x)].add(x)
    assert {frozenset(s) for s in want.values()} == {frozenset(s) for s in got.values()}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(1000, 1001), (5, 5)], "a bigint, b bigint").repartition(4)
    found = {r.node: r.root for r in components.components(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(41)}, 1000: 1000, 1001: 1000}


def test_gray_rank_neighbours_differ_in_one_bit(spark):
    ranks = spark.sql("select id, id fp from range(16)").select("fp", simhash.gray_rank(simhash.F.col("fp")).alias("r")).sort("r").collect()
    assert all(bin(a.fp ^ b.fp).count("1") == 1 for a, b in zip(ranks, ranks[1:]))


# --- repeated substrings

def slow_repeats(texts, length=200):
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    for b in texts:
        hit = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                hit[i] += 1
                hit[i + length] -= 1
        hit = np.cumsum(hit)[:-1] > 0
        yield len(b), int(hit.sum()), int((np.diff(np.append(0, hit.astype(int))) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~hit])).hexdigest()


@pytest.mark.parametrize("largest", [100, 20_000])
def test_remove_repeats(odd, largest):
    rows = odd_texts()
    want = Counter((i, *r) for (i, _), r in zip(rows, slow_repeats([(t or "").encode() for _, t in rows])))
    assert Counter(map(tuple, suffix_dedup.remove_repeats(odd, largest=largest).collect())) == want


def test_remove_repeats_edges(spark, nothing):
    rng = np.random.default_rng(5)
    letters = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    p199, p200, p350 = letters(199), letters(200), letters(350)
    texts = [letters(50) + p199 + letters(9), letters(70) + p199, p200, "z" + p200 + "y", letters(33) + p350 + letters(500), p350[:260] + letters(3), p350[40:],
             p350 + letters(20) + p350, "ab" * 150, "ba" * 101, "\0" * 250, "é" * 150]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    want = {i: r for i, r in enumerate(slow_repeats([t.encode() for t in texts]))}
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()} == want
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.kept_texts(df).collect()}
    assert all(hashlib.sha256(kept[i]).hexdigest() == want[i][3] for i in kept)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("rows", [[4], [7], [1, 2, 3], [4, 4], [9, 1, 5, 5, 1, 8], [3, 30, 2, 1, 1, 12]])
def test_no_span_is_lost_where_batches_end(monkeypatch, rows):
    """Buckets of one window and of several, in small batches that end anywhere."""
    monkeypatch.setattr(suffix_dedup, "BATCH", 4)
    rng = np.random.default_rng(6)
    table, want = [], set()
    for bucket, n in enumerate(rows):
        window = bytes(rng.integers(97, 123, suffix_dedup.LENGTH, np.uint8))
        d = int(rng.integers(0, 50))
        for i in range(n):
            row = 1000 * bucket + i
            wide = bucket % 3 == 2
            table.append((bucket, d, d + 1 if wide else d, row, 100, True, d, window))
            if n > 1:
                want.add((row, 100 - d, 100 - d + suffix_dedup.LENGTH))
    names = ["key", "low", "high", "row", "at", "single", "ahead", "bytes"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    for size in (1, 2, 3, 4, 5, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table[i:i + size]), types)], names) for i in range(0, len(table), size)]
        got = {(r["row"], r["start"], r["end"]) for b in suffix_dedup._search(iter(batches)) for r in b.to_pylist()}
        assert got == want


def test_anchors_of_pieces(monkeypatch):
    data = np.random.default_rng(2).integers(97, 101, 5000, np.uint8).tobytes()
    at, h = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    at2, h2 = suffix_dedup.anchors(data)
    assert at.tolist() == at2.tolist() and h.tolist() == h2.tolist()
    assert np.diff(at).max() <= suffix_dedup.REACH + 1


def test_suffix_order_is_the_sorted_order():
    rng = np.random.default_rng(4)
    common = [bytes(rng.integers(97, 99, k, np.uint8)) for k in (0, 5, 30, 60)]
    strings = [(common[i % 4] + bytes(rng.integers(97, 99, 64, np.uint8)))[:64] for i in range(500)] + [b"a" * 64] * 3 + [b"\xff" * 64, b"\0" * 64]
    group = rng.integers(0, 3, len(strings))
    words = suffix_sort.as_words(np.frombuffer(b"".join(strings), np.uint8).reshape(-1, 64))
    order = suffix_sort.sort_groups(words, group)
    assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
    shared = suffix_sort.neighbours_share(words, order, group, np.full(len(strings), 64))
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        want = next((i for i in range(64) if a[i] != b[i]), 64) if group[order[k - 1]] == group[order[k]] else -1
        assert shared[k] == want
