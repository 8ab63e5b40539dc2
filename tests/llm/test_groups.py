"""MinHash near-duplicates, bisector clusters and collocations against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from vectorlab.llm import centroids, collocations, minhash
from vectorlab.llm import quotient_filter as Q
from vectorlab.session import BROADCAST_BYTES_KEY

from .conftest import odd_texts


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- near copies by shingle sets

def slow_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {" ".join(words[i:i + 2]) for i in range(len(words) - 1)} or ({words[0]} if words else set())


def slow_groups(texts, percent=80):
    """Smallest position of each text's component."""
    sets, label = [slow_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return sets, label


def near_rows(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def wanted_rows(rows):
    sets, label = slow_groups([t for _, t in rows])
    least = {c: min((i for (i, _), l in zip(rows, label) if l == c and i is not None), default=None) for c in label}
    return Counter((i, len(s), i if not s else least[c], i == (i if not s else least[c])) for (i, _), s, c in zip(rows, sets, label))


def test_minhash(odd, nothing):
    assert near_rows(minhash.near_duplicates(odd)) == wanted_rows(odd_texts())
    empty = minhash.near_duplicates(nothing)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def mutated(rng, base, share):
    return " ".join(rng.choice(["zeta", "eta", "theta", str(rng.random())]) if rng.random() < share else w for w in base)


def test_minhash_of_a_dense_group(spark, monkeypatch):
    """A large group whose members are partly above, partly below the threshold, among chains and short texts."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(90)]
    texts = [mutated(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.1, 0.2])) for _ in range(150)]
    chain = [word() for _ in range(140)]
    texts += [" ".join(chain[i:i + 100]) for i in range(0, 40, 4)]
    texts += ["a b c d e", "a b c d e f", "a b c d", "b c d e", "a b", "b a", "a", "A B  c D e"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = wanted_rows(rows)
    assert len({c for _, _, c, _ in want}) > 10
    assert near_rows(minhash.near_duplicates(docs)) == want
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "MEET", 20)
    assert near_rows(minhash.near_duplicates(docs)) == want


def test_minhash_keys_meet_within_the_threshold():
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 1 << 16, (300, minhash.POSITIONS), dtype=np.uint64).astype(np.uint16)
    other = sig.copy()
    for row in other:
        row[rng.choice(minhash.POSITIONS, minhash.THRESHOLD, replace=False)] ^= 1
    assert ((minhash.keys(sig) == minhash.keys(other)).any(axis=1)).all()
    assert minhash.keys(sig).shape[1] == math.comb(minhash.WIDTH, minhash.ERRORS) * minhash.CHUNKS
    assert len(np.unique(minhash.keys(sig))) == minhash.keys(sig).size


def test_minhash_signature_agrees_with_similarity():
    rng = np.random.default_rng(6)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (6000, 500, 1000))
    same = np.mean(minhash.signature(np.concatenate([common, a])) == minhash.signature(np.concatenate([common, b])))
    assert abs(same - 0.8) < 0.15
    assert minhash.least_linked(80) == 4 and minhash.least_linked(100) == 1


def test_minhash_layout_bounds_the_similarity(odd):
    with pytest.raises(ValueError):
        minhash.near_duplicates(odd, percent=70)


# --- clusters

def slow_clusters(rows, k, rounds, dims, scale=64, seed=1):
    """Rows (id, vector) to a list of (id, cluster, distance) and the centroids; whole numbers throughout."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    by_hash = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in by_hash[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centres)), key=lambda c: (far(v, centres[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)].append(v)
        centres = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else old for c, old in enumerate(centres)]
    return [(i, nearest(v), far(v, centres[nearest(v)])) for i, v in kept], centres


def check_clusters(spark, rows, k, rounds, dims, kind="float"):
    df = spark.createDataFrame([(v, i, 1) for i, v in rows], f"embedding array<{kind}>, vec_id bigint, cluster int").repartition(3)
    got = centroids.clusters(df, dims=dims, k=k, rounds=rounds).collect()
    want, centres = slow_clusters(rows, k, rounds, dims)
    fits = lambda v: v if v < 1 << 63 else None
    sums = Counter()
    for _, c, d in want:
        sums[c] += d
    sha = lambda c: hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
    assert Counter(map(tuple, got)) == Counter((i, c, fits(d), fits(sums[c]), fits(sum(sums.values())), sha(c)) for i, c, d in want)


def test_clusters(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(200, 6)))]
    odd = [(200, None), (201, [1.0] * 5), (202, [1.0] * 7), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] + [0.0] * 5),
           (205, [0.0] * 5 + [float("inf")]), (206, []), (None, [0.5] * 6), (None, [0.25] * 6), (3, [0.0] * 6), (3, [0.0] * 6), (207, [-0.0] * 6)]
    for k, rounds in ((16, 3), (2, 1), (1, 2), (5, 0)):
        check_clusters(spark, rows + odd, k, rounds, 6)


def test_clusters_with_ties_and_copies(spark):
    rows = [(i, [float(i % 3), float(i % 2)]) for i in range(60)] + [(i, [0.5, 0.5]) for i in range(60, 70)]
    check_clusters(spark, rows, 8, 3, 2)
    check_clusters(spark, rows[:3], 16, 3, 2)


def test_clusters_of_huge_components(spark):
    rows = [(i, [float(i), -float(i), 0.3]) for i in range(30)] + [(30, [1e38, -1e38, 1.0]), (31, [2.0 ** 40, 0.0, 0.0]), (32, [1e300, 1.7e308, -1e-300]), (33, [2.0 ** 30, 1.0, 1.0])]
    check_clusters(spark, rows, 6, 3, 3, "double")
    check_clusters(spark, rows, 34, 1, 3, "double")


def test_clusters_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    only_bad = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    for df in (none, only_bad):
        found = centroids.clusters(df)
        assert found.count() == 0
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-9, 9), min_size=2, max_size=2), min_size=1, max_size=9),
       st.lists(st.lists(st.integers(-9, 9), min_size=2, max_size=2), min_size=1, max_size=20))
def test_tournament_finds_the_nearest(centres, points):
    field = centroids.Tournament(centres)
    want = [min(range(len(centres)), key=lambda c: (sum((x - y) ** 2 for x, y in zip(p, centres[c])), c)) for p in points]
    assert field.winners(np.array(points)).tolist() == field.winners(np.array(points, object)).tolist() == want


# --- collocations

def slow_collocations(rows, least, longest=5, top=2000, scale=1000, cover=100):
    out, by_lang = [], defaultdict(list)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            by_lang["und" if lang is None else lang].append(re.findall(r"[^\x20\x09]+", piece))
    for lang, pieces in by_lang.items():
        n = sum(map(len, pieces))
        f = Counter(tuple(p[i:i + m]) for p in pieces for m in range(1, longest + 1) for i in range(len(p) - m + 1))
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in often.items():
            score, k = min((scale * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            inside = any(len(h) > len(g) and 100 * b >= cover * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in often.items())
            if not inside:
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "été", "x²", "new", "york", "of", "the", "B"]
    line = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "; "]) for _ in range(rng.randint(1, 60)))
    rows = [(rng.choice(["en", "en", "fr", None, "und"]), line() + " in the city of new york " * rng.randint(0, 3)) for _ in range(70)]
    return rows + [("en", None), (None, ""), ("de", "one two"), ("fr", "\u0000 nul"), ("en", "the the the the the the the " * 30), rows[0], rows[0]]


def found_phrases(spark, rows, **settings):
    df = spark.createDataFrame([(t, l, 1, "w") for l, t in rows], "text string, lang string, rank int, word string").repartition(4)
    return sorted(tuple(r) for r in collocations.collocations(df, **settings).collect())


@pytest.mark.parametrize("least, longest, top, cover", [(3, 5, 2000, 100), (2, 3, 7, 100), (5, 5, 2000, 80), (1, 4, 2000, 100)])
def test_collocations(spark, least, longest, top, cover):
    rows = phrase_rows()
    want = slow_collocations(rows, least, longest, top, cover=cover)
    assert len(want) > 10
    assert found_phrases(spark, rows, least=least, longest=longest, top=top, cover=cover) == want


def test_collocations_without_broadcast_and_with_a_full_bitmap(spark, monkeypatch):
    rows = phrase_rows()
    monkeypatch.setattr(collocations, "BITMAP_BITS", 6)
    spark.conf.set(BROADCAST_BYTES_KEY, "100")
    try:
        assert found_phrases(spark, rows, least=3) == slow_collocations(rows, 3)
    finally:
        spark.conf.unset(BROADCAST_BYTES_KEY)


def test_collocations_of_nothing(spark, nothing):
    assert collocations.collocations(nothing).count() == 0
    assert found_phrases(spark, [("en", "just a few words"), (None, None)]) == []


def test_long_texts_are_sliced_at_blanks():
    text = b"Aa bb, cc\tdd " * 1000
    parts = list(collocations.slices(text, 100))
    assert len(parts) > 50 and b"".join(parts) == text
    assert [w for p in parts for w in collocations.tokens(p)] == collocations.tokens(text)
    assert list(collocations.slices(b"x" * 1000, 10)) == [b"x" * 1000]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 25), st.integers(2, 5), st.integers(0, 2000), st.integers(0, 9))
def test_filters_lose_nothing(bits, n, size, prefix):
    rng = np.random.default_rng(size)
    ids = [rng.integers(0, min(1 << bits, 50 if size % 2 else 1 << 30), size, dtype=np.uint64) for _ in range(n)]
    width = Q.half_bits(n, bits)
    high, low = Q.pack(ids, bits)
    assert all((a == b).all() for a, b in zip(Q.unpack(high, low, n, bits), ids))
    ph, pl = Q.permute(high, low, width)
    assert all((a == b).all() for a, b in zip(Q.restore(ph, pl, width), (high, low)))
    want = Counter(zip(*(c.tolist() for c in ids)))
    prefix = min(prefix, width)
    weights = rng.integers(1, 1 << int(rng.integers(1, 40)), size)
    total = Counter()
    for gram, w in zip(zip(*(c.tolist() for c in ids)), weights.tolist()):
        total[gram] += w
    halves = [Q.Counter(width, 64) for _ in range(2)]
    for part, where in zip(halves, (slice(None, size // 3), slice(size // 3, None))):
        part.add(ph[where], pl[where], weights[where])
    merged = Q.Counter(width, 64)
    for part in halves:  # write, read and merge range by range
        a, b, c = part.merge()
        block = (a >> np.uint64(width - prefix)).astype(np.int64) if prefix else np.zeros(len(a), np.int64)
        for value in np.unique(block).tolist():
            inside = block == value
            merged.add(*Q.read(Q.write(a[inside], b[inside], c[inside], width, prefix), width, value))
    a, b, c = merged.merge()
    columns = Q.unpack(*Q.restore(a, b, width), n, bits)
    assert dict(zip(zip(*(x.tolist() for x in columns)), c.tolist())) == dict(total)
    assert len(want) == len(c)


def test_filters_have_a_limit():
    with pytest.raises(ValueError):
        Q.half_bits(5, 26)
