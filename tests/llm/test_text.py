import re
import sys
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer
from vectorlab.llm import decontaminate, html_text, license_scan, mixing, packing, tokens, toxicity, training_order

from .conftest import odd_texts


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(tokens.tokenizer_path())


def true_ids(model, text):
    return model.encode(text or "", add_special_tokens=False).ids


# --- tokens and packing

def test_ids_are_the_tokenizer_s(model):
    ours = tokens.text_tokenizer(tokens.tokenizer_path())
    for _, text in odd_texts():
        assert np.frombuffer(ours.ids((text or "").encode()), "<u4").tolist() == true_ids(model, text)


def unseen(n=12_000):
    """Words of small letters, some with Latin-1 letters of either case or marks around."""
    rng = np.random.default_rng(5)
    letters = np.array([*"abcdefghijklmnopqrstuvwxyz", *(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])
    words = ["".join(letters[np.where(rng.random(9) < 0.15, rng.integers(26, len(letters), 9), rng.integers(0, 26, 9))]) for _ in range(n)]
    return [w + "." if k % 4 == 0 else w for k, w in enumerate(words)]


def test_words_of_latin_letters(model):
    ours = tokens.TextTokenizer(tokens.tokenizer_path())
    words = unseen(3000) + [chr(c) for c in range(0xA0, 0x100)] + [f"a{chr(c)}b" for c in range(0xA0, 0x100)]
    for word in words:
        assert np.frombuffer(ours.ids(word.encode()), "<u4").tolist() == true_ids(model, word), word


def test_an_unseen_word_takes_few_calls(model):
    words = [w.lower().encode() for w in unseen(300)]
    ours, calls = tokens.TextTokenizer(tokens.tokenizer_path()).words, Counter()
    sys.setprofile(lambda frame, event, what: calls.update([event]))
    try:
        for word in words:
            ours[word]
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < 18 * len(words), calls


class Counted(dict):
    """Ids of words, and how often each was asked for."""

    def __init__(self, words):
        self.words, self.asked = words, Counter()

    def __getitem__(self, word):
        self.asked[word] += 1
        return self.words[word]

    def trim(self):
        self.words.trim()


def test_a_word_of_a_text_is_looked_up_once(model):
    ours = tokens.TextTokenizer(tokens.tokenizer_path())
    ours.words = Counted(ours.words)
    text = "The mél, 12 don't (the... MÉL)\n" * 500
    assert np.frombuffer(ours.ids(text.encode()), "<u4").tolist() == true_ids(model, text)
    assert max(ours.words.asked.values()) <= 2, ours.words.asked  # the capital É is another word than é


def test_ids_of_many_odd_texts(model, monkeypatch):
    rng = np.random.default_rng(8)
    signs = [*"aabbZs'' \t\n\r.,!-_()=<>09", "'s", "'ll", "é", "É", "ß", "×", "÷", "ÿ", "\u0301", "\u0338", "\u00a0", "\u2003", "\u0085", "\x00", "\x1c", "\x7f",
             "中", "」", "½", "²", "٣", "😀", "İ", "\u212a", "Σ", "Ā", "ſ", "\u037e"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(3000)] + ["", " ", "a" * 300, "x <|endoftext|>y", "<|startoftext|>"]
    texts = [texts[k] for k in rng.permutation(len(texts))]
    want = [true_ids(model, t) for t in texts]
    for group, kept in ((tokens.GROUP, tokens.KEPT), (100, 50), (0, 0)):
        monkeypatch.setattr(tokens, "GROUP", group)
        monkeypatch.setattr(tokens, "KEPT", kept)
        ours = tokens.TextTokenizer(tokens.tokenizer_path())
        got = [np.frombuffer(ids, "<u4").tolist() for ids in ours.ids_of(t.encode() for t in texts)]
        assert got == want, [(t, g, w) for t, g, w in zip(texts, got, want) if g != w][:3]
    assert list(ours.ids_of([])) == []


def test_pack(odd, nothing, model):
    rows = packing.pack(odd, length=256).collect()
    want = Counter()
    for i, text in odd_texts():
        ids = [*true_ids(model, text), 1]
        for k in range(0, len(ids), 256):
            part = ids[k:k + 256]
            want[i, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 256
    assert packing.pack(nothing).count() == 0


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.add(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.BestFit(10, 2)
    assert [bins.add(n) for n in (6, 7, 8, 3, 2)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 8)]


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(training_order.permuted(np.arange(n), n)) == list(range(n))
    assert (training_order.permuted(np.arange(1000), 1000) != training_order.permuted(np.arange(1000), 1000, key=1)).any()


def test_training_order_round_trip(spark, odd, nothing, model, tmp_path):
    target = f"file:{tmp_path}/t"
    manifest = training_order.write_shards(odd, target, length=64, per_shard=32)
    rows = training_order.read_shards(spark, target).collect()
    assert sorted(r.slot for r in rows) == list(range(manifest["sequences"])) == sorted(r.sequence for r in rows)
    assert all(r.byte_offset == (r.slot - r.shard * 32) * manifest["stride"] for r in rows)
    end = model.token_to_id("<|endoftext|>")
    stream, docs = [], Counter()
    for r in sorted(rows, key=lambda r: r.sequence):
        stream += np.frombuffer(r.ids, "<u2").tolist()
    # a mark inside a text has the end token's id too, so compare what stands between the marks
    split = lambda ids: Counter(tuple(x) for x in " ".join(map(str, ids)).split(str(end)))
    for _, text in odd_texts():
        docs += split([*true_ids(model, text), end])
        docs[()] -= 1
    assert sum(r.n_tokens for r in rows) == sum(len(true_ids(model, t)) + 1 for _, t in odd_texts())
    assert Counter(stream) == Counter(x for _, t in odd_texts() for x in [*true_ids(model, t), end])
    some = training_order.read_shards(spark, target, 40, 10).collect()
    assert sorted(r.slot for r in some) == list(range(40, 50))
    assert training_order.training_order(nothing, f"file:{tmp_path}/none").count() == 0


# --- toxicity

def test_toxicity(odd, nothing, odd_labels):
    rows = toxicity.toxicity(odd, odd_labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd_texts())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert toxicity.toxicity(nothing, odd_labels).count() == 0
    assert all(r.score < 1e-9 for r in toxicity.toxicity(odd, odd_labels.limit(0)).collect())
    assert toxicity.drop_toxic(odd, odd_labels.limit(0)).columns == odd.columns


def test_toxicity_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([np.mean([(b > g) + 0.5 * (b == g) for g in good]) for b in bad]) > 0.7


def test_ftrl_is_sparse_and_learns():
    learner, rng = toxicity.Ftrl(1000), np.random.default_rng(0)
    for _ in range(2000):
        at = rng.choice(np.arange(2, 1000), 20, replace=False)
        label = int(rng.random() < 0.3)
        learner.learn(np.append(at, [0, 1] if label else [0]), label)
    w = learner.weights(slice(None))
    assert w[1] > 3 > 30 * np.abs(w[2:]).mean() and (w == 0).mean() > 0.2


# --- decontamination

def slow_contamination(text, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for name, t in items:
        item = words(t)
        n = min(window, len(item))
        grams = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add("" if name is None else str(name))
    return len(w), len(hit), sorted(found)


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "c d e f g h i j k l m n o"), (3, "short item"), (4, None), (5, "..."), (None, "no id here"), (7, "É" * 3 + " x"),
         (3, "another text of item three that is longer than ten words so there"), (8, "item item item item item item item item item item item")]
TEXTS = ["x a b c d e f g h i j k y", "A, B. c d E f g h i j k l m n o p", "a b c d e f g h i", "a short item short item", "no id here", "ééé x", "ÉÉÉ x", None, "",
         "item " * 25, "text of item three that is longer than ten words so there", "b c d e f g h i j k l m n o", "a b c d e f g h i j a b c d e f g h i j"]


@pytest.mark.parametrize("block_words", [14, 200_000])
def test_contamination(spark, block_words):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = spark.createDataFrame([(i % 9, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, _matches string, row int").repartition(3)
    rows = decontaminate.contamination(docs, items, block_words=block_words).collect()
    want = Counter()
    for i, t in enumerate(TEXTS):
        n, hit, names = slow_contamination(t, ITEMS)
        want[i % 9, n, hit, len(names), __import__("hashlib").sha256(",".join(names).encode()).hexdigest(), hit > 0] += 1
    assert Counter(map(tuple, rows)) == want
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_remove_matches(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "Keep this. A b c d e f g h i j k, and this.", 5), (2, "clean", 5), (3, None, 5), (4, "a b c d e f g h i j k", 5)],
                                 "doc_id bigint, text string, n_chars int")
    assert {r.doc_id for r in decontaminate.remove_matches(docs, items).collect()} == {2, 3}
    cut = decontaminate.remove_matches(docs, items, coverage=0.9)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Keep this. , and this.", 2: "clean", 3: None}


# --- pages

ARTICLE = "<h1>Title</h1><p>" + "some words of the text, " * 12 + "</p><p>a &lt;b&gt; &amp; c<br>next\n line " + "more words " * 15 + "</p>"
PLAIN = " ".join(("Title " + "some words of the text, " * 12 + " a <b> & c next line " + "more words " * 15).split())


@pytest.mark.parametrize("html", [
    f"<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><a href=x>Menu</a></nav><article>{ARTICLE}</article><footer>end</footer></body></html>",
    f"<body><header>Site</header><div class='sidebar'><p>{'side ' * 200}</p></div><div id=content>{ARTICLE}</div><div class='comments'>{'reply ' * 300}</div>",
    f"<div class=ad>{'buy ' * 99}</div><main>{ARTICLE}</main><form><p>{'field ' * 99}</p></form><!-- <p>no</p>",
    f"<div>{ARTICLE}</div><ul><li><a href=1>one</a><li><a href=2>two</a></ul><div class='cookie-notice'>accept</div>",
    ARTICLE.replace("</p>", ""), ARTICLE.upper().replace("SOME", "some") and f"<ARTICLE>{ARTICLE}",
])
def test_main_text(html):
    assert html_text.main_text(html) == PLAIN


SIDE = f"<div class=sidebar><p>{'side ' * 40}</p></div><div id=comments class='post-comments'><h2>Replies</h2><article class=comment-body>{'reply ' * 400}</article></div>"


@pytest.mark.parametrize("html", [
    *(f"<body><div id=page class='{name}'><nav><a href=x>Menu</a></nav><div class=content>{ARTICLE}</div>{SIDE}</div>"
      for name in ("site no-sidebar", "site with-sidebar", "has-comments", "page_without_search", "search-result", "sidebar-layout")),
    *(f"<body><div class='{name}'><nav><a href=x>Menu</a></nav><{tag}>{ARTICLE}</{tag}></div><footer>end</footer>"
      for name in ("sidebar", "widget", "site sidebar") for tag in ("article", "main")),
    f"<body><div class=sidebar>{ARTICLE}</div><footer>end</footer>",
    f"<body><form action=x><nav><a href=x>Menu</a></nav><div>{ARTICLE}</div>{SIDE}<button>ok</button></form></body>",
    f"<body><form action=x><article>{ARTICLE}</article></form></body>",
    f"<body><aside><main>{ARTICLE}</main></aside></body>",
    f"<body><article>{ARTICLE}</article>{SIDE}</body>", f"<body><div>{ARTICLE}</div>{SIDE}</body>", f"<body><main>{ARTICLE}{SIDE}</main></body>",
    f"<body><div>{ARTICLE}</div><div class=cookie-consent>{'we set cookies ' * 90}</div><div hidden><p>{'unseen ' * 200}</p></div></body>",
    f"<body><div>{ARTICLE}</div><select>{'<option>country' * 300}</select><nav>{'<a href=x>linked words</a>' * 90}</nav></body>",
    f"<body><form action=x><aside>{ARTICLE}</aside><footer>end</footer></form></body>",
])
def test_wrappers_keep_the_text(html):
    assert html_text.main_text(html) == PLAIN


def test_labels_alone_leave_no_page_empty():
    assert html_text.main_text("".join(f"<div class=widget><p>{part * 20}</p></div>" for part in ("one ", "two ", "six "))).split() == ["one"] * 20 + ["two"] * 20 + ["six"] * 20


def test_pages_with_odd_cases(spark):
    pages = [(1, "u", None), (2, "u", ""), (2, None, "no tags at all"), (None, "u", "<p>x" * 3000), (5, "u", "<" * 5000), (6, "u", "<div>" * 3000 + "deep"),
             (7, "u", "<script>never closed"), (8, "u", '<p title="a>b">x</p>'), (9, "u", "<p title='open>" + "y" * 10)]
    df = spark.createDataFrame([(*p, "c", 0) for p in pages], "page_id int, url string, html string, text string, n_chars int")
    rows = html_text.extract(df).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    texts = {(r.page_id, r.url): r.text for r in rows}
    assert texts[1, "u"] == texts[2, "u"] == texts[7, "u"] == "" and texts[2, None] == "no tags at all"
    assert texts[None, "u"] == " ".join("x" * 3000) and texts[6, "u"] == "deep" and texts[8, "u"] == "x"
    assert html_text.extract(df.limit(0)).count() == 0


def test_inline_elements_leave_words_whole():
    for inner in ("<img src=x>", "<script>a()</script>", "<input value=v>", "<svg><path/></svg>", "<button>b</button>", "<select><option>o</option></select>", "<b></b>", "<wbr>"):
        assert html_text.main_text(f"<p>un{inner}broken text</p>") == "unbroken text"
    assert html_text.main_text("<p>a<br>b<p>c<div>d</div>e") == "a b c d e"


@pytest.mark.parametrize("html", [
    "<span>" * 60_000 + "</i>" * 60_000, "<i><div>" + "<span>" * 60_000 + "</i>" * 60_000, "<div>" * 60_000 + "<p>x" * 60_000, "<table>" + "<b>" * 60_000 + "<td>y" * 60_000,
    "<header>" * 60_000 + "z", "<div>" * 60_000 + "<li>x" * 60_000, "<h1>" + "<div>" * 60_000 + "<h2>t" * 60_000])
def test_a_page_costs_as_much_as_it_is_long(html):
    begin = time.process_time()
    html_text.Page(html)
    assert time.process_time() - begin < 8  # some million tags a minute; a walk over the open elements for each takes many minutes


# --- licences

def test_licences(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software")
    cases = {1: ("Released under the MIT License.\nText.", "mitRef", "MIT", 0), 2: ("Licensed under the Apache License, Version 2.0.", "apache2Ref", "Apache-2.0", 0),
             3: ("x. Licensed under CC BY-NC 4.0. LICENSED UNDER CC BY-NC 4.0!", "ccByNcRef,ccByNcRef", "CC-BY-NC-4.0", 0), 4: (None, "", "", 0), 5: ("", "", "", 0),
             6: ("This license is my own.", "UNKNOWN", "", 1), 7: (mit, "UNKNOWN", "", 1),
             8: ("This work is licensed under the GNU General Public License, version 3. either version 3 of the License, or (at your option) any later version.",
                 "gpl3Ref,gplLater", "GPL-3.0-or-later", 0), 9: ("nothing " * 5000, "", "", 0)}
    docs = spark.createDataFrame([(i, c[0], "x") for i, c in cases.items()] * 2, "doc_id int, text string, ids string")
    rows = license_scan.licences(docs).collect()
    assert Counter(map(tuple, rows)) == Counter({(i, *c[1:]): 2 for i, c in cases.items()})
    assert license_scan.licences(docs.limit(0)).count() == 0
    plan = license_scan.licences(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Copyright (c) 2020, Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE.
"""


def test_whole_wrapped_licences(spark):
    marked = lambda text, mark: "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines())
    cases = [(text, name) for name, text in (("MIT", MIT), ("BSD-2-Clause", BSD2), ("BSD-3-Clause", BSD3), ("ISC", ISC))]
    cases += [(f"/*\n{marked(text, ' *')} */\nint x;", name) for text, name in cases[:4]] + [(marked(text, m), name) for text, name in cases[:4] for m in ("#", "//")]
    cases += [(text.replace("\n", "\r\n"), name) for text, name in cases[:4]] + [(" ".join(text.split()), name) for text, name in cases[1:3]]
    cases += [(BSD3.replace("the copyright holder", "Acme, Inc"), "BSD-3-Clause"), (BSD3.replace("\n\n", "\n").replace("3. ", "(c) "), "BSD-3-Clause"),
              ("MIT License\n" + MIT[MIT.index("Permission"):], "MIT"), ("License: MIT\nint x\nlicensed under the MIT license\nint y", "MIT"),
              (MIT + "\n\n" + BSD3, "MIT,BSD-3-Clause"), (MIT[:300], "")]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id int, text string")
    assert {r.doc_id: r.licences for r in license_scan.licences(docs).collect()} == {i: name for i, (_, name) in enumerate(cases)}


def test_known_sentences_hold_a_licence_word():
    for sentence, name in license_scan.known().items():
        assert re.search(license_scan.WORD, sentence), sentence
        assert sentence == re.sub("[^a-z0-9]+", " ", sentence).strip()
    assert {i for _, run in license_scan.RULES for i in run} <= set(license_scan.SENTENCES)


# --- scores

def test_scores(odd, nothing):
    rows = mixing.score(odd).collect()
    counts, texts = Counter(), []
    for i, t in odd_texts():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        texts.append((i, held, w))
        if not held:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, held, len(w), sum(counts[x] > 0 for x in w), n, round(sum(np.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for i, held, w in texts)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(np.isfinite(r.score) and r.score < 0 and r.bits_per_byte > 0 for r in rows)
    assert mixing.score(nothing).count() == 0


def test_every_training_text_fills_the_contexts(spark):
    words = {"bravo": (40, 0), "delta": (0, 40), "kilo": (30, 10)}
    pairs = spark.createDataFrame([(w.encode(), 0, *n) for w, n in words.items()], "word binary, accent int, main bigint, tune bigint").repartition(2, "word")
    before, after = mixing.tables(pairs, mixing.SEEN)
    for word, (main, _) in words.items():
        data = mixing.Bytes([word.encode()], np.zeros(1, np.int64))
        slot = data.slots(5, slice(3, 4), np.array([1], np.uint64))[0]
        assert (before[5][slot] != 0) == (main > 0) and after[5][slot] != 0
    model = mixing.fit(pairs, 120)
    assert all((made == want).all() for made, want in zip(model.tables, after))


def test_the_minimum_is_that_of_all_tasks_together(spark):
    words = [b"a" + bytes([x]) + b"ing" for x in range(98, 120)]
    pairs = spark.createDataFrame([(w, 0, 1, 0) for w in words], "word binary, accent int, main bigint, tune bigint")
    apart, together = (mixing.tables(pairs.repartition(n, "word"), 20)[1] for n in (11, 1))
    assert all((a == b).all() for a, b in zip(apart, together)) and sum(map(np.count_nonzero, apart)) > 0


def test_what_was_seen_enough_has_a_say_at_every_size(spark):
    for more in (10, 50_000_000):
        pairs = spark.createDataFrame([(b"bravo", 0, mixing.SEEN, 0), (b"kilo", 0, more, 5)], "word binary, accent int, main bigint, tune bigint")
        model = mixing.fit(pairs, mixing.SEEN + more + 5)
        slot = mixing.Bytes([b"bravo"], np.zeros(1, np.int64)).slots(5, slice(3, 4), np.array([1], np.uint64))[0]
        assert model.tables[5][slot] != 0
    empty = mixing.fit(pairs.limit(0), 0)
    assert not any(t.any() for t in empty.tables) and np.isfinite(empty.bits([b"bravo"], np.zeros(1, np.int64))).all()


def test_mixed_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    model = mixing.Model([rng.integers(-127, 128, 1 << bits).astype(np.int8) for bits in mixing.SLOTS],
                         rng.normal(0.2, 0.1, (8, mixing.PLACES * mixing.ORDERS, mixing.INPUTS)))
    data = mixing.Bytes([b"ab\xc3\xa9cd"] * 256, np.full(256, 3))
    data.byte = np.where(data.place == 4, data.word, data.byte).astype(np.uint8)  # all bytes in one place after the same prefix
    cost = np.zeros(len(data.byte))
    for bit in range(8):
        node, one = mixing.decisions(data.byte, bit)
        inputs = model.inputs(data, slice(None), node)
        p = model.probability(model.mixed(inputs, bit, mixing.gates(data, slice(None), inputs)), node)
        cost -= np.log2(np.where(one == 1, p, 1 - p))
    assert np.exp2(-cost[data.place == 4]).sum() == pytest.approx(1)
    words = [b"abc", b"abcd", mixing.END, b"\xc3\xa9"]
    apart = np.concatenate([model.bits([w], np.array([2])) for w in words])
    assert model.bits(words, np.full(4, 2)) == pytest.approx(apart)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    arrays = [np.array([], np.int64), np.array([0, 1, 255]), np.array([256, 70_000]), np.array([1 << 40, 3]), rng.normal(size=50).astype(np.float32), np.arange(5) > 2]
    back = mixing.unpacked(mixing.packed(*arrays))
    assert len(back) == len(arrays) and all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, back))


def slow_bits(model, word: bytes, accent: int) -> float:
    """Bits of a word by plain loops over its decisions."""
    mask, bits = (1 << 64) - 1, 0.0
    coded = word if word == mixing.END else word + b" "
    for place, byte in enumerate(coded):
        last = [coded[place - k] + 1 if place >= k else 0 for k in range(1, 6)]
        five = sum(x << 9 * k for k, x in enumerate(last))
        prefix = sum((x + 1) * pow(mixing.POWER, k, 1 << 64) for k, x in enumerate(coded[:place])) & mask
        language = accent << 48
        three = five & (1 << 27) - 1
        contexts = [last[0], five & (1 << 18) - 1, three, three ^ language, five, prefix, prefix ^ language * int(mixing.MULTIPLY) & mask]
        for bit in range(8):
            node, one = (256 | byte) >> 8 - bit, byte >> 7 - bit & 1
            x = []
            for k, c in enumerate(contexts):
                h = ((c + k + 1) * int(mixing.MULTIPLY) + node * int(mixing.NODE)) * int(mixing.MULTIPLY) & mask
                x.append(float(np.float32(model.tables[k][h >> 64 - mixing.SLOTS[k]] / mixing.SCALE)))
            known = [k for k in range(1, mixing.ORDERS) if x[len(x) - mixing.ORDERS + k] != 0]
            w = model.weights[bit, min(place, mixing.PLACES - 1) * mixing.ORDERS + max(known, default=0)]
            mixed = min(max(w[-1] - mixing.FIRST_WEIGHT + sum(a * b for a, b in zip(w, x)), -7.999), 7.999)
            at = (mixed + 8) * (mixing.CELLS - 1) / 16
            low, part = int(at), at - int(at)
            p = (1 / (1 + np.exp(-mixed)) + model.refined[node][low] * (1 - part) + model.refined[node][low + 1] * part) / 2
            p = min(max(p, mixing.LEAST), 1 - mixing.LEAST)
            bits -= np.log2(p if one else 1 - p)
    return bits


def test_scores_are_those_of_plain_loops(spark, monkeypatch):
    rng = np.random.default_rng(3)
    model = mixing.Model([rng.integers(-127, 128, 1 << bits).astype(np.int8) * (rng.random(1 << bits) < 0.5) for bits in mixing.SLOTS],
                         rng.normal(0.2, 0.1, (8, mixing.PLACES * mixing.ORDERS, mixing.INPUTS)), rng.uniform(0.01, 0.99, (256, mixing.CELLS)))
    monkeypatch.setattr(mixing, "fit", lambda pairs, total: model)
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 2000)
    texts = [(i, t) for i, t in odd_texts() if t is None or len(t) < 1500]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    want = []
    for i, t in texts:
        words, total, accent, prices = (t or "").encode().lower().split() + [mixing.END], 0.0, 0, {}
        for w in words:
            if (w, accent) not in prices:
                prices[w, accent] = slow_bits(model, w, accent)
            total += prices[w, accent]
            accent = mixing.accent_class(w) or accent
        want.append((-1 if i is None else i, round(-total * np.log10(2), 2)))
    got = [(-1 if r.doc_id is None else r.doc_id, round(r.score, 2)) for r in mixing.score(docs).collect()]
    for a, b in zip(sorted(want), sorted(got), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-5, abs=0.02)


def slow_slot(x, n, key=training_order.KEY):
    """The permutation in whole Python numbers."""
    half, wide = max(1, ((n - 1).bit_length() + 1) // 2), (1 << 64) - 1

    def mixed(x, key):
        x = (x + key) * 0x9E3779B97F4A7C15 & wide
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & wide
        return x ^ x >> 31

    while True:
        left, right = x >> half, x & (1 << half) - 1
        for turn in range(training_order.ROUNDS):
            left, right = right, (left ^ mixed(right, key * training_order.ROUNDS + turn)) & (1 << half) - 1
        x = left << half | right
        if x < n:
            return x


def test_sequences_follow_the_texts_and_slots_the_permutation(spark, odd, model, tmp_path):
    odd.coalesce(1).write.parquet(f"file:{tmp_path}/docs")
    docs = spark.read.parquet(f"file:{tmp_path}/docs")
    end = model.token_to_id("<|endoftext|>")
    want = [x for r in docs.collect() for x in [*true_ids(model, r.text), end]]
    n = training_order.write_shards(docs, f"file:{tmp_path}/t", length=64, per_shard=32)["sequences"]
    rows = sorted(training_order.read_shards(spark, f"file:{tmp_path}/t").collect(), key=lambda r: r.sequence)
    assert [x for r in rows for x in np.frombuffer(r.ids, "<u2").tolist()] == want
    assert all(r.n_tokens == 64 for r in rows[:-1])
    assert [r.slot for r in rows] == [slow_slot(k, n) for k in range(n)]
