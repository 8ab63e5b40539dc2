"""Small tables with every odd case: nulls, empty and long texts, copies, ties, repeated rows, clashing column names."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, fp string, data string, _row int, key string"


def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, passage = prose(120), prose(60)
    texts = [None, "", "   \n\t", "one", "two words", "IDIOT!!  Idiot", base, base, base.replace(" ", "\n ", 3), base.replace(" ", "  "), base.upper(),
             base + " " + word(), prose(40) + " " + passage, passage + "\n" + prose(30), passage, "a" * 1000, "ab" * 700, prose(9000), "x" * 30_000, "é" * 500,
             "<|endoftext|> is a mark, and <|startoftext|>", "tab\there\x0bvt\x0cff nbsp", "Σίσυφος ΌΔΟΣ 'tis don't we'll 1234 x²½", "\u0000nul\u0001",
             *(prose(rng.randint(1, 80)) for _ in range(60))]
    rows = list(enumerate(texts, 10))
    return rows + [rows[6], rows[6], (None, base), (None, "free"), (None, None), (3, passage), (10_000_000_000, "big id")]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t), "r", "f", "d", 1, "k") for i, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(15, 1, 0), (15, 1, 1), (16, 1, 0), (None, 1, 1), (17, 1, None), *((i, 1, i % 5 == 0 and 1 or 0) for i in range(34, 90))],
                                 "doc_id bigint, quality int, toxic int")
