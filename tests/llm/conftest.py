"""Rows that every operator must live through."""

import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "score double, fp string, version int, part string, size string, starts string, "
          "item_id int, lang_pred string, row string, copy string, prob int")


def rows(texts, ids=None, langs=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    langs = [None] * len(texts) if langs is None else langs
    sources = [None] * len(texts) if sources is None else sources
    return [(i, t, lang, s, None, 0.5, "x", 1, "p", "big", "s", 3, "zz", "r", "c", 9)
            for i, t, lang, s in zip(ids, texts, langs, sources)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    word = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(80)]
    long = " ".join(rng.choice(word) for _ in range(60_000))
    some = [" ".join(rng.choice(word) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    texts = [None, "", " ", "\n\n \t", "...", "a", "日本語 テキスト", "x" * 300, long,
             long[:200_000], *some, some[0], some[0] + " end", "a\nb\nc\n\nd", "a\nb\nc\n\nd\n"]
    ids = [*range(len(texts) - 4), 3, 3, None, None]
    langs = [None, "en", "de", *["en", "fr"] * len(texts)][:len(texts)]
    sources = [None, "s1", *["s1", "s0", "é"] * len(texts)][:len(texts)]
    made = rows(texts, ids, langs, sources)
    return made + made[10:13] + made[:1] * 2


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def table(spark):
    def make(texts, **more):
        return spark.createDataFrame(rows(texts, **more), SCHEMA)
    return make
