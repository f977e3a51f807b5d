"""Rows that every operator has to stand: NULLs, empty and long texts, ties, repeats, clashing columns."""

import random

import pytest

EXTRA = "word string, fp long, score double, key string, n long, _found string, _later long, pages long"


def words(seed, n, letters="abcdefghijklmnop"):
    r = random.Random(seed)
    return " ".join("".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang); ids are unique but for one repeated row and the NULLs."""
    return [
        (1, "The cat and the dog of the house. " * 30, "en"),
        (2, None, "en"),
        (3, "", "de"),
        (4, " \t\n\x0b\x0c\r ", None),
        (5, "12345 !!! ### 67", "de"),
        (6, words(1, 120), "en"),
        (6, words(1, 120), "en"),
        (7, words(1, 120), "fr"),
        (8, words(2, 30_000), "fr"),
        (9, "Ünïcödé “quotes” 日本 é " * 20, "de"),
        (10, "one", "en"),
        (11, "one two three", None),
        (12, "line\n" * 200, "en"),
        (None, words(3, 60), "en"),
        (None, None, None),
        (14, "<|endoftext|> ▁ \x1c\x85\xa0 tail", "en"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from tidemark.llm.tables import ship_code

    ship_code(spark)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    rows = [(i, t, lang, None, None, "w", 1, 0.5, "k", 2, "f", 3, 4) for i, t, lang in odd_rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def small_docs(spark):
    from tidemark.llm.tables import ship_code

    ship_code(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
