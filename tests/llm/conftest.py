from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text[, lang]) pairs as a table with the columns of documents."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def stored_tables(spark, tmp_path_factory):
    """Writes tables (name -> DataFrame) as Parquet and returns their folder."""

    def make(**tables):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return folder

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic words: prose(seed, n)."""

    def make(seed, n, vocabulary=3000):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary):x}" for _ in range(n)]

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    long = "lorem ipsum dolor sit amet " * 8000
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (6, "x" * 30000), (7, long), (8, long),
        (None, "no id here"), (None, None), (9, "Ünïcode ☃ 日本語 ́ <|endoftext|> '12.3.4.5'"), (10, "1 " * 20000),
    ]
    return docs_of(rows)
