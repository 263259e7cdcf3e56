from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import differences, duck, duck_rows, spark_rows
from tidemark.llm import queries, runs


def brute_force(x, exponent=4, least=6):
    """Every period, every stretch; a stretch inside one with a smaller period is not a run."""
    found = []
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i + q < len(x):
            start = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, exponent * q):
                if not any(s <= start and s + n >= start + length for s, n, _ in found):
                    found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(rng, size):
    x = []
    while len(x) < size:
        if rng.random() < 0.3:
            x += [rng.randrange(3) for _ in range(rng.randrange(1, 10))]
        else:
            part = [rng.randrange(rng.choice([1, 2, 9])) for _ in range(rng.randrange(1, 14))]
            x += (part * 9)[: rng.randrange(1, len(part) * 8 + 1)]
    return x


def test_runs_equal_brute_force():
    rng, total = random.Random(5), 0
    for _ in range(400):
        docs = [repetitive(rng, rng.randrange(0, 140)) for _ in range(rng.randrange(1, 5))]
        expected = [brute_force(x) for x in docs]
        assert runs.find_runs(docs) == expected
        total += sum(map(len, expected))
    assert total > 1000


def test_copies_of_a_text_are_no_runs_across_texts():
    docs = [list("abcd")] * 40 + [list(range(64))] + [list("abcdefgijklm")] * 30 + [[], list("xx")] * 12 + [list("pppppp")]
    assert runs.find_runs(docs) == [brute_force(x) for x in docs]
    assert sum(map(len, runs.find_runs(docs))) == 1


@pytest.mark.parametrize("exponent, least", [(3, 3), (3, 20), (5, 6)])
def test_other_bounds(exponent, least):
    rng = random.Random(exponent * 100 + least)
    for _ in range(100):
        x = repetitive(rng, 120)
        assert runs.find_runs([x], exponent, least) == [brute_force(x, exponent, least)]


def test_transform_gives_exact_sums_of_squares():
    rng = np.random.default_rng(3)
    for width in (1, 2, 8, 64):
        blocks = rng.integers(0, 1 << 20, (3, width))
        windows = rng.integers(0, 1 << 20, (3, 2 * width))
        for p, generator in runs.PRIMES:
            got = runs.squared_differences(blocks, windows, p, generator)
            for t in range(width):
                exact = [sum(int(a - b) ** 2 for a, b in zip(blocks[r], windows[r, t : t + width])) for r in range(3)]
                assert got[:, t].tolist() == [e % p for e in exact]


def test_long_periods_and_long_texts():
    rng = random.Random(8)
    part = [rng.randrange(100_000) for _ in range(7000)]
    assert runs.find_runs([[-1] + part * 4 + [-2]]) == [[(1, 28000, 7000)]]
    assert runs.find_runs([[7] * 300_000]) == [[(0, 300_000, 1)]]
    assert runs.find_runs([(part * 4)[:-1]]) == [[]]


def test_kept_words_drop_all_but_the_first_period():
    words = "x a b a b a b a b y z z z z z z".split()
    found = runs.find_runs([words])[0]
    assert found == [(1, 8, 2), (10, 6, 1)]
    assert runs.kept_words(words, found) == "x a b y z".split()


def test_exponents_below_three_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs([[1]], min_exponent=2)


def test_odd_documents(spark, odd_docs):
    got = runs.with_runs(odd_docs.withColumn("runs", F.lit("own")).withColumn("n_words", F.lit(1)))
    rows = got.collect()
    assert len(rows) == odd_docs.count() and got.columns[-1] == "periodic" and {r["runs"] for r in rows} == {"own"}
    by_id = {r["doc_id"]: r["periodic"] for r in rows if r["doc_id"] is not None}
    assert by_id[1] == by_id[2] == by_id[3] and by_id[1]["n_words"] == 0 and by_id[1]["collapsed"] == ""
    assert [tuple(r) for r in by_id[10]["runs"]] == [(0, 20000, 1)] and by_id[10]["collapsed"] == "1"
    assert by_id[7] == by_id[8] and [tuple(r) for r in by_id[7]["runs"]] == [(0, 40000, 5)]
    assert by_id[5]["collapsed"] == "one"
    assert runs.with_runs(odd_docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.with_runs(odd_docs, name="Text")


def test_query_matches_sql(spark, sf):
    expected = duck_rows(duck(sf), queries.SQL["op13_periodic_runs"])
    assert differences(spark_rows(queries.op13_periodic_runs(spark, sf)), expected) == []


def test_query_on_odd_tables_matches_sql(spark, docs_of, odd_docs, stored_tables):
    texts = [(100 + i, " ".join(map(str, repetitive(random.Random(i), 90)))) for i in range(200)]
    folder = stored_tables(documents=odd_docs.where("doc_id is not null").union(docs_of(texts)).coalesce(1))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    expected = duck_rows(con, queries.SQL["op13_periodic_runs"])
    assert differences(spark_rows(queries.op13_periodic_runs(spark, folder)), expected) == []


def test_equal_documents_side_by_side_are_not_one_stretch():
    words = [f"w{i}" for i in range(24)]
    longest = [f"x{i}" for i in range(400)]  # periods are sought up to a part of the longest document
    assert runs.find_runs([longest] + [words] * 12) == [[]] * 13
    assert runs.find_runs([longest] + [["a"]] * 12) == [[]] * 13
    inner = [*words, *["x", "y"] * 4]
    assert runs.find_runs([inner] * 12) == [brute_force(inner)] * 12 == [[(24, 8, 2)]] * 12
