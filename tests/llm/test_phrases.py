from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from tests.compare import differences, duck, duck_rows, spark_rows
from tidemark.llm import phrases, queries

UPPER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER))]


def counted(rows, depth):
    """(name, phrase) -> count, and words by name."""
    found, total = Counter(), Counter()
    for name, text in rows:
        for words in pieces(text):
            total[name or "und"] += len(words)
            for size in range(1, depth + 1):
                found.update((name or "und", " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    return found, total


def brute_force(rows, depth, least, top):
    f, total = counted(rows, depth)
    best = {}
    for (name, phrase), a in f.items():
        words = phrase.split(" ")
        if len(words) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[name, " ".join(words[:k])], f[name, " ".join(words[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        best[name, phrase] = (a, *min(cuts))
    kept = {}
    for (name, phrase), row in best.items():
        inside = [
            b[0]
            for (other, longer), b in best.items()
            if other == name and longer != phrase and f" {phrase} " in f" {longer} " and 100 * b[0] >= 80 * row[0]
        ]
        if not inside:
            kept[name, phrase] = row
    out = []
    for name in total:
        ranked = sorted((-r[1], -r[0], p.encode(), r) for (n, p), r in kept.items() if n == name)[:top]
        out += [(name, i, p.decode(), r[0], r[3], r[4], total[name], r[1]) for i, (_, _, p, r) in enumerate(ranked, 1)]
    return sorted(out)


def corpus(seed, texts, vocabulary=12):
    rng = random.Random(seed)
    words = [rng.choice(["ab", "É", "of", "the", "日本", "x\0y", "Q1"]) + str(i) for i in range(vocabulary)]
    rows = []
    for _ in range(texts):
        chosen = [rng.choice(words[: rng.randrange(1, vocabulary)]) for _ in range(rng.randrange(0, 60))]
        rows.append((rng.choice(["en", "fr", None, "und"]), "".join(w + rng.choice([" ", " ", "\t", ", ", "\n", ".", "  "]) for w in chosen)))
    return rows + [("en", "one two three four. " * 30), ("en", None), ("fr", ""), (None, " .,\n ")]


def test_counts_equal_brute_force_for_any_budget(spark):
    rows = corpus(1, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    f, total = counted(rows, 4)
    expected = {k: n for k, n in f.items() if n >= 5}
    for budget in (1, 40, 400, phrases.BUDGET):  # from everything spread to one group
        found, totals = phrases.frequent_phrases(docs, least=5, budget=budget)
        got = found.collect()
        assert len(got) == len(expected) and {(r["name"], r["phrase"]): r["f"] for r in got} == expected
        assert {r["name"]: r["n"] for r in totals.collect() if r["n"]} == {k: n for k, n in total.items() if n}


@pytest.mark.parametrize("depth, least, top, budget", [(4, 5, 2000, 300), (3, 8, 7, 50), (2, 3, 2000, phrases.BUDGET)])
def test_collocations_equal_brute_force(spark, depth, least, top, budget):
    rows = corpus(depth, 200)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = phrases.collocations(docs, depth, least, top, budget)
    assert sorted(tuple(r) for r in got.collect()) == [r for r in brute_force(rows, depth, least, top) if r[6]]


def test_long_texts_are_read_in_overlapping_stretches(monkeypatch):
    rng = random.Random(4)
    text = "".join(f"w{rng.randrange(9)}" + rng.choice([" ", "  ", ". ", "\t", ", "]) for _ in range(900))
    monkeypatch.setattr(phrases, "SLAB", 64)
    batch = pa.record_batch([pa.array(["en", "en"]), pa.array([text, "short text"])], ["name", "text"])
    found, slabs = Counter(), 0
    for name, tokens, own in phrases._slabs(iter([batch]), 4):
        ids, known = phrases._numbered(tokens)
        for row in zip(*phrases._suffixes(ids, own, 4)):
            found.update([(name, " ".join(known[i].decode() for i in row[:k])) for k in range(1, 5) if row[k - 1]])
        slabs += 1
    assert slabs > 20 and found == counted([("en", text), ("en", "short text")], 4)[0]


def test_one_word_longer_than_a_stretch(monkeypatch):
    monkeypatch.setattr(phrases, "SLAB", 64)
    batch = pa.record_batch([pa.array(["en"]), pa.array(["a b " + "x" * 500 + " c d"])], ["name", "text"])
    tokens = [t for _, found, own in phrases._slabs(iter([batch]), 4) for t in found[:own]]
    assert tokens == [b"a", b"b", b"x" * 500, b"c", b"d"]


def test_odd_documents(spark, odd_docs):
    from pyspark.sql import functions as F

    clashing = odd_docs.withColumn("name", F.lit("x")).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("y"))
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    got = phrases.collocations(clashing, least=2)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, 4, 2, 2000)
    assert phrases.collocations(odd_docs.limit(0)).count() == 0


def test_query_matches_sql(spark, sf):
    expected = duck_rows(duck(sf), queries.SQL["op12_collocations"])
    assert differences(spark_rows(queries.op12_collocations(spark, sf)), expected) == []


def test_query_on_odd_tables_matches_sql(spark, stored_tables):
    rows = [(i, text, lang) for i, (lang, text) in enumerate(corpus(9, 900))]
    folder = stored_tables(documents=spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(2))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = spark_rows(queries.op12_collocations(spark, folder))
    assert len(got[1]) > 50 and differences(got, duck_rows(con, queries.SQL["op12_collocations"])) == []
