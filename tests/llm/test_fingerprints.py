from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import fingerprints, queries


def _units(text):
    return {line[a : a + 128] for line in (text or "").split("\n") for a in range(0, len(line), 128)}


def _likeness(a, b):
    a, b = _units(a), _units(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_equals_brute_force(spark, docs_of, stored_tables, prose):
    rng = random.Random(5)
    rows = [(i, "\n".join(" ".join(prose(i * 50 + k, rng.randrange(1, 60))) for k in range(rng.randrange(0, 40)))) for i in range(60)]
    rows += [(100, rows[7][1]), (101, None), (102, ""), (103, rows[7][1][:-40])]
    sf = stored_tables(documents=docs_of(rows))
    got = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, sf).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        taken = len(text) // 3
        edited = text[: len(text) - taken] + following[:taken]
        r = got[i]
        assert r["n_chars"] == len(text) and r["recovered"]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - _likeness(text, edited)) < 1e-12
        assert abs(r["near_next"] - _likeness(text, following)) < 1e-12
    assert got[7]["fingerprint"] == got[100]["fingerprint"] and got[101]["fingerprint"] == got[102]["fingerprint"]


def test_difference_recovers_the_digests(spark):
    a, b = list(range(100)), list(range(30, 140))
    df = spark.createDataFrame([(a, b), (a, a), ([], b), ([], [])], "a array<bigint>, b array<bigint>")
    df = df.select("a", "b", fingerprints.sketch(F.col("a")).alias("sa"), fingerprints.sketch(F.col("b")).alias("sb"))
    rows = df.select(fingerprints.difference(*map(F.col, ("a", "b", "sa", "sb"))).alias("d")).collect()
    found = [(sorted(r["d"]["only_a"]), sorted(r["d"]["only_b"]), r["d"]["whole"]) for r in rows]
    assert found == [(list(range(30)), list(range(100, 140)), True), ([], [], True), ([], b, True), ([], [], True)]


def test_sketches_are_linear(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [3, 4, 5])], "a array<bigint>, b array<bigint>")
    a, b = F.col("a"), F.col("b")
    both = df.select(fingerprints.subtract(fingerprints.sketch(a), fingerprints.sketch(b)), fingerprints.sketch(a, minus=b)).first()
    assert both[0] == both[1]


def test_order_of_documents(spark, odd_docs, docs_of):
    found = fingerprints.with_next(odd_docs.limit(1000)).collect()
    assert len(found) == odd_docs.count()
    assert fingerprints.with_next(docs_of([(4, "a")])).collect()[0]["next_text"] == "a"
    assert fingerprints.with_next(docs_of([])).count() == 0
    ids = [3, 10**15, 7, -5, 8, 10**15 - 1]
    rows = fingerprints.with_next(docs_of([(i, str(i)) for i in ids])).collect()
    down = sorted(ids, reverse=True)
    assert {r["text"]: r["next_text"] for r in rows} == {str(a): str(b) for a, b in zip(down, down[1:] + down[:1])}
    assert fingerprints.with_next(docs_of([(None, "b"), (None, "a")])).count() == 2


def test_odd_documents(spark, odd_docs, stored_tables):
    assert queries.op1_fingerprints(spark, stored_tables(documents=odd_docs)).count() == odd_docs.count()


def test_the_next_text_comes_with_its_sketch(docs_of):
    """A text is digested and sketched once; the document before it gets the result, not only the text."""
    found = fingerprints.with_next(docs_of([(i, f"{i}\n" * i + "x" * 300) for i in range(1, 40)] + [(50, None)]))
    again = [fingerprints.digests(F.col("next_text")), fingerprints.digests(F.col("text"))]
    sets = found.select("own", "own_cells", "next", "next_cells", *[c.alias(a) for c, a in zip(again, ("n", "o"))])
    rows = sets.select("*", fingerprints.sketch(F.col("n")).alias("nc"), fingerprints.sketch(F.col("o")).alias("oc")).collect()
    assert len(rows) == 40
    assert all((r["next"], r["next_cells"], r["own"], r["own_cells"]) == (r["n"], r["nc"], r["o"], r["oc"]) for r in rows)
