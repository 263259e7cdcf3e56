from __future__ import annotations

import random
import zlib

import numpy as np

from tidemark.llm import queries, toxicity

BAD = ["wretched", "scoundrel", "vermin"]


def _corpus(prose, n=700):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        found, toxic = prose(900 + i, rng.randint(15, 60), 400), int(i % 3 == 0)
        for _ in range(3 * toxic):
            found[rng.randrange(len(found))] = rng.choice(BAD)
        rows.append((i, " ".join(found)))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_accuracy_and_misspellings(spark, docs_of, stored_tables, prose):
    rows, labels = _corpus(prose)
    odd = [(1000, None), (1001, ""), (1002, "the wretchedd scoundrels and vermins of wretchedd scoundrels"), (1003, " ".join(prose(5000, 30, 400))), (1003, " ".join(prose(5000, 30, 400)))]
    marked = spark.createDataFrame(labels + [(1, None), (9999, 1)], "doc_id bigint, toxic int")
    got = queries.op8_toxicity(spark, stored_tables(documents=docs_of(rows + odd), labels=marked)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = dict(labels)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert len(held) > 40 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.85
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1002]["predicted"] == 1 and by_id[1003]["score"] < by_id[1002]["score"]
    assert by_id[1000]["score"] == by_id[1001]["score"] and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_gradient_descends(prose):
    rows, labels = _corpus(prose, 60)
    bags, y = [toxicity.bag(t) for _, t in rows], np.array([x for _, x in labels])
    model = toxicity.train(bags, y)
    z = np.array([model.bias + float(model.value[i] @ w) for i, w in bags])
    assert ((z > 0) == (y == 1)).mean() > 0.95
    again = toxicity.train(bags, y)
    assert np.array_equal(model.value, again.value)


def test_one_label_or_none(spark, docs_of, stored_tables):
    docs = docs_of([(i, f"text {i}") for i in range(6)])
    for labels, expected in (([], 0), ([(i, 0) for i in range(6)], 0), ([(i, 1) for i in range(6)], 1)):
        marked = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        assert {r["predicted"] for r in queries.op8_toxicity(spark, stored_tables(documents=docs, labels=marked)).collect()} == {expected}
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert queries.op8_toxicity(spark, stored_tables(documents=docs.limit(0), labels=none)).count() == 0
