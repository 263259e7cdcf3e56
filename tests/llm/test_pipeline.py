from __future__ import annotations

import inspect
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_contamination import tables  # noqa: F401
from tests.llm.test_jaccard import _brute
from tests.llm.test_pii import _base
from tidemark.llm import languages, pii
from tidemark.llm.common import written


@pytest.fixture(scope="module")
def steps(spark, sf):
    """Rows before the first and after every stage, each stage reading what its predecessor stored."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), name)
        out.append(docs.collect())
    return out


def test_stages_are_named_and_take_three_arguments():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "contamination", "personal_data", "packing"]
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)


def test_language_stage(steps):
    expected = [r for r in steps[0] if r["text"] and any(c.isalpha() for c in r["text"])]
    assert sorted(steps[1]) == sorted(expected)


def test_near_duplicate_stage(steps):
    classes = _brute([(r["doc_id"], r["text"]) for r in steps[1]], 5, 80)
    assert sorted(steps[2]) == sorted(r for r in steps[1] if classes[r["doc_id"]][1] == r["doc_id"])
    assert len(steps[2]) < len(steps[1])


def test_contamination_stage(spark, sf, steps):
    def found(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = found(r["text"])
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    lengths = {len(w) for w in windows}

    def clean(text):
        w = found(text)
        return not any(tuple(w[i : i + n]) in windows for n in lengths for i in range(len(w) - n + 1))

    assert sorted(steps[3]) == sorted(r for r in steps[2] if clean(r["text"]))


def test_personal_data_stage(steps):
    before = {r["doc_id"]: r for r in steps[3]}
    assert {r["doc_id"] for r in steps[4]} == set(before)
    for r in steps[4]:
        assert not _base(r["text"]) and r["n_chars"] == len(r["text"])
        if not _base(before[r["doc_id"]]["text"]):
            assert r["text"] == before[r["doc_id"]]["text"]


def test_personal_data_stage_weighs_context(spark, docs_of):
    texts = {1: "ssn 123-45-6789 of a person", 2: "part 123-45-6789", 3: None, 4: "social security: 123-45-6789, a@b.cc"}
    rows = corpus_pipeline.personal_data_stage(spark, docs_of(list(texts.items())), "").collect()
    assert {r["doc_id"]: r["text"] for r in rows} == texts | {1: "ssn [SSN] of a person", 4: "social security: [SSN], [EMAIL]"}
    left = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id bigint, text string")
    assert left.where(F.size(pii.spans(F.col("text"))) > 0).count() == 0


def test_packing_stage_and_run(spark, sf, steps):
    assert {r["doc_id"] for r in steps[5]} == {r["doc_id"] for r in steps[4]}
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    ran = corpus_pipeline.run(spark, sf).select(*key).collect()
    assert sorted(ran) == sorted(tuple(r[c] for c in key) for r in steps[5])
    held = {}
    for r in steps[5]:
        held[r["sequence_id"]] = held.get(r["sequence_id"], 0) + r["length"]
    assert max(held.values()) <= 4096 and len(held) <= -(-sum(held.values()) // 4096) + 1


def test_stages_take_odd_rows_and_extra_columns(spark, odd_docs, docs_of, tables):  # noqa: F811
    for docs in (odd_docs, docs_of([])):
        docs = docs.withColumnsRenamed({"source": "node"}).selectExpr("*", "1 as score", "'x' as hits", "'a' as _a", "2 as _b", "'m' as _mixture", "3 as row", "4 as key_a", "5 as mixture")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, tables), name)
            assert docs.columns == columns
        corpus_pipeline.packing_stage(spark, docs, tables).count()


def test_an_unlabelled_corpus_keeps_what_has_letters(spark, docs_of):
    kept = corpus_pipeline.language_stage(spark, docs_of([(1, "words"), (2, None), (3, "12")]), "")
    assert [r["doc_id"] for r in kept.collect()] == [1]
    assert languages.Model([], np.zeros((languages.BUCKETS, 0))).mixture("words") == []
