from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import languages, queries

SYLLABLES = {"aa": "ba ko mi tu la".split(), "bb": "sch eng urt ich auf".split(), "cc": "ción oso las ñe que".split()}


def _text(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    return [(i, _text(rng, lang), lang) for i, lang in enumerate(rng.choices(sorted(SYLLABLES), k=160))]


def test_held_out_accuracy_and_odd_rows(spark, docs_of, stored_tables, corpus):
    odd = [(1000, None, "aa"), (1001, "", None), (1002, "12 34 !!", "bb"), (1003, None, None), (None, corpus[0][1], None), (0, corpus[0][1], corpus[0][2])]
    rows = queries.op3_languages(spark, stored_tables(documents=docs_of(corpus + odd))).collect()
    truth = {i: lang for i, _, lang in corpus}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1000, 1001, 1002, 1003)} == {"und"}
    assert len(rows) == len(corpus) + len(odd) and all(0 <= r["score"] <= 1 for r in rows)


def test_mixture_proportions(spark, docs_of, corpus):
    model = languages.fit(docs_of(corpus))
    rng = random.Random(9)
    both = _text(rng, "aa", 150) + " " + _text(rng, "bb", 50)
    found = dict(model.mixture(both))
    assert set(found) == {"aa", "bb"} and 0.5 < found["aa"] < 0.9
    assert [x for x, _ in model.mixture(_text(rng, "cc"))] == ["cc"]


def test_expectation_maximisation_reaches_the_best_likelihood():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(30), 2).T
    counts = np.bincount(rng.choice(30, 4000, p=p @ [0.3, 0.7]), minlength=30).astype(float)
    share, likelihood = languages._proportions(p, counts)
    grid = np.linspace(0.001, 0.999, 999)
    best = max(float(counts @ np.log(p @ [g, 1 - g])) for g in grid)
    assert likelihood > best - 0.5 and abs(share[0] - 0.3) < 0.06


def test_counts_equal_brute_force(spark, docs_of, corpus):
    model = languages.fit(docs_of(corpus + [(7, None, "aa"), (8, "zz zz", None)]))
    expected = np.zeros((languages.BUCKETS, 3))
    for _, text, lang in corpus:
        at, n = languages.trigrams(text)
        expected[at, sorted(SYLLABLES).index(lang)] += n
    smooth = expected + 0.1
    assert model.languages == sorted(SYLLABLES) and np.allclose(model.probability, smooth / smooth.sum(axis=0))


def test_nothing_to_learn_from(spark, docs_of, stored_tables):
    rows = queries.op3_languages(spark, stored_tables(documents=docs_of([(1, "some text"), (2, None)]))).collect()
    assert {r["lang_pred"] for r in rows} == {"und"}
    assert queries.op3_languages(spark, stored_tables(documents=docs_of([]))).count() == 0
    with pytest.raises(ValueError):
        languages.with_language(docs_of([]).withColumnRenamed("source", "score"), languages.Model([], np.zeros((4, 0))))
