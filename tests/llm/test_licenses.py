from __future__ import annotations

import re

import pytest

from tidemark.llm import licenses, queries

TEXTS = [
    (1, "Licensed under the Apache License, Version 2.0. The MIT License! the mit-license"),
    (2, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */\nmit license mit license"),
    (3, "GNU General Public License general public license mit licenses amit license"),
    (4, None), (5, ""), (6, "nothing here " * 5000), (6, "nothing here " * 5000), (7, "mit\nlicense é mit é license"),
    (8, "SPDX-License-Identifier: MIT AND\nSPDX-License-Identifier: )("),
]


def _brute(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(found), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_query_equals_brute_force(spark, docs_of, stored_tables, sf):
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    texts = TEXTS + [(i + 100, t) for i, t in given]
    rows = queries.op4_licenses(spark, stored_tables(documents=docs_of(texts))).collect()
    assert len(rows) == len(texts)
    expected = {i: _brute(t) for i, t in texts}
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == expected[r["doc_id"]]
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r["labels"].split(",") for r in rows}
    assert {"apache", "apache-2.0", "mit"} <= set(labels[1])
    assert {"mit", "apache-2.0", "apache", "gpl-2.0-only", "gpl"} <= set(labels[2]) and "classpath-exception-2.0" not in labels[2]
    assert labels[4] == [""] and labels[8] == ["mit"]
    assert queries.op4_licenses(spark, stored_tables(documents=docs_of([]))).count() == 0


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        ("mit", [{"mit"}]),
        ("mit or apache-2.0", [{"apache-2.0"}, {"mit"}]),
        ("a and b or c", [{"c"}, {"a", "b"}]),
        ("a and (b or c)", [{"a", "b"}, {"a", "c"}]),
        ("gpl-2.0 with cp and mit", [{"gpl-2.0-with-cp", "mit"}]),
        ("mit */ something", [{"mit"}]),
    ],
)
def test_expressions(expression, expected):
    assert [set(x) for x in licenses.choices(licenses.parse(expression))] == expected


@pytest.mark.parametrize("text", ["", "and", "mit or", "(mit", "()", ") mit", "mit and or b"])
def test_no_expression(text):
    assert licenses.parse(text) is None


@pytest.mark.parametrize(
    ("expression", "expected"),
    [("MIT  or (a and b)".lower(), "mit or a and b"), ("((a or b)) and c", "(a or b) and c"), ("(a or b) with c", "(a or b) with c"),
     ("a and (b and c)", "a and b and c"), ("a with (b with c)", "a with (b with c)")],
)
def test_normal_form(expression, expected):
    tree = licenses.parse(expression)
    assert licenses.written(tree) == expected
    assert licenses.written(licenses.parse(expected)) == expected


def test_long_expressions():
    names = [f"x{i}" for i in range(5000)]
    pairs = " and ".join(f"(a{i} or b{i})" for i in range(3000))
    for line in (" and ".join(names), " or ".join(names), " or (".join(names) + ")" * 4999, pairs):
        found = licenses.scan(f"SPDX-License-Identifier: {line}\n mit license")
        assert len(found["labels"]) == line.count(" or ") + line.count(" and ") + 2
        assert len(found["expressions"]) == 1 and found["n_words"] > 3000
    assert found["expressions"] == [pairs]
    assert licenses.choices(licenses.parse(" and ".join(names))) == [frozenset(names)]
    assert len(licenses.choices(licenses.parse("(a or b) and (c or d) with e"))) == 4


@pytest.mark.parametrize(
    ("line", "labels", "permissive"),
    [("MIT and see below", ["mit"], False), ("see LICENSE", [], None), ("LicenseRef-Acme OR GPL-3.0", ["gpl", "gpl-3.0", "licenseref-acme"], False),
     ("Zlib", ["zlib"], True), ("Foo-2.0 AND MIT", ["foo-2.0", "mit"], False), ("(GPL-2.0 OR MIT) AND CC0-1.0", ["cc0-1.0", "gpl", "gpl-2.0", "mit"], True),
     ("GPL-2.0 WITH Classpath-exception-2.0 OR Apache-2.0 WITH LLVM-exception", ["apache", "apache-2.0", "gpl", "gpl-2.0"], True)],
)
def test_ids_and_evaluation(line, labels, permissive):
    found = licenses.scan(f"# SPDX-License-Identifier: {line}\n")
    assert found["labels"] == labels and found["permissive"] is permissive


def test_every_expression_is_evaluated():
    both = licenses.scan("SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-2.0")
    assert both["expressions"] == ["mit", "gpl-2.0"] and both["permissive"] is False
    deep = licenses.parse(" or (mpl and ".join(["mit"] * 5000) + ")" * 4999)
    assert licenses.allows(deep, licenses.is_permissive)


def test_clashing_name(docs_of):
    with pytest.raises(ValueError):
        licenses.with_licenses(docs_of([]).withColumnRenamed("source", "Licenses"))
