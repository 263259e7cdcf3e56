from __future__ import annotations

import pytest

from tests.compare import differences, duck_rows, spark_rows
from tidemark.llm import contamination, queries


@pytest.fixture(scope="module")
def tables(spark, docs_of, stored_tables, prose):
    item = " ".join(prose(1, 25))
    items = [(1, item), (2, "Short item, only five words"), (3, None), (4, ""), (5, item), (10, "één twee drie"), (None, " ".join(prose(2, 10)))]
    passage = " ".join(prose(1, 25)[4:18]).upper()
    docs = [
        (1, "before " + passage + " after"), (2, " ".join(prose(1, 25)[:9])), (3, "a short item; only FIVE words! x"), (4, None), (5, ""),
        (6, " ".join(prose(3, 400))), (7, item + " " + item), (7, item + " " + item), (8, "één-twee...drie"), (None, item), (9, " ".join(prose(2, 10)) * 2),
        (11, "w " * 30000 + passage),
    ]
    return stored_tables(documents=docs_of(docs), benchmark=spark.createDataFrame(items, "item_id bigint, text string"))


def test_hits(spark, tables):
    by_id = {}
    for r in queries.op6_contamination(spark, tables).collect():
        by_id.setdefault(r["doc_id"], []).append((r["n_hit"], r["n_items"], r["contaminated"]))
    assert by_id[1] == [(14, 2, True)] and by_id[2] == [(0, 0, False)] and by_id[3] == [(5, 1, True)]
    assert by_id[7] == [(50, 2, True)] * 2 and by_id[8] == [(3, 1, True)] and by_id[None] == [(25, 2, True)]
    assert by_id[4] == by_id[5] == by_id[6] == [(0, 0, False)] and by_id[11] == [(14, 2, True)]


def test_query_equals_sql_on_given_tables(spark, sf):
    from tests.compare import duck

    got = spark_rows(queries.op6_contamination(spark, sf))
    assert differences(got, duck_rows(duck(sf), queries.SQL["op6_contamination"])) == []


def test_shuffled_table_and_full_sieve_give_the_same(spark, tables, monkeypatch):
    expected = spark_rows(queries.op6_contamination(spark, tables))
    monkeypatch.setattr(contamination, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(contamination, "BITS", 64)
    assert spark_rows(queries.op6_contamination(spark, tables)) == expected


def test_drop_contaminated_keeps_rows_and_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").withColumnsRenamed({"lang": "items", "source": "key_a"})
    kept = contamination.drop_contaminated(docs, spark.read.parquet(f"{tables}/benchmark.parquet"))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6, 9]


def test_empty_tables(spark, docs_of, stored_tables):
    none = spark.createDataFrame([], "item_id bigint, text string")
    sf = stored_tables(documents=docs_of([(1, "a b c")]), benchmark=none)
    assert [r["contaminated"] for r in queries.op6_contamination(spark, sf).collect()] == [False]
    assert queries.op6_contamination(spark, stored_tables(documents=docs_of([]), benchmark=none)).count() == 0


def test_no_python_in_the_plan(spark, tables):
    plan = queries.op6_contamination(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
