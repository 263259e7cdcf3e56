from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import sketches

START = date(2026, 1, 1)
DDL = "city string, n binary, day date"


def _days(spark, path):
    return spark.read.schema(DDL).parquet(path)


def test_merged_days_are_near_the_exact_counts(spark, root):
    df = spark.range(60000).select(
        F.element_at(F.array(F.lit("A"), F.lit("B")), (F.col("id") % 2 + 1).cast("int")).alias("city"),
        F.date_add(F.lit(START), (F.col("id") % 9).cast("int")).alias("day"),
        (F.col("id") % 20011).alias("item"),
    )
    path = f"{root}/s"
    sketches.refresh_sketches(spark, path, df, ["city"], "day", {"n": F.col("item")})
    for days in (1, 3, 9):
        end = START + timedelta(days=days)
        guess = {r["city"]: r["n"] for r in sketches.merged_counts(_days(spark, path).filter(F.col("day") < F.lit(end)), ["city"], ["n"]).collect()}
        exact = df.filter(F.col("day") < F.lit(end)).groupBy("city").agg(F.count_distinct("item").alias("n")).collect()
        assert len(exact) == 2
        for r in exact:
            assert guess[r["city"]] == pytest.approx(r["n"], rel=sketches.relative_error(4))


def test_days_are_replaced_and_nulls_not_counted(spark, root):
    path = f"{root}/s"
    first = [("A", START, 1), ("A", START, 2), ("A", START, None), ("B", START, None), ("A", START + timedelta(days=1), 2)]
    again = [("A", START, 7)]
    for rows in (first, again):
        df = spark.createDataFrame(rows, "city string, day date, item int")
        sketches.refresh_sketches(spark, path, df, ["city"], "day", {"n": F.col("item")})
        stored = _days(spark, path)
        if rows is first:
            assert h.rows(sketches.merged_counts(stored, ["city"], ["n"]), "city", "n") == [("A", 2), ("B", 0)]
    assert h.rows(sketches.merged_counts(stored, ["city", "day"], ["n"]), "city", "day", "n") == [
        ("A", START, 1), ("A", START + timedelta(days=1), 1),
    ]
    assert sketches.merged_counts(stored.limit(0), ["city"], ["n"]).count() == 0
