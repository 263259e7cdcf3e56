from __future__ import annotations

import hashlib
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.functions import labels
from tidemark.functions.keys import NULL_MARKER, date_key, surrogate_key
from tidemark.functions.measures import avg_rounded, comfort_index, comfort_parts, most_frequent, share_rounded, sum_or_zero
from tidemark.functions.times import hour_of, lead_time_bucket, lead_time_hours
from tidemark.operators.rollup import distinct_counts, mode_and_means


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert [r[0] for r in df.orderBy("n").select(surrogate_key("s", "n")).collect()] == [md5("a-1"), md5(f"{NULL_MARKER}-2")]


def test_hour_and_date_key(spark):
    df = spark.createDataFrame([(datetime(2026, 3, 9, 23, 59, 59, 5),)], "t timestamp_ntz")
    assert df.select(hour_of("t"), date_key("t")).first() == (datetime(2026, 3, 9, 23), 20260309)


def test_lead_times(spark):
    issued = datetime(2026, 1, 5, 10)
    cases = [("2026-01-05 09:40:00", 0, "<6h"), ("2026-01-05 09:30:00", -1, "<6h"), ("2026-01-05 10:30:00", 1, "<6h"),
             ("2026-01-05 15:59:59", 6, "<6h"), ("2026-01-05 16:00:00", 6, "6-24h"), ("2026-01-06 10:00:00", 24, "1-3d"),
             ("2026-01-08 10:00:00", 72, "3-5d")]
    df = spark.createDataFrame([(datetime.fromisoformat(t), issued) for t, _, _ in cases], "t timestamp_ntz, i timestamp_ntz")
    got = {r["t"]: (r["h"], r["b"]) for r in df.select("t", lead_time_hours("t", "i").alias("h"), lead_time_bucket("t", "i").alias("b")).collect()}
    assert got == {datetime.fromisoformat(t): (h, b) for t, h, b in cases}


def test_average_rounds_half_away_from_zero(spark):
    data = [("a", "88.16"), ("a", "88.17"), ("b", "-0.01"), ("b", "0.00"), ("c", None)]
    df = spark.createDataFrame([(k, None if v is None else Decimal(v)) for k, v in data], "k string, v decimal(18,6)")
    got = rows(df.groupBy("k").agg(avg_rounded("v", 2), sum_or_zero("v", 2)))
    assert got == [("a", Decimal("88.17"), Decimal("176.33")), ("b", Decimal("-0.01"), Decimal("-0.01")), ("c", None, Decimal("0.00"))]


def test_average_of_integers_and_share(spark):
    df = spark.createDataFrame([(1,), (2,), (4,)], "v int")
    assert df.agg(avg_rounded("v", 2), avg_rounded("v", 0), share_rounded(F.col("v") > 1, 3)).first() == (Decimal("2.33"), 2, Decimal("0.667"))


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", None)], "k string, v string")
    assert rows(df.groupBy("k").agg(most_frequent("v"))) == [("a", "x"), ("b", None)]
    two_step = mode_and_means(df.withColumn("n", F.lit(1)), ["k"], ("v", "v"), {"m": ("n", 1)})
    assert rows(two_step, "k", "v") == [("a", "x"), ("b", None)]


def test_distinct_counts(spark):
    data = [("c", "i1", 3, 10), ("c", "i1", 1, 20), ("c", "i2", 1, None), ("c", "i3", 3, 1), ("d", None, 3, 5)]
    df = spark.createDataFrame(data, "c string, i string, m int, w int")
    got = rows(distinct_counts(df, ["c"], "i", F.col("m") == 3, "w", 0, ("total", "major", "mean")))
    assert got == [("c", 3, 2, Decimal(10)), ("d", 0, 0, Decimal(5))]


def _comfort(spark, temp, aqi, congestion):
    df = spark.createDataFrame([(temp, aqi, congestion)], "t decimal(18,2), a decimal(18,2), c decimal(18,3)")
    parts = comfort_parts(F.col("t"), F.col("a"), F.col("c"))
    return df.select(comfort_index(*parts)).first()[0]


def test_comfort_index(spark):
    assert _comfort(spark, Decimal("30"), Decimal("1"), Decimal("0")) == Decimal("1.000")
    assert _comfort(spark, Decimal("45"), Decimal("1"), None) == Decimal("0.900")
    assert _comfort(spark, None, Decimal("5"), Decimal("1")) == Decimal("0.000")
    assert _comfort(spark, Decimal("10"), None, Decimal("0")) is None
    assert _comfort(spark, Decimal("10"), Decimal("3"), Decimal("0.2")) == Decimal("0.493")


def test_labels(spark):
    values = [None, "0.19", "0.2", "0.25", "0.4", "0.5", "0.6", "0.75"]
    df = spark.createDataFrame([(None if v is None else Decimal(v),) for v in values], "v decimal(18,3)")
    got = [tuple(r) for r in df.select(labels.comfort_label(F.col("v")), labels.congestion_label(F.col("v"))).collect()]
    assert got == [
        ("No data", "No data"), ("Poor", "Low"), ("Poor", "Moderate"), ("Fair", "Moderate"), ("Fair", "High"),
        ("Good", "High"), ("Good", "Severe"), ("Excellent", "Severe"),
    ]
    pairs = [("0.52", "0.50"), ("0.521", "0.50"), ("0.479", "0.50"), ("0.48", "0.50"), ("0.5", None)]
    df = spark.createDataFrame([(Decimal(a), None if b is None else Decimal(b)) for a, b in pairs], "r decimal(18,3), p decimal(18,3)")
    got = [r[0] for r in df.select(labels.trend_label(F.col("r"), F.col("p"))).collect()]
    assert got == ["Stable", "Improving", "Worsening", "Stable", "Insufficient data"]
    df = spark.createDataFrame([(Decimal(v) if v else None,) for v in ("5", "5.01", "-5", "-5.01", None)], "g decimal(18,2)")
    assert [r[0] for r in df.select(labels.anomaly_label(F.col("g"))).collect()] == [
        "Normal", "Hot anomaly", "Normal", "Cold anomaly", "Normal",
    ]
