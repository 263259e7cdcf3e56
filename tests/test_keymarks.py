from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import checks, keymarks
from tidemark.plans.warehouse import INTERMEDIATE_TESTS, SchemaTestError, Warehouse
from tidemark.sources import paths
from tidemark.sources.partitions import write_days

FEED, MODEL = "air_pollution", "int_city_hourly_pollution"
SUITE = {MODEL: INTERMEDIATE_TESTS[MODEL]}


def _stored(spark, root, rows, slots):
    df = spark.createDataFrame(rows, "k string, day date")
    write_days(df, f"{root}/t", "day")
    history = spark.read.schema("k string, day date").parquet(f"{root}/t")
    keymarks.refresh_marks(spark, f"{root}/m", history, "k", "day", slots, whole=True)
    return history, keymarks.stored_marks(spark, f"{root}/m", "day")


@pytest.mark.parametrize("slots", [7, 64, keymarks.SLOTS])
def test_verdict_is_that_of_all_rows(spark, root, slots):
    old = [(f"k{i}", date(2026, 1, 1 + i % 5)) for i in range(200)] + [("k3", date(2026, 1, 2)), (None, date(2026, 1, 1)), ("undated", None), ("k9", None)]
    new = [(f"k{i}", date(2026, 2, 1)) for i in (3, 9, 50, 900, 901, 901)] + [(None, date(2026, 2, 1)), (None, date(2026, 2, 1)), ("undated", None)]
    history, marks = _stored(spark, root, old, slots)
    fresh = spark.createDataFrame(new, "k string, day date")
    found = keymarks.duplicate_new_keys(spark, fresh, history, marks, "k", "day", slots)
    everything = checks.duplicate_keys(history.unionByName(fresh), "k").join(fresh.select("k").distinct(), "k")
    expected = h.rows(everything, "k", "n")
    assert h.rows(found, "k", "n") == expected and len(expected) == 5 and ("k3", 3) in expected and ("undated", 2) in expected
    assert keymarks.duplicate_new_keys(spark, fresh.limit(0), history, marks, "k", "day", slots).count() == 0
    assert h.rows(keymarks.duplicate_new_keys(spark, fresh, history.limit(0), marks.limit(0), "k", "day", slots), "k", "n") == [("k901", 2)]


def test_only_partitions_with_a_bit_are_suspect(spark, root):
    old = [(f"k{i}", date(2026, 1, 1 + i % 20)) for i in range(400)]
    _, marks = _stored(spark, root, old, keymarks.SLOTS)
    fresh = spark.createDataFrame([("k7",)] + [(f"new{i}",) for i in range(50)], "k string")
    assert h.rows(keymarks.suspects(fresh, marks, "k", "day"), "k", "day") == [("k7", date(2026, 1, 8))]
    assert marks.count() <= 400  # a bucket without a key takes no row
    assert marks.select(F.max(F.length("bits"))).first()[0] == keymarks.BUCKET_BITS // 8


def test_marks_of_a_day_are_replaced(spark, root):
    _, marks = _stored(spark, root, [("a", date(2026, 1, 1)), ("b", date(2026, 1, 2))], keymarks.SLOTS)
    again = spark.createDataFrame([("c", date(2026, 1, 2))], "k string, day date")
    keymarks.refresh_marks(spark, f"{root}/m", again, "k", "day")
    marks = keymarks.stored_marks(spark, f"{root}/m", "day")
    probes = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert h.rows(keymarks.suspects(probes, marks, "k", "day"), "k", "day") == [("a", date(2026, 1, 1)), ("c", date(2026, 1, 2))]


def _sync(spark, root, at, *readings):
    h.sync(spark, root, FEED, at, *[(city, h.pollution((seen, 2, 1, 1, 1))) for city, seen in readings])


def _plant(house):
    """A row of January 6th once more, under the 5th."""
    day = F.lit(date(2026, 1, 5))
    row = house.table(MODEL).filter("date_utc = DATE '2026-01-06' AND city = 'A'").withColumn("date_utc", day)
    row.write.mode("append").partitionBy("date_utc").parquet(house.path(MODEL))


def _violations(house, scope):
    return sum(r["violations"] for r in house.test(SUITE, scope).filter("test = 'unique'").collect())


def test_run_finds_a_key_of_another_day(spark, root):
    plain, marked = Warehouse(spark, root), Warehouse(spark, root, key_marks=True)
    _sync(spark, root, "2026-01-05 20:00:00", ("B", "2026-01-05 19:10:00"))
    plain.refresh(MODEL, datetime(2026, 1, 5, 20))
    _sync(spark, root, "2026-01-06 10:00:00", ("A", "2026-01-06 09:10:00"))
    plain.refresh(MODEL, datetime(2026, 1, 6, 10))
    _plant(plain)
    for hour in (11, 12):
        _sync(spark, root, f"2026-01-06 {hour}:00:00", ("A", f"2026-01-06 {hour - 1}:10:00"))
        for house in (plain, marked):
            house.refresh(MODEL, datetime(2026, 1, 6, hour))
        assert (_violations(plain, "written"), _violations(marked, "written"), _violations(plain, "all")) == (0, 1, 1)
    with pytest.raises(SchemaTestError):
        marked._require(SUITE, "written")
    assert marked.repeated_keys(MODEL, "city") is None and marked.repeated_keys("dim_city", "city_key") is None


def test_unmarked_changes_are_noticed(spark, root):
    plain, marked = Warehouse(spark, root), Warehouse(spark, root, key_marks=True)
    _sync(spark, root, "2026-01-05 20:00:00", ("B", "2026-01-05 19:10:00"))
    marked.refresh(MODEL, datetime(2026, 1, 5, 20))
    path = marked._marks_path(MODEL)
    assert not paths.exists(spark, f"{path}/_UNMARKED") and marked._announce(MODEL)
    marked._mark_keys(MODEL, True)
    _sync(spark, root, "2026-01-06 10:00:00", ("A", "2026-01-06 09:10:00"))
    plain.refresh(MODEL, datetime(2026, 1, 6, 10))  # leaves a note, as a run that died would
    assert paths.exists(spark, f"{path}/_UNMARKED")
    assert keymarks.stored_marks(spark, path, "date_utc").select("date_utc").distinct().count() == 1
    _sync(spark, root, "2026-01-07 10:00:00", ("A", "2026-01-07 09:10:00"))
    marked.refresh(MODEL, datetime(2026, 1, 7, 10))
    assert keymarks.stored_marks(spark, path, "date_utc").select("date_utc").distinct().count() == 3
    assert not paths.exists(spark, f"{path}/_UNMARKED") and _violations(marked, "written") == 0
