from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import late
from tidemark.operators.incremental import Table, read_table
from tidemark.operators.late import Ledger
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import paths
from tidemark.streaming import streams

FEED, MODEL = "air_pollution", "int_city_hourly_pollution"


def _sync(spark, root, at, *readings):
    h.sync(spark, root, FEED, at, *[(city, h.pollution((seen, aqi, 1, 1, 1))) for city, seen, aqi in readings])


def _house(spark, root):
    return Warehouse(spark, root, track_late=True)


def _late(house):
    return h.rows(house.late(MODEL).rows(house.spark), "city", "arrival", "late_reason")


def test_split_by_bound(spark):
    at = datetime(2026, 1, 5)
    df = spark.createDataFrame([(1, at), (2, at + timedelta(hours=1)), (3, None)], "i int, at timestamp_ntz")
    for inclusive, kept in ((False, [(2,)]), (True, [(1,), (2,)])):
        timely, ruled_out = late.split_late(df, "at", at, inclusive)
        assert h.rows(timely, "i") == kept
        assert timely.count() + ruled_out.count() == 3
        assert (3, "no_cursor", at) in h.rows(ruled_out, "i", "late_reason", "late_bound")
    timely, ruled_out = late.split_late(df, "at", None)
    assert timely.count() == 3 and ruled_out.count() == 0


def test_late_rows_are_named_once_and_the_rows_add_up(spark, root):
    house = _house(spark, root)
    _sync(spark, root, "2026-01-05 20:00:00", ("A", "2026-01-05 19:10:00", 1), ("B", "2026-01-05 19:20:00", 2), ("A", "2026-01-05 19:05:00", 3))
    house.refresh(MODEL, datetime(2026, 1, 5, 20))
    assert _late(house) == []
    _sync(spark, root, "2026-01-05 13:00:00", ("LATE", "2026-01-05 12:10:00", 1))
    _sync(spark, root, "2026-01-05 15:00:00", ("C", "2026-01-05 14:10:00", 1))
    for _ in range(3):
        house.refresh(MODEL, datetime(2026, 1, 5, 21))
    assert _late(house) == [("LATE", 1, "beyond_lookback")]
    assert h.rows(house.table(MODEL), "city") == [("A",), ("B",), ("C",)]
    day = house.reconcile(MODEL).collect()
    assert [(r["landed"], r["stored"], r["superseded"], r["late"], r["unusable"], r["balanced"]) for r in day] == [(5, 3, 1, 1, 0, True)]
    counts = h.rows(house.late(MODEL).counts(spark), "arrival", "landed", "late")
    assert counts == [(0, 3, 0), (1, 2, 1), (2, 0, 0), (3, 0, 0)]


def test_rows_without_a_city_are_unusable(spark, root):
    house = _house(spark, root)
    _sync(spark, root, "2026-01-05 20:00:00", ("A", "2026-01-05 19:10:00", 1), (None, "2026-01-05 19:20:00", 2))
    house.refresh(MODEL, datetime(2026, 1, 5, 20))
    row = house.reconcile(MODEL).first()
    assert (row["landed"], row["stored"], row["unusable"], row["balanced"]) == (2, 1, 1, True)


def test_reconcile_tells_a_lost_row(spark, root):
    house = _house(spark, root)
    _sync(spark, root, "2026-01-05 20:00:00", ("A", "2026-01-05 19:10:00", 1), ("B", "2026-01-04 19:20:00", 2))
    house.refresh(MODEL, datetime(2026, 1, 5, 20))
    paths.remove_partition(spark, house.path(MODEL), "date_utc", "2026-01-04")
    assert h.rows(house.reconcile(MODEL), "balanced") == [(False,), (True,)]


def test_arrival_judged_again_after_a_failure_is_not_doubled(spark, root):
    house = _house(spark, root)
    _sync(spark, root, "2026-01-05 20:00:00", ("A", "2026-01-05 19:10:00", 1))
    house.refresh(MODEL, datetime(2026, 1, 5, 20))
    _sync(spark, root, "2026-01-05 09:00:00", ("LATE", "2026-01-05 08:10:00", 1))
    house.refresh(MODEL, datetime(2026, 1, 5, 21))
    # a run that died before it noted the files judges the same arrival again
    paths.remove(spark, f"{root}/_late/{MODEL}/files/arrival=1")
    house.refresh(MODEL, datetime(2026, 1, 5, 22))
    assert _late(house) == [("LATE", 1, "beyond_lookback")]


def test_full_refresh_applies_late_rows(spark, root):
    house = _house(spark, root)
    _sync(spark, root, "2026-01-05 20:00:00", ("A", "2026-01-05 19:10:00", 1))
    house.refresh(MODEL, datetime(2026, 1, 5, 20))
    _sync(spark, root, "2026-01-05 09:00:00", ("LATE", "2026-01-05 08:10:00", 1))
    house.refresh(MODEL, datetime(2026, 1, 5, 21))
    house.refresh(MODEL, datetime(2026, 1, 5, 22), full_refresh=True)
    assert _late(house) == [] and h.rows(house.table(MODEL), "city") == [("A",), ("LATE",)]
    house.refresh(MODEL, datetime(2026, 1, 5, 23))
    assert _late(house) == [] and h.rows(house.reconcile(MODEL), "balanced") == [(True,)]


def test_pruned_files_are_no_arrival(spark, root):
    house = _house(spark, root)
    _sync(spark, root, "2026-01-05 02:00:00", ("A", "2026-01-05 01:10:00", 1))
    _sync(spark, root, "2026-01-05 20:00:00", ("B", "2026-01-05 19:10:00", 1))
    house.refresh(MODEL, datetime(2026, 1, 5, 20))
    house.prune_landing(datetime(2026, 1, 6, 10))  # the boundary day is rewritten without its first row
    house.refresh(MODEL, datetime(2026, 1, 6, 10))
    assert _late(house) == [] and h.rows(house.late(MODEL).counts(spark), "landed") == [(0,), (2,)]


def test_replayed_micro_batch_keeps_its_bound(spark, root):
    table = Table("t", "intermediate", "k", "day", "at", timedelta(hours=6), aligned=False)
    at = datetime(2026, 1, 5, 12)

    def batch(*rows):
        df = spark.createDataFrame([(k, at + timedelta(hours=d)) for k, d in rows], "k string, at timestamp_ntz")
        return df.withColumn("day", F.to_date("at"))

    sink = streams.split_by_lookback(root, table, lambda df: df, "at")
    sink(batch(("a", 0)), 0)
    second = batch(("b", -5), ("c", 10), ("late", -7))
    for _ in range(2):  # the mark has moved on to ("c", 10) when the batch is replayed
        sink(second, 1)
        assert h.rows(read_table(spark, table.path(root)), "k") == [("a",), ("b",), ("c",)]
        assert h.rows(Ledger(root, "t").rows(spark), "k", "arrival") == [("late", 1)]


def test_forecasts_and_incidents_reconcile(spark, root):
    house = _house(spark, root)
    for at in ("2026-01-05 10:00:00", "2026-01-05 11:00:00"):
        h.sync(spark, root, "weather_forecast", at, ("A", h.forecast(("2026-01-06 09:00:00", 1.0, 0.1, 1.0, "Rain"))))
        h.sync(spark, root, "traffic_incidents", at, ("A", h.incidents(("i1", 1, 5), (None, 2, 6))))
    for name in ("int_city_weather_forecast", "int_city_hourly_traffic_incidents"):
        house.refresh(name, datetime(2026, 1, 5, 12))
    assert h.rows(house.reconcile("int_city_weather_forecast"), "landed", "stored", "balanced") == [(2, 2, True)]
    assert h.rows(house.reconcile("int_city_hourly_traffic_incidents"), "landed", "stored", "unusable", "balanced") == [(4, 2, 2, True)]

