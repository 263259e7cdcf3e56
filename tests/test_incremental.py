"""Incremental loads against full rebuilds, replays, empty targets, late and stale rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import incremental as inc
from tidemark.operators.dedupe import Ranking, keep_latest
from tidemark.operators.incremental import Restriction, Table
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL, Warehouse
from tidemark.sources import landing, partitions, paths

NOW = datetime(2026, 1, 10)
RANK = Ranking(("k", "day"), ("seen",), ("v",))
TABLE = Table("t", "intermediate", "k", "day", "seen", timedelta(hours=6), aligned=False, ranking=RANK)


def _source(spark, data):
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, seen timestamp_ntz, v int")
    return df.withColumn("day", F.to_date("at"))


def _build(src):
    return keep_latest(src.select("k", "day", "seen", "v"), RANK)


def _refresh(spark, root, src, **kw):
    inc.refresh(spark, root, TABLE, _build, {"src": src}, {"src": Restriction("seen")}, **kw)


def _stored(spark, root):
    return h.rows(inc.read_table(spark, TABLE.path(root)).select("k", "day", "seen", "v"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_batches_equal_full_refresh(spark, root, seed):
    rng = random.Random(seed)
    start = datetime(2026, 1, 1)
    data = []
    for _ in range(200):
        at = start + timedelta(minutes=rng.randrange(6 * 24 * 60))
        data.append((rng.choice("abc"), at, at + timedelta(minutes=rng.randrange(300)), rng.randrange(5)))
    data.sort(key=lambda r: r[2])
    cuts = sorted(rng.sample(range(1, 200), 3)) + [200]
    for cut in cuts:
        _refresh(spark, f"{root}/inc", _source(spark, data[:cut]))
    _refresh(spark, f"{root}/full", _source(spark, data), full_refresh=True)
    assert _stored(spark, f"{root}/inc") == _stored(spark, f"{root}/full")
    before = _stored(spark, f"{root}/inc")
    _refresh(spark, f"{root}/inc", _source(spark, data))
    assert _stored(spark, f"{root}/inc") == before


def test_hot_key_gives_the_same_rows(spark, root):
    """A third of all rows share one key and day; the result is that of the plain ranking."""
    at = datetime(2026, 1, 1)
    hot = [("hot", at, at + timedelta(seconds=i), i % 7) for i in range(3000)]
    rest = [(f"k{i}", at + timedelta(days=i % 3), at + timedelta(seconds=i), i) for i in range(6000)]
    src = _source(spark, hot + rest).repartition(8)
    _refresh(spark, root, src.filter("seen < timestamp'2026-01-01 00:30:00'"))
    _refresh(spark, root, src)
    stored = {(r[0], r[1]): r for r in _stored(spark, root)}
    assert len(stored) == 6001 and stored["hot", at.date()][2] == at + timedelta(seconds=2999)


def test_empty_target_loads_everything(spark, root):
    _refresh(spark, root, _source(spark, []))
    assert inc.high_water_mark(spark, root, TABLE) is None
    at = datetime(2026, 1, 1)
    _refresh(spark, root, _source(spark, [("a", at, at, 1)]))
    assert len(_stored(spark, root)) == 1


def test_stale_resync_loses_unless_told_otherwise(spark, root):
    at, hour = datetime(2026, 1, 1), timedelta(hours=1)
    rank = Ranking(("k", "day"), ("at", "seen"))
    table = Table("t", "intermediate", "k", "day", "seen", timedelta(hours=6), aligned=False, ranking=rank)

    def run(where, rows_, compare):
        src = spark.createDataFrame(rows_, "k string, at timestamp_ntz, seen timestamp_ntz, v int").withColumn("day", F.to_date("at"))
        inc.refresh(spark, where, table, lambda src: keep_latest(src, rank), {"src": src}, {"src": Restriction("seen")}, compare_existing=compare)
        return h.rows(inc.read_table(spark, table.path(where)).select("v"))

    fresh = [("a", at + hour, at + hour, 1)]
    stale = [("a", at, at + 8 * hour, 2), ("b", at, at + 8 * hour, 9)]
    for compare, expected in ((True, [(1,), (9,)]), (False, [(2,), (9,)])):
        where = f"{root}/{compare}"
        run(where, fresh, compare)
        assert run(where, stale, compare) == expected


def test_row_later_than_the_lookback_is_dropped(spark, root):
    at, hour = datetime(2026, 1, 1), timedelta(hours=1)
    _refresh(spark, root, _source(spark, [("a", at, at + 10 * hour, 1)]))
    _refresh(spark, root, _source(spark, [("b", at, at + 3 * hour, 1), ("c", at, at + 5 * hour, 1)]))
    assert [r[0] for r in _stored(spark, root)] == ["a", "c"]


def test_mark_is_recorded_and_can_be_recovered(spark, root):
    at = datetime(2026, 1, 1)
    _refresh(spark, root, _source(spark, [("a", at, at + timedelta(hours=5), 1)]))
    assert inc.high_water_mark(spark, root, TABLE) == at + timedelta(hours=5)
    paths.remove(spark, f"{root}/_marks/t")
    assert inc.high_water_mark(spark, root, TABLE) == at + timedelta(hours=5)


def test_only_touched_partitions_are_rewritten(spark, root):
    at, day = datetime(2026, 1, 1), timedelta(days=1)
    _refresh(spark, root, _source(spark, [("a", at, at, 1), ("a", at + day, at + day, 1)]))
    untouched = f"{TABLE.path(root)}/day=2026-01-01"
    fs, p = paths._fs(spark, untouched)
    files = sorted(s.getPath().getName() for s in fs.listStatus(p))
    _refresh(spark, root, _source(spark, [("a", at + day, at + day, 5), ("a", at + 2 * day, at + 2 * day, 6)]))
    assert sorted(s.getPath().getName() for s in fs.listStatus(p)) == files
    assert [r[3] for r in _stored(spark, root)] == [1, 5, 6]


def test_interrupted_replacement_is_completed_by_the_next_run(spark, root):
    at, day = datetime(2026, 1, 1), timedelta(days=1)
    _refresh(spark, root, _source(spark, [("a", at, at, 1), ("a", at + day, at + day, 1)]))
    path = TABLE.path(root)
    swap = partitions.swap_path(path)
    changed = inc.read_table(spark, path).withColumn("v", F.lit(7))
    # the run wrote everything and died after it had removed one old partition
    partitions.write_days(changed, swap, "day")
    paths.touch(spark, f"{swap}/{partitions.READY}")
    paths.remove_partition(spark, path, "day", "2026-01-01")
    _refresh(spark, root, _source(spark, []))
    assert [r[3] for r in _stored(spark, root)] == [7, 7]
    # a run that died while writing leaves the table as it was
    partial = inc.read_table(spark, path).withColumn("v", F.lit(9)).limit(1)
    partitions.write_days(partial, swap, "day")
    _refresh(spark, root, _source(spark, []))
    assert [r[3] for r in _stored(spark, root)] == [7, 7]
    assert not paths.exists(spark, swap)
    # a full refresh that died after writing everything replaces the whole table
    partitions.write_days(_build(_source(spark, [("z", at, at, 3)])), swap, "day")
    paths.touch(spark, f"{swap}/{partitions.READY_ALL}")
    _refresh(spark, root, _source(spark, []))
    assert [r[0] for r in _stored(spark, root)] == ["z"]


def test_key_replace_stores_a_whole_batch(spark, root):
    table = Table("t", "marts", "k", "day", "day", timedelta(days=2), inclusive=True)
    src = spark.createDataFrame([("a", "2026-01-01", 1), ("b", "2026-01-01", 1)], "k string, day string, v int").withColumn("day", F.to_date("day"))
    inc.delete_insert(spark, root, table, src)
    twice = src.filter("k = 'a'").withColumn("v", F.lit(2))
    inc.delete_insert(spark, root, table, twice.unionByName(twice))
    assert h.rows(inc.read_table(spark, table.path(root)).select("k", "v")) == [("a", 2), ("a", 2), ("b", 1)]


def _reading(aqi, at):
    return ("A", h.pollution((at, aqi, 1, 1, 1)))


def _alert_house(spark, root):
    house = Warehouse(spark, root)

    def run():
        for name in ("int_city_hourly_pollution", "fct_pollution_hourly", "mart_pollution_alerts"):
            house.refresh(name, NOW)

    return house, run


def test_cleared_reading_removes_its_alert(spark, root):
    """A clean reading replaces a breaching one of the same hour: its alert must not survive."""
    house, run = _alert_house(spark, root)
    h.sync(spark, root, "air_pollution", "2026-01-05 10:15:00", _reading(5, "2026-01-05 09:10:00"), _reading(4, "2026-01-04 23:10:00"))
    run()
    assert house.table("mart_pollution_alerts").count() == 2
    h.sync(spark, root, "air_pollution", "2026-01-05 10:55:00", _reading(1, "2026-01-05 09:50:00"))
    run()
    assert h.rows(house.table("mart_pollution_alerts"), "observed_at") == [(datetime(2026, 1, 4, 23, 10),)]
    full = m.pollution_alerts(house.table("fct_pollution_hourly"))
    assert h.rows(house.table("mart_pollution_alerts"), "alert_key") == h.rows(full, "alert_key")
    assert paths.partition_values(spark, house.path("mart_pollution_alerts"), "date_utc") == ["2026-01-04"]


def test_no_alerts_at_all(spark, root):
    house, run = _alert_house(spark, root)
    h.sync(spark, root, "air_pollution", "2026-01-05 10:15:00", _reading(1, "2026-01-05 09:10:00"))
    run()
    run()
    assert house.table("mart_pollution_alerts").count() == 0


def test_daily_fact_recomputes_two_days_from_all_hours(spark, root):
    house = Warehouse(spark, root)
    names = ("int_city_hourly_weather", "fct_weather_daily")
    h.sync(spark, root, "current_weather", "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 09:00:00", 10)), ("A", h.weather("2026-01-03 09:00:00", 1)))
    for n in names:
        house.refresh(n, NOW)
    h.sync(spark, root, "current_weather", "2026-01-05 11:00:00", ("A", h.weather("2026-01-05 10:00:00", 20)), ("A", h.weather("2026-01-03 10:00:00", 3)))
    for n in names:
        house.refresh(n, NOW)
    got = h.rows(house.table("fct_weather_daily"), "date_key", "avg_temp_celsius", "observation_count")
    assert [(k, float(v), n) for k, v, n in got] == [(20260103, 2.0, 2), (20260105, 15.0, 2)]


def test_lookback_prunes_the_scan(spark, root):
    h.sync(spark, root, "current_weather", "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 09:00:00", 10)))
    src = landing.read_landing(spark, root, "current_weather")
    model = INCREMENTAL["int_city_hourly_weather"]
    recent = inc.restrict(src, model.restrictions["staged"], datetime(2026, 1, 5, 4), False)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extracted_date" in plan and "GreaterThan(extracted_at" in plan


def test_backfill_restores_keys(spark, root):
    house = Warehouse(spark, root)
    h.sync(spark, root, "current_weather", "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 09:00:00")), ("B", h.weather("2026-01-04 09:00:00")))
    house.refresh("int_city_hourly_weather", NOW)
    before = h.rows(house.table("int_city_hourly_weather"), "city_hour_key", "city")
    table = INCREMENTAL["int_city_hourly_weather"].table
    inc.rewrite_keys(spark, root, table, F.lit("scrambled"))
    assert h.rows(house.table("int_city_hourly_weather").select("city_hour_key").distinct()) == [("scrambled",)]
    for _ in range(2):
        assert inc.rewrite_keys(spark, root, table, m.city_hour_key()) == 2
        assert h.rows(house.table("int_city_hourly_weather"), "city_hour_key", "city") == before


def test_days_the_target_does_not_hold_yet_are_moved_in_not_written_again(spark, root, monkeypatch):
    table = Table("t", "marts", "k", "day", "day", timedelta(days=1))

    def rows(*values):
        return spark.createDataFrame([(k, date.fromisoformat(d) if d else None, v) for k, d, v in values], "k string, day date, v int")

    inc.delete_insert(spark, root, table, rows(("a", "2024-01-01", 1), ("b", "2024-01-02", 1)))
    merged, write = [], partitions.write_days
    monkeypatch.setattr(partitions, "write_days", lambda df, path, part: (merged.append(df.count()), write(df, path, part)))
    batch = rows(("b", "2024-01-02", 2), ("c", "2024-01-03", 2), ("d", None, 2))
    wrote = inc.delete_insert(spark, root, table, batch)
    assert merged == [1] and wrote == sorted(["2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"])
    stored = inc.read_table(spark, table.path(root)).select("k", F.col("day").cast("string"), "v").collect()
    assert sorted(map(tuple, stored)) == [("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("c", "2024-01-03", 2), ("d", None, 2)]
    inc.delete_insert(spark, root, table, rows(("e", "2024-01-05", 3)))
    assert merged == [1] and inc.read_table(spark, table.path(root)).count() == 5
