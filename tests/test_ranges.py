from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import incremental as inc
from tidemark.operators.ranges import spans_to_read, touched_rows
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL, ROLLING, Warehouse
from tidemark.sources import paths

START = date(2026, 1, 1)
FACT = INCREMENTAL["fct_weather_daily"].table
TRENDS = "mart_temperature_trends"


def _timeline(spark, rows):
    return spark.createDataFrame([(c, START + timedelta(days=n)) for c, n in rows], "city string, day date")


def test_touched_rows_equal_brute_force(spark):
    rng = random.Random(3)
    for reach in (2, 5, 30):
        rows = sorted({(c, rng.randrange(120)) for c, n in (("dense", 200), ("half", 60), ("sparse", 12), ("other", 30)) for _ in range(n)})
        days = sorted({n for _, n in rows})
        changed = rng.sample(days, 2) + [days[-1]]
        timeline = _timeline(spark, rows)
        at = [START + timedelta(days=n) for n in days]
        spans = spans_to_read(timeline, at, [START + timedelta(days=n) for n in changed], "city", "day", reach)
        assert all(a.last < b.first for a, b in zip(spans, spans[1:]))
        got = sorted(
            (r["city"], (r["day"] - START).days) for s in spans for r in touched_rows(timeline, s, "city", "day", reach).collect()
        )
        expected = []
        for city in {c for c, _ in rows}:
            own = [n for c, n in rows if c == city]
            for i, n in enumerate(own):
                frame = own[max(0, i - reach + 1) : i + 1]
                if set(frame) & set(changed):
                    expected.append((city, n))
                    span = next(s for s in spans if s.first <= START + timedelta(days=n) <= s.last)
                    assert span.first <= START + timedelta(days=frame[0])  # the whole frame is read
        assert got == sorted(expected)


def test_a_recent_change_reads_a_bounded_range(spark):
    timeline = _timeline(spark, [(c, n) for c in "AB" for n in range(400)])
    days = [START + timedelta(days=n) for n in range(400)]
    last, old = days[-1], days[100]
    assert [(s.first, s.last) for s in spans_to_read(timeline, days, [last], "city", "day", 30)] == [(days[370], last)]
    spans = spans_to_read(timeline, days, [old, last], "city", "day", 30)
    assert [(s.first, s.last) for s in spans] == [(days[71], days[129]), (days[370], last)]
    assert spans_to_read(timeline, days, [], "city", "day", 30) == []


def _facts(spark, rows):
    """(city, day number, temperature) as the part of the daily weather facts that trends read."""
    df = spark.createDataFrame([(c, START + timedelta(days=n), float(t)) for c, n, t in rows], "city string, date_utc date, t double")
    t = F.col("t").cast("decimal(24,2)")
    key = F.concat_ws("-", "city", F.col("date_utc").cast("string")).alias("city_date_key")
    return df.select(key, "city", "date_utc", *[t.alias(f"{k}_temp_celsius") for k in ("avg", "min", "max")])


def _write(house, rows):
    house.written[FACT.name] = inc.delete_insert(house.spark, house.root, FACT, _facts(house.spark, rows))


def _files(spark, house, day):
    fs, p = paths._fs(spark, f"{house.path(TRENDS)}/date_utc={START + timedelta(days=day)}")
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def test_trends_equal_a_full_rebuild_and_leave_other_days_alone(spark, root):
    rng, house = random.Random(9), Warehouse(spark, root)
    rows = [("A", n, rng.randrange(30)) for n in range(70)] + [("S", n, rng.randrange(30)) for n in range(0, 70, 9)]
    _write(house, rows)
    assert house.refresh_rolling(TRENDS, datetime(2026, 4, 1)) is None

    def check():
        expected = m.temperature_trends(house.table(FACT.name))
        assert h.rows(house.table(TRENDS).select(*expected.columns)) == h.rows(expected)

    check()
    before = {n: _files(spark, house, n) for n in (0, 9, 64)}
    _write(house, [("A", 10, 99), ("A", 70, 1)])  # an old day of one city is corrected, a new day comes
    wrote = house.refresh_rolling(TRENDS, datetime(2026, 4, 1))
    check()
    assert str(START + timedelta(days=10)) in wrote and str(START + timedelta(days=39)) in wrote
    assert {n: _files(spark, house, n) for n in before} == before  # before the change, and past its reach
    _write(house, [("S", 4, 50)])  # a row that was missing shifts the frames of a sparse city
    house.refresh_rolling(TRENDS, datetime(2026, 4, 1))
    check()
    house.written[FACT.name] = []
    assert house.refresh_rolling(TRENDS, datetime(2026, 4, 1)) == []


def test_run_with_bounded_marts_equals_rebuilt_marts(spark, root):
    from tidemark.sources import config as cfg

    bounded, rebuilt = Warehouse(spark, f"{root}/a", bounded_marts=True, calendar_start=START), Warehouse(spark, f"{root}/b", calendar_start=START)
    config = cfg.seed_config(spark)
    config["validation_rules"] = config["validation_rules"].withColumn("severity", F.lit("warn"))
    for i, (at, country) in enumerate((("2026-01-05 10:00:00", "DE"), ("2026-01-06 10:00:00", "FR"), ("2026-01-06 11:00:00", "FR"))):
        for house in (bounded, rebuilt):
            hour = at[:13]
            h.sync(spark, house.root, "current_weather", at, ("A", h.weather(f"{hour}:05:00", 10 + i, country=country)), ("A", h.weather(f"{hour}:59:00", 9, country=country)))
            h.sync(spark, house.root, "air_pollution", at, ("A", h.pollution((f"{hour}:10:00", 2, 1, 1, 1))))
            h.sync(spark, house.root, "weather_forecast", at, ("A", h.forecast(("2026-01-07 09:00:00", 1.0, 0.1, 1.0, "Rain"))))
            h.sync(spark, house.root, "traffic_flow", at, ("A", h.flow(10, 20)))
            h.sync(spark, house.root, "traffic_incidents", at, ("A", h.incidents(("i1", 1, 5))))
            house.run(datetime.fromisoformat(at), config, run_id=str(i), test="none")
    assert set(ROLLING) == {TRENDS, "mart_city_daily"}
    for name in ROLLING:
        expected = rebuilt.table(name)
        assert expected.count() > 1
        if "country" in expected.columns:  # the lent country changed with the last run
            assert {r["country"] for r in expected.collect()} == {"FR"}
        assert h.rows(bounded.table(name).select(*expected.columns)) == h.rows(expected)
    assert paths.partition_values(spark, bounded.path(TRENDS), "date_utc") == ["2026-01-05", "2026-01-06"]
