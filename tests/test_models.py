from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import checks, dims
from tidemark.operators.dedupe import Ranking, keep_latest
from tidemark.plans import models as m


def test_hourly_dedupe_keeps_freshest_reading(spark):
    df = h.staged(
        spark, "current_weather",
        ("2026-01-05 11:00:00", "Berlin", h.weather("2026-01-05 10:10:00", 1)),
        ("2026-01-05 11:00:00", "Berlin", h.weather("2026-01-05 10:50:00", 2)),
        ("2026-01-05 12:00:00", "Berlin", h.weather("2026-01-05 10:50:00", 3)),
        ("2026-01-05 13:00:00", "Berlin", h.weather("2026-01-05 10:10:00", 4)),
        ("2026-01-05 13:00:00", "Berlin", h.weather("2026-01-05 11:00:00", 5)),
        ("2026-01-05 13:00:00", None, h.weather("2026-01-05 11:00:00", 6)),
    )
    assert h.rows(m.hourly_weather(df), "hour_utc", "temp_celsius") == [(10, Decimal(3)), (11, Decimal(5))]


def test_dedupe_does_not_depend_on_order(spark):
    data = [("a", 1, v) for v in range(50)] + [("b", 1, 7)] * 3
    rank = Ranking(("k",), ("t",))
    one = h.rows(keep_latest(spark.createDataFrame(data, "k string, t int, v int"), rank))
    other = h.rows(keep_latest(spark.createDataFrame(data[::-1], "k string, t int, v int").repartition(7), rank))
    assert one == other and len(one) == 2


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    plan = keep_latest(df, Ranking(("k",), ("t",)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_incidents_without_id_are_left_out(spark):
    df = h.staged(
        spark, "traffic_incidents",
        ("2026-01-05 10:00:00", "A", h.incidents(("i1", 3, 60), (None, 3, 5))),
        ("2026-01-05 11:00:00", "A", h.incidents(("i1", 1, 20), ("i2", 1, None))),
    )
    hourly = m.traffic_incidents(df)
    assert hourly.count() == 3
    flow = h.staged(spark, "traffic_flow", ("2026-01-05 10:00:00", "A", h.flow(20, 40)), ("2026-01-05 10:00:00", "B", h.flow(40, 40, True)))
    daily = m.traffic_daily(m.hourly_traffic_flow(flow), hourly)
    got = h.rows(daily, "city", "total_incidents", "major_incidents", "avg_delay_sec", "road_closure_count", "pct_congested_snapshots")
    assert got == [("A", 2, 1, Decimal(40), 0, Decimal("1.000")), ("B", 0, 0, None, 1, Decimal("0.000"))]


def test_forecast_history_latest_and_alerts(spark):
    slots = [("2026-01-05 12:00:00", 36.0, 0.7, 17.2, "Clear"), ("2026-01-06 12:00:00", -10.0, 0.2, 10.8, "Snow")]
    newer = [("2026-01-05 12:00:00", 40.0, 0.69, 10.7, "Clear")]
    df = h.staged(
        spark, "weather_forecast",
        ("2026-01-05 10:00:00", "A", h.forecast(*slots)), ("2026-01-05 11:00:00", "A", h.forecast(*newer)),
    )
    history = m.forecast_history(df)
    assert history.count() == 3
    latest = m.forecast_latest(history, datetime(2026, 1, 5, 12, 45))
    assert h.rows(latest, "forecast_at", "temp_celsius", "lead_time_hours") == [
        (datetime(2026, 1, 5, 12), Decimal(40), 1), (datetime(2026, 1, 6, 12), Decimal(-10), 26),
    ]
    assert m.forecast_latest(history, datetime(2026, 1, 5, 13)).count() == 1
    got = h.rows(m.weather_alerts(latest), "alert_type", "severity", "trigger_value", "trigger_unit")
    assert got == [
        ("Extreme cold", "Severe", Decimal(-10), "°C"), ("Extreme heat", "Severe", Decimal(40), "°C"),
        ("High wind", "Warning", Decimal("10.8"), "m/s"), ("Severe condition", "Severe", None, "Snow"),
    ]


@pytest.mark.parametrize(
    "aqi, pm25, pm10, no2, expected",
    [
        (3, 24.999999, 49.9, 199.9, []),
        (4, 25, 50, 200, [("High NO2", "Warning"), ("High PM10", "Warning"), ("High PM2.5", "Warning"), ("Poor air quality", "Warning")]),
        (5, 50, 100, 400, [("High NO2", "Severe"), ("High PM10", "Severe"), ("High PM2.5", "Severe"), ("Poor air quality", "Severe")]),
    ],
)
def test_pollution_alert_bounds(spark, aqi, pm25, pm10, no2, expected):
    df = h.staged(spark, "air_pollution", ("2026-01-05 10:00:00", "A", h.pollution(("2026-01-05 09:00:00", aqi, pm25, pm10, no2))))
    fact = m.pollution_hourly_fact(m.hourly_pollution(df))
    assert h.rows(m.pollution_alerts(fact), "alert_type", "severity") == expected


def test_alerts_scan_input_once(spark):
    df = h.staged(spark, "air_pollution", ("2026-01-05 10:00:00", "A", h.pollution(("2026-01-05 09:00:00", 4, 1, 1, 1))))
    plan = m.pollution_alerts(m.pollution_hourly_fact(df.withColumns({
        "city_hour_key": F.lit("x"), "date_utc": F.to_date("observed_at"), "hour_utc": F.hour("observed_at")
    })))._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Exchange" not in plan


def test_accuracy_scores_matured_only(spark):
    fc = h.staged(
        spark, "weather_forecast",
        ("2026-01-05 10:00:00", "A", h.forecast(("2026-01-05 12:00:00", 20.0, 0.5, 1, "Rain"), ("2026-01-05 09:40:00", 20.0, 0.1, 1, "Clear"),
                                               ("2026-01-05 09:00:00", 20.0, 0.1, 1, "Clear"), ("2026-01-06 12:00:00", 20.0, 0.5, 1, "Rain"))),
    )
    wx = h.staged(
        spark, "current_weather", ("2026-01-05 13:00:00", "A", h.weather("2026-01-05 12:30:00", 22.005, main=None)),
        ("2026-01-05 10:00:00", "A", h.weather("2026-01-05 09:30:00", 22.0, "Clear", rain=0.2)),
    )
    scored = m.forecast_accuracy(m.forecast_history(fc), m.hourly_weather(wx), datetime(2026, 1, 6))
    got = h.rows(scored, "forecast_at", "temp_bias", "temp_within_2c", "rain_correct", "condition_correct", "condition_correct_int")
    assert got == [
        (datetime(2026, 1, 5, 9, 40), Decimal("-2.00"), 1, False, True, 1),
        (datetime(2026, 1, 5, 12), Decimal("-2.01"), 0, False, None, None),
    ]


def _day(city, day, temp):
    return (city, date.fromisoformat(day), Decimal(temp))


def test_row_based_frames_over_missing_days(spark):
    days = [f"2026-01-{d:02d}" for d in (1, 2, 3, 5, 8, 9, 20, 21)]
    df = spark.createDataFrame([_day("A", x, str(i + 1)) for i, x in enumerate(days)], "city string, date_utc date, avg_temp_celsius decimal(18,2)")
    out = m.temperature_trends(df.withColumns({"min_temp_celsius": F.col("avg_temp_celsius"), "max_temp_celsius": F.col("avg_temp_celsius")}))
    last = out.orderBy(F.desc("date_utc")).first()
    assert last["temp_7d_avg"] == Decimal("5.00") and last["temp_30d_avg"] == Decimal("4.50")
    assert last["dod_change"] == Decimal("1.00") and last["wow_change"] == Decimal("7.00")


def test_wide_table_keeps_partial_days(spark):
    wx = h.staged(spark, "current_weather", ("2026-01-05 10:00:00", "A", h.weather("2026-01-05 09:00:00", 15.0)))
    po = h.staged(spark, "air_pollution", ("2026-01-05 10:00:00", "A", h.pollution(("2026-01-05 09:00:00", 3, 1, 1, 1))),
                  ("2026-01-05 10:00:00", "B", h.pollution(("2026-01-05 09:00:00", 1, 1, 1, 1))))
    fl = h.staged(spark, "traffic_flow", ("2026-01-05 10:00:00", "C", h.flow(20, 40)))
    hourly, flow = m.hourly_weather(wx), m.hourly_traffic_flow(fl)
    none = m.traffic_incidents(h.staged(spark, "traffic_incidents", ("2026-01-05 10:00:00", "Z", h.incidents(("i", 1, 1)))))
    wide = m.city_daily(m.weather_daily(hourly), m.pollution_daily(m.hourly_pollution(po)), m.traffic_daily(flow, none), m.dim_city(hourly, flow))
    got = h.rows(wide, "city", "country", "norm_temp", "comfort_index", "comfort_index_label", "congestion_label", "aqi_alert")
    assert got == [
        ("A", "DE", Decimal("0.500"), Decimal("0.500"), "Good", "No data", False),
        ("B", None, Decimal("0.000"), Decimal("0.500"), "Good", "No data", False),
        ("C", None, Decimal("0.000"), None, "No data", "High", None),
    ]


def test_two_countries_in_a_day_break_uniqueness(spark):
    df = h.staged(
        spark, "current_weather", ("2026-01-05 10:00:00", "A", h.weather("2026-01-05 09:00:00", country="DE")),
        ("2026-01-05 11:00:00", "A", h.weather("2026-01-05 10:00:00", country="FR")),
    )
    daily = m.weather_daily(m.hourly_weather(df))
    assert daily.count() == 2
    assert checks.duplicate_keys(daily, "city_date_key").count() == 1


def test_calendar_and_hours(spark):
    days = dims.dim_date(spark, date(2026, 1, 1), date(2027, 1, 1))
    assert days.count() == 366
    first = days.filter("date_key = 20260101").first()
    assert (first["month_name"], first["day_name"], first["day_of_week"], first["week_of_year"], first["is_weekend"]) == (
        "January", "Thursday", 4, 1, False,
    )
    hours = h.rows(dims.dim_hour(spark), "hour_utc", "hour_label", "day_part")
    assert len(hours) == 24 and (5, "05:00", "Night") in hours and (6, "06:00", "Morning") in hours and (18, "18:00", "Evening") in hours
