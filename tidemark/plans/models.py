"""The models: hourly facts, issuance history, dimensions, daily facts, one-big-table and analytics.

Each is a function from DataFrames to a DataFrame that describes the full build. Incremental
runs give the same functions restricted inputs (see ``warehouse``).
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import labels
from tidemark.functions.keys import date_key, surrogate_key
from tidemark.functions.measures import (
    avg_rounded,
    comfort_index,
    comfort_parts,
    max_rounded,
    min_rounded,
    most_frequent,
    rounded,
    share_rounded,
    sum_or_zero,
)
from tidemark.functions.times import hour_of, lead_time_bucket, lead_time_hours, naive_utc, ntz
from tidemark.operators.alerts import AlertRule, at_least, at_most, one_of, threshold_alerts
from tidemark.operators.dedupe import Ranking, keep_latest
from tidemark.operators.rollup import distinct_counts, mode_and_means
from tidemark.operators.trends import previous, prior_avg, rolling_avg

CITY_DAY = ("city", "date_utc")
TIME_COLUMNS = ("observed_at", "date_utc", "hour_utc", "extracted_at")

WEATHER_MEASURES = (
    "temp_celsius", "feels_like_celsius", "temp_min_celsius", "temp_max_celsius", "humidity_pct", "pressure_hpa",
    "wind_speed_ms", "wind_gust_ms", "weather_main", "weather_description", "cloudiness_pct", "visibility_m",
    "rain_1h_mm", "snow_1h_mm",
)
POLLUTION_MEASURES = (
    "aqi", "aqi_label", "co_ug_m3", "no_ug_m3", "no2_ug_m3", "o3_ug_m3", "so2_ug_m3", "pm2_5_ug_m3",
    "pm10_ug_m3", "nh3_ug_m3",
)
FLOW_MEASURES = (
    "road_class", "road_closure", "current_speed_kmh", "free_flow_speed_kmh", "current_travel_time_sec",
    "free_flow_travel_time_sec", "congestion_score", "confidence",
)
INCIDENT_MEASURES = (
    "feature_type", "road_from", "road_to", "started_at", "ends_at", "magnitude_of_delay", "delay_severity",
    "delay_sec", "length_m", "category_id", "number_of_reports",
)
FORECAST_MEASURES = (
    "temp_celsius", "feels_like_celsius", "precipitation_probability", "weather_main", "wind_speed_ms",
    "humidity_pct", "rain_3h_mm",
)

_HOUR = ("city", "date_utc", "hour_utc")
_FRESHEST = ("observed_at", "extracted_at")
WEATHER_RANK = Ranking(_HOUR, _FRESHEST, ("temp_celsius",))
POLLUTION_RANK = Ranking(_HOUR, _FRESHEST, ("pm2_5_ug_m3",))
FLOW_RANK = Ranking(_HOUR, _FRESHEST, ("current_speed_kmh", "free_flow_speed_kmh", "confidence"))
INCIDENT_RANK = Ranking(("city", "incident_id", "observed_at"), ("extracted_at",), ("delay_sec", "length_m"))
ISSUANCE_RANK = Ranking(
    ("city", "forecast_at", "issued_at"), ("issued_at",), ("temp_celsius", "precipitation_probability")
)


def city_hour_key() -> Column:
    return surrogate_key("city", hour_of("observed_at"))


def incident_key() -> Column:
    return surrogate_key("city", "incident_id", "observed_at")


def issuance_key() -> Column:
    return surrogate_key("city", "forecast_at", "issued_at")


# ---- intermediate -------------------------------------------------------------------------------


def observed_rows(staged: DataFrame, identity: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    return staged.filter(F.col("city").isNotNull()).select(
        "city",
        *identity,
        "observed_at",
        F.to_date("observed_at").alias("date_utc"),
        F.hour("observed_at").alias("hour_utc"),
        "extracted_at",
        *measures,
    )


def _keyed(rows: DataFrame, ranking: Ranking, name: str, key: Column) -> DataFrame:
    """Latest row per grain; the key is hashed for the winners only."""
    return keep_latest(rows, ranking).select(key.alias(name), "*")


def hourly_weather(staged: DataFrame) -> DataFrame:
    rows = observed_rows(staged, ("country", "latitude", "longitude"), WEATHER_MEASURES)
    return _keyed(rows, WEATHER_RANK, "city_hour_key", city_hour_key())


def hourly_pollution(staged: DataFrame) -> DataFrame:
    return _keyed(observed_rows(staged, (), POLLUTION_MEASURES), POLLUTION_RANK, "city_hour_key", city_hour_key())


def hourly_traffic_flow(staged: DataFrame) -> DataFrame:
    return _keyed(observed_rows(staged, (), FLOW_MEASURES), FLOW_RANK, "city_hour_key", city_hour_key())


def traffic_incidents(staged: DataFrame) -> DataFrame:
    """One row per incident and sync. Features without an id cannot be keyed."""
    rows = observed_rows(staged.filter(F.col("incident_id").isNotNull()), ("incident_id",), INCIDENT_MEASURES)
    return _keyed(rows, INCIDENT_RANK, "city_incident_key", incident_key())


def forecast_history(staged: DataFrame) -> DataFrame:
    """Every prediction as it was issued, with its lead time."""
    rows = staged.filter(F.col("city").isNotNull()).select(
        "city", "forecast_at", naive_utc("extracted_at").alias("issued_at"), *FORECAST_MEASURES
    )
    return keep_latest(rows, ISSUANCE_RANK).select(
        issuance_key().alias("forecast_key"),
        "city",
        "forecast_at",
        "issued_at",
        lead_time_hours("forecast_at", "issued_at").alias("lead_time_hours"),
        lead_time_bucket("forecast_at", "issued_at").alias("lead_time_bucket"),
        F.to_date("forecast_at").alias("forecast_date_utc"),
        F.hour("forecast_at").alias("forecast_hour_utc"),
        *FORECAST_MEASURES,
    )


# ---- dimensions ---------------------------------------------------------------------------------


def dim_city(weather: DataFrame, flow: DataFrame) -> DataFrame:
    """Cities seen in the weather facts, with coordinates and a flag for traffic coverage."""
    cities = mode_and_means(
        weather.filter(F.col("city").isNotNull()),
        ["city"],
        ("country", "country"),
        {"latitude": ("latitude", 4), "longitude": ("longitude", 4)},
    )
    covered = flow.filter(F.col("city").isNotNull()).select(F.col("city").alias("_covered")).distinct()
    return cities.join(covered, F.col("city") == F.col("_covered"), "left").select(
        surrogate_key("city").alias("city_key"),
        "city",
        "country",
        "latitude",
        "longitude",
        F.lit(True).alias("has_weather_data"),
        F.col("_covered").isNotNull().alias("has_traffic_data"),
    )


# ---- facts --------------------------------------------------------------------------------------


def _daily_keys(df: DataFrame) -> DataFrame:
    return df.select(
        surrogate_key("city", "date_utc").alias("city_date_key"),
        surrogate_key("city").alias("city_key"),
        date_key("date_utc").alias("date_key"),
        "*",
    )


def weather_daily(hourly: DataFrame) -> DataFrame:
    daily = hourly.groupBy("city", "country", "date_utc").agg(
        avg_rounded("temp_celsius", 2).alias("avg_temp_celsius"),
        min_rounded("temp_celsius", 2).alias("min_temp_celsius"),
        max_rounded("temp_celsius", 2).alias("max_temp_celsius"),
        avg_rounded("feels_like_celsius", 2).alias("avg_feels_like_celsius"),
        avg_rounded("humidity_pct", 1).alias("avg_humidity_pct"),
        avg_rounded("pressure_hpa", 1).alias("avg_pressure_hpa"),
        avg_rounded("wind_speed_ms", 2).alias("avg_wind_speed_ms"),
        max_rounded("wind_speed_ms", 2).alias("max_wind_speed_ms"),
        sum_or_zero("rain_1h_mm", 2).alias("total_rain_mm"),
        sum_or_zero("snow_1h_mm", 2).alias("total_snow_mm"),
        avg_rounded("cloudiness_pct", 1).alias("avg_cloudiness_pct"),
        most_frequent("weather_main").alias("dominant_weather_main"),
        F.count(F.lit(1)).alias("observation_count"),
    )
    return _daily_keys(daily)


def pollution_daily(hourly: DataFrame) -> DataFrame:
    daily = hourly.groupBy(*CITY_DAY).agg(
        avg_rounded("aqi", 2).alias("avg_aqi"),
        F.max("aqi").alias("max_aqi"),
        F.min("aqi").alias("min_aqi"),
        avg_rounded("pm2_5_ug_m3", 2).alias("avg_pm2_5_ug_m3"),
        max_rounded("pm2_5_ug_m3", 2).alias("max_pm2_5_ug_m3"),
        avg_rounded("pm10_ug_m3", 2).alias("avg_pm10_ug_m3"),
        max_rounded("pm10_ug_m3", 2).alias("max_pm10_ug_m3"),
        avg_rounded("no2_ug_m3", 2).alias("avg_no2_ug_m3"),
        avg_rounded("o3_ug_m3", 2).alias("avg_o3_ug_m3"),
        avg_rounded("co_ug_m3", 2).alias("avg_co_ug_m3"),
        avg_rounded("so2_ug_m3", 2).alias("avg_so2_ug_m3"),
        F.count_if(F.col("aqi") >= 4).alias("hours_poor_air"),
        F.count(F.lit(1)).alias("observation_count"),
    )
    return _daily_keys(daily)


def traffic_daily(flow: DataFrame, incidents: DataFrame) -> DataFrame:
    """Flow per city and day with incident counts; days without incidents stay."""
    flows = flow.groupBy(*CITY_DAY).agg(
        avg_rounded("congestion_score", 3).alias("avg_congestion_score"),
        max_rounded("congestion_score", 3).alias("max_congestion_score"),
        avg_rounded("current_speed_kmh", 1).alias("avg_current_speed_kmh"),
        avg_rounded("free_flow_speed_kmh", 1).alias("avg_free_flow_speed_kmh"),
        share_rounded(F.col("congestion_score") > F.lit("0.3").cast("decimal(2,1)"), 3).alias("pct_congested_snapshots"),
        F.count_if("road_closure").alias("road_closure_count"),
        F.count(F.lit(1)).alias("flow_observation_count"),
    )
    counts = distinct_counts(
        incidents,
        CITY_DAY,
        "incident_id",
        F.col("magnitude_of_delay") == 3,
        "delay_sec",
        0,
        ("total_incidents", "major_incidents", "avg_delay_sec"),
    )
    none = F.lit(0)
    both = flows.join(counts, list(CITY_DAY), "left").select(
        *flows.columns,
        F.coalesce("total_incidents", none).alias("total_incidents"),
        F.coalesce("major_incidents", none).alias("major_incidents"),
        "avg_delay_sec",
    )
    return _daily_keys(both)


def _hourly_fact(hourly: DataFrame, identity: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    return hourly.select(
        "city_hour_key",
        surrogate_key("city").alias("city_key"),
        date_key("date_utc").alias("date_key"),
        "hour_utc",
        "city",
        *identity,
        "date_utc",
        "observed_at",
        *measures,
    )


def weather_hourly_fact(hourly: DataFrame) -> DataFrame:
    return _hourly_fact(hourly, ("country",), WEATHER_MEASURES)


def pollution_hourly_fact(hourly: DataFrame) -> DataFrame:
    return _hourly_fact(hourly, (), POLLUTION_MEASURES)


def traffic_hourly_fact(flow: DataFrame) -> DataFrame:
    kept = ("congestion_score", "current_speed_kmh", "free_flow_speed_kmh", "road_closure", "confidence")
    return _hourly_fact(flow, (), kept)


# Rain is predicted from this probability on; a hit is within this many degrees.
RAIN_PROBABILITY = "0.5"
TEMPERATURE_HIT = 2


def forecast_accuracy(forecast: DataFrame, weather: DataFrame, as_of: datetime) -> DataFrame:
    """Score every matured issuance against what was observed in its target hour."""
    # the date bound is implied by the time bound; it skips partitions of the stored history
    matured = forecast.filter(
        (F.col("forecast_at") < ntz(as_of))
        & (F.col("forecast_date_utc") <= F.lit(as_of.date()))
        & (F.col("lead_time_hours") >= 0)
    )
    actual = weather.groupBy("city", hour_of("observed_at").alias("_hour")).agg(
        avg_rounded("temp_celsius", 2).alias("actual_temp_celsius"),
        sum_or_zero("rain_1h_mm", 2).alias("actual_rain_mm"),
        most_frequent("weather_main").alias("actual_weather_main"),
    )
    return forecast_scores(matured.withColumn("_hour", hour_of("forecast_at")).join(actual, ["city", "_hour"]))


def forecast_scores(paired: DataFrame) -> DataFrame:
    """Errors and hits of predictions next to what was observed in their target hour."""
    gap = F.col("temp_celsius") - F.col("actual_temp_celsius")
    predicted_rain = F.col("precipitation_probability") >= F.lit(RAIN_PROBABILITY).cast("decimal(2,1)")
    rained = F.col("actual_rain_mm") > 0
    rain_ok = predicted_rain == rained
    condition_ok = F.col("weather_main") == F.col("actual_weather_main")
    return paired.select(
        "forecast_key",
        surrogate_key("city").alias("city_key"),
        date_key("forecast_at").alias("date_key"),
        "city",
        "forecast_at",
        "issued_at",
        "lead_time_hours",
        "lead_time_bucket",
        F.col("temp_celsius").alias("predicted_temp_celsius"),
        "actual_temp_celsius",
        rounded(gap, 2).alias("temp_bias"),
        rounded(F.abs(gap), 2).alias("temp_abs_error"),
        "precipitation_probability",
        predicted_rain.alias("predicted_rain"),
        rained.alias("actually_rained"),
        rain_ok.alias("rain_correct"),
        "actual_rain_mm",
        F.col("weather_main").alias("predicted_weather_main"),
        "actual_weather_main",
        condition_ok.alias("condition_correct"),
        rain_ok.cast("int").alias("rain_correct_int"),
        condition_ok.cast("int").alias("condition_correct_int"),
        (F.abs(gap) <= TEMPERATURE_HIT).cast("int").alias("temp_within_2c"),
    )


# ---- marts --------------------------------------------------------------------------------------

_BY, _AT = ("city",), "date_utc"


def one_row_per(grain: list[str], *facts: DataFrame) -> DataFrame:
    """Facts with at most one row per grain, side by side: one scan of each and one exchange for all."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)
    return stacked.groupBy(*grain).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in grain])


def city_daily(weather: DataFrame, pollution: DataFrame, traffic: DataFrame, cities: DataFrame) -> DataFrame:
    """One wide row per city and day: the three daily facts, a comfort score, labels and trend.

    Each fact is read once. Pollution and traffic have one row per city and day and share one aggregate;
    weather may repeat a day (one row per country), so it joins them, which keeps the repeats.
    """
    grain = list(CITY_DAY)
    air = pollution.select(*grain, "avg_aqi", "max_aqi", "avg_pm2_5_ug_m3", "avg_pm10_ug_m3", "hours_poor_air")
    roads = traffic.select(*grain, "avg_congestion_score", "avg_current_speed_kmh", "total_incidents", "major_incidents")
    others = one_row_per(grain, air, roads)
    wide = (
        weather.select(*grain, "avg_temp_celsius", "min_temp_celsius", "max_temp_celsius", "avg_humidity_pct",
                       "total_rain_mm", "dominant_weather_main")
        .join(others, grain, "full")
        .join(cities.select("city", "country"), "city", "left")
    )
    temp, aqi, flow = comfort_parts(F.col("avg_temp_celsius"), F.col("avg_aqi"), F.col("avg_congestion_score"))
    scored = wide.withColumns({"norm_temp": temp, "norm_aqi": aqi, "norm_traffic": flow})
    scored = scored.withColumn("comfort_index", comfort_index(F.col("norm_temp"), F.col("norm_aqi"), F.col("norm_traffic")))
    trended = scored.withColumns({
        "rolling_7d_comfort": rolling_avg("comfort_index", 7, 3, _BY, _AT),
        "prior_7d_comfort": prior_avg("comfort_index", 7, 3, _BY, _AT),
    })
    comfort = F.col("comfort_index")
    return _daily_keys(trended.select(
        "city", "country", "date_utc", "avg_temp_celsius", "min_temp_celsius", "max_temp_celsius", "avg_humidity_pct",
        "total_rain_mm", "dominant_weather_main", "avg_aqi", "max_aqi", "avg_pm2_5_ug_m3", "avg_pm10_ug_m3",
        "hours_poor_air", "avg_congestion_score", "avg_current_speed_kmh", "total_incidents", "major_incidents",
        *[rounded(F.col(c), 3).alias(c) for c in ("norm_temp", "norm_aqi", "norm_traffic")],
        comfort,
        comfort.alias("livability_score"),
        labels.comfort_label(comfort).alias("comfort_index_label"),
        labels.congestion_label(F.col("avg_congestion_score")).alias("congestion_label"),
        (F.col("hours_poor_air") >= 3).alias("aqi_alert"),
        "rolling_7d_comfort",
        "prior_7d_comfort",
        labels.trend_label(F.col("rolling_7d_comfort"), F.col("prior_7d_comfort")).alias("comfort_trend"),
    ))


def forecast_latest(forecast: DataFrame, as_of: datetime) -> DataFrame:
    """Newest prediction of every slot that has not passed yet."""
    this_hour = as_of.replace(minute=0, second=0, microsecond=0)
    ahead = forecast.filter(
        (F.col("forecast_at") >= ntz(this_hour)) & (F.col("forecast_date_utc") >= F.lit(this_hour.date()))
    )
    # (city, forecast_at, issued_at) is the key of the history, so newest issuance decides alone
    newest = keep_latest(ahead, Ranking(("city", "forecast_at"), ("issued_at",), total=True))
    return newest.select(
        surrogate_key("city", "forecast_at").alias("forecast_slot_key"),
        surrogate_key("city").alias("city_key"),
        "city", "forecast_at", "forecast_date_utc", "forecast_hour_utc", "issued_at", "lead_time_hours",
        *FORECAST_MEASURES,
    )


def temperature_trends(weather: DataFrame) -> DataFrame:
    """Rolling baselines, anomaly against the 30-row mean, and changes to 1 and 7 rows before."""
    temp = F.col("avg_temp_celsius")
    days = weather.select("city", "date_utc", "avg_temp_celsius", "min_temp_celsius", "max_temp_celsius").withColumns({
        "temp_7d_avg": rolling_avg("avg_temp_celsius", 7, 2, _BY, _AT),
        "temp_30d_avg": rolling_avg("avg_temp_celsius", 30, 2, _BY, _AT),
        "_prev_day": previous("avg_temp_celsius", 1, _BY, _AT),
        "_prev_week": previous("avg_temp_celsius", 7, _BY, _AT),
    })
    gap = temp - F.col("temp_30d_avg")
    return _daily_keys(days.select(
        "city", "date_utc", temp, "min_temp_celsius", "max_temp_celsius", "temp_7d_avg", "temp_30d_avg",
        rounded(gap, 2).alias("temp_anomaly"),
        labels.anomaly_label(gap).alias("temp_anomaly_label"),
        rounded(temp - F.col("_prev_day"), 2).alias("dod_change"),
        rounded(temp - F.col("_prev_week"), 2).alias("wow_change"),
    ))


# Alert names, bounds, severe bounds and units.
WEATHER_ALERTS: tuple[AlertRule, ...] = (
    at_least("wind_speed_ms", "10.8", "17.2", "m/s", "High wind"),
    at_least("precipitation_probability", "0.7", None, "prob", "Heavy rain"),
    at_least("temp_celsius", "35", "40", "°C", "Extreme heat"),
    at_most("temp_celsius", "-5", "-10", "°C", "Extreme cold"),
    one_of("weather_main", ("Thunderstorm", "Snow", "Tornado"), "Severe condition"),
)
POLLUTION_ALERTS: tuple[AlertRule, ...] = (
    at_least("aqi", "4", "5", "AQI (1-5)", "Poor air quality"),
    at_least("pm2_5_ug_m3", "25", "50", "µg/m³", "High PM2.5"),
    at_least("pm10_ug_m3", "50", "100", "µg/m³", "High PM10"),
    at_least("no2_ug_m3", "200", "400", "µg/m³", "High NO2"),
)
ALERT_COLUMNS = ("alert_type", "severity", "trigger_value", "trigger_unit")


def _alert_keys(alerts: DataFrame, at: str, extra: tuple[str, ...]) -> DataFrame:
    return alerts.select(
        surrogate_key("city", at, "alert_type").alias("alert_key"),
        surrogate_key("city").alias("city_key"),
        date_key(at).alias("date_key"),
        "city",
        at,
        *extra,
        *ALERT_COLUMNS,
    )


def weather_alerts(latest: DataFrame) -> DataFrame:
    fired = threshold_alerts(latest, WEATHER_ALERTS, ("city", "forecast_at", "lead_time_hours"))
    return _alert_keys(fired, "forecast_at", ("lead_time_hours",))


def pollution_alerts(hourly_fact: DataFrame) -> DataFrame:
    fired = threshold_alerts(hourly_fact, POLLUTION_ALERTS, ("city", "observed_at"))
    return _alert_keys(fired, "observed_at", ())
