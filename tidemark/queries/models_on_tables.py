"""Every model of the warehouse as a full build over the derived feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import models as m
from tidemark.queries import derived as d
from tidemark.queries.oracle import model_sql, nullable
from tidemark.queries.registry import query, stored

Build = Callable[[SparkSession, str], DataFrame]


def staging(feed: str) -> Build:
    return lambda spark, sf: d.staged(spark, sf, feed)


def composed(build: Callable[..., DataFrame], *inputs: str, **extra) -> Build:
    return lambda spark, sf: build(*[MODELS[i](spark, sf) for i in inputs], **extra)


MODELS: dict[str, Build] = {
    **{f"stg_{feed}": staging(feed) for feed in d.BUILDERS},
    "int_city_hourly_weather": composed(m.hourly_weather, "stg_current_weather"),
    "int_city_hourly_pollution": composed(m.hourly_pollution, "stg_air_pollution"),
    "int_city_hourly_traffic_flow": composed(m.hourly_traffic_flow, "stg_traffic_flow"),
    "int_city_hourly_traffic_incidents": composed(m.traffic_incidents, "stg_traffic_incidents"),
    "int_city_weather_forecast": composed(m.forecast_history, "stg_weather_forecast"),
    "dim_city": lambda spark, sf: m.dim_city(
        MODELS["int_city_hourly_weather"](spark, sf), d.covered(spark, sf, MODELS["int_city_hourly_traffic_flow"](spark, sf))
    ),
    "fct_weather_daily": composed(m.weather_daily, "int_city_hourly_weather"),
    "fct_pollution_daily": composed(m.pollution_daily, "int_city_hourly_pollution"),
    "fct_traffic_daily": composed(m.traffic_daily, "int_city_hourly_traffic_flow", "int_city_hourly_traffic_incidents"),
    "fct_weather_hourly": composed(m.weather_hourly_fact, "int_city_hourly_weather"),
    "fct_pollution_hourly": composed(m.pollution_hourly_fact, "int_city_hourly_pollution"),
    "fct_traffic_hourly": composed(m.traffic_hourly_fact, "int_city_hourly_traffic_flow"),
    "fct_forecast_accuracy": composed(
        m.forecast_accuracy, "int_city_weather_forecast", "int_city_hourly_weather", as_of=d.AS_OF
    ),
    "mart_city_daily": lambda spark, sf: wide_city_day(spark, sf),
    "mart_forecast_latest": composed(m.forecast_latest, "int_city_weather_forecast", as_of=d.AS_OF),
    "mart_temperature_trends": composed(m.temperature_trends, "fct_weather_daily"),
    "mart_weather_alerts": composed(m.weather_alerts, "mart_forecast_latest"),
    "mart_pollution_alerts": composed(m.pollution_alerts, "fct_pollution_hourly"),
}


def wide_city_day(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table over stored hourly facts: the city dimension and the daily facts share them."""
    weather = stored(MODELS["int_city_hourly_weather"](spark, sf), "hourly-weather")
    flow = stored(MODELS["int_city_hourly_traffic_flow"](spark, sf), "hourly-flow")
    incidents = MODELS["int_city_hourly_traffic_incidents"](spark, sf)
    return m.city_daily(
        m.weather_daily(weather),
        MODELS["fct_pollution_daily"](spark, sf),
        m.traffic_daily(flow, incidents),
        m.dim_city(weather, d.covered(spark, sf, flow)),
    )


for _name, _build in MODELS.items():
    query(_name, model_sql(_name), nullable(_name))(_build)
