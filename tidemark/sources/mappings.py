"""Field mappings: how each feed's record becomes typed columns.

The target names, paths, types and required marks below are fixed values of the feeds;
the expressions are Spark SQL over the record schemas of ``feeds``.
"""

from __future__ import annotations

from typing import NamedTuple

from tidemark.functions.labels import AQI_NAMES, DELAY_NAMES


class Mapping(NamedTuple):
    target_column: str
    source_expr: str
    data_type: str | None = None
    is_required: bool = False
    is_active: bool = True
    ordinal: int = 0


_NUM = "decimal(18,6)"


def _code_case(code: str, names: dict[int, str]) -> str:
    arms = " ".join(f"when {value} then '{name}'" for value, name in names.items())
    return f"case cast({code} as int) {arms} end"


def _epoch(path: str) -> str:
    return f"cast(timestamp_seconds({path}) as timestamp_ntz)"


def _ordered(*rows: tuple) -> list[Mapping]:
    return [Mapping(*row)._replace(ordinal=i) for i, row in enumerate(rows, start=1)]


_READINGS = [
    ("temp_celsius", "main.temp", _NUM, True),
    ("feels_like_celsius", "main.feels_like", _NUM),
    ("temp_min_celsius", "main.temp_min", _NUM),
    ("temp_max_celsius", "main.temp_max", _NUM),
    ("humidity_pct", "main.humidity", "int"),
    ("pressure_hpa", "main.pressure", "int"),
    ("sea_level_pressure_hpa", "main.sea_level", "int"),
    ("ground_level_pressure_hpa", "main.grnd_level", "int"),
    ("wind_speed_ms", "wind.speed", _NUM),
    ("wind_direction_deg", "wind.deg", "int"),
    ("wind_gust_ms", "wind.gust", _NUM),
    ("weather_main", "get(weather, 0).main", "string"),
    ("weather_description", "get(weather, 0).description", "string"),
    ("cloudiness_pct", "clouds.`all`", "int"),
    ("visibility_m", "visibility"),
]

FIELD_MAPPINGS: dict[str, list[Mapping]] = {
    "current_weather": _ordered(
        ("city", "city", None, True),
        ("api_locality", "name"),
        ("latitude", "coord.lat", _NUM),
        ("longitude", "coord.lon", _NUM),
        ("country", "sys.country", "string"),
        *_READINGS,
        ("rain_1h_mm", "rain.`1h`", _NUM),
        ("snow_1h_mm", "snow.`1h`", _NUM),
        ("observed_at", _epoch("dt"), None, True),
        ("sunrise_at", _epoch("sys.sunrise")),
        ("sunset_at", _epoch("sys.sunset")),
        ("timezone_offset_sec", "timezone"),
    ),
    "air_pollution": _ordered(
        ("city", "city", None, True),
        ("aqi", "main.aqi", "int", True),
        ("aqi_label", _code_case("main.aqi", AQI_NAMES)),
        ("co_ug_m3", "components.co", _NUM),
        ("no_ug_m3", "components.no", _NUM),
        ("no2_ug_m3", "components.no2", _NUM),
        ("o3_ug_m3", "components.o3", _NUM),
        ("so2_ug_m3", "components.so2", _NUM),
        ("pm2_5_ug_m3", "components.pm2_5", _NUM, True),
        ("pm10_ug_m3", "components.pm10", _NUM),
        ("nh3_ug_m3", "components.nh3", _NUM),
        ("observed_at", _epoch("dt"), None, True),
    ),
    "weather_forecast": _ordered(
        ("city", "city", None, True),
        ("forecast_at", _epoch("dt"), None, True),
        ("forecast_dt_txt", "dt_txt"),
        ("precipitation_probability", "pop"),
        ("precipitation_probability_pct", f"cast(round(cast(pop as {_NUM}) * 100, 0) as int)"),
        *_READINGS,
        ("rain_3h_mm", "rain.`3h`", _NUM),
        ("snow_3h_mm", "snow.`3h`", _NUM),
        ("day_or_night", "sys.pod", "string"),
    ),
    "traffic_flow": _ordered(
        ("city", "city", None, True),
        ("road_class", "frc"),
        ("road_closure", "roadClosure"),
        ("current_speed_kmh", "currentSpeed", None, True),
        ("free_flow_speed_kmh", "freeFlowSpeed", None, True),
        ("current_travel_time_sec", "currentTravelTime"),
        ("free_flow_travel_time_sec", "freeFlowTravelTime"),
        (
            "congestion_score",
            f"round(1 - cast(currentSpeed as {_NUM}) / nullif(cast(freeFlowSpeed as {_NUM}), 0), 2)",
            "decimal(18,2)",
        ),
        ("confidence", "confidence"),
        ("observed_at", "cast(extracted_at as timestamp_ntz)", None, True),
    ),
    "traffic_incidents": _ordered(
        ("city", "city", None, True),
        ("incident_id", "properties.id", "string", True),
        ("feature_type", "type"),
        ("road_from", "properties.`from`", "string"),
        ("road_to", "properties.`to`", "string"),
        ("started_at", "properties.startTime", "timestamp"),
        ("ends_at", "properties.endTime", "timestamp"),
        ("time_validity", "properties.timeValidity", "string"),
        ("magnitude_of_delay", "properties.magnitudeOfDelay", "int"),
        ("delay_severity", _code_case("properties.magnitudeOfDelay", DELAY_NAMES)),
        ("delay_sec", "properties.delay", "int"),
        ("length_m", "properties.length", _NUM),
        ("category_id", "properties.iconCategory", "int"),
        ("number_of_reports", "properties.numberOfReports", "int"),
        ("probability", "properties.probabilityOfOccurrence", "string"),
        ("geometry", "geometry"),
        ("observed_at", "cast(extracted_at as timestamp_ntz)", None, True),
    ),
}
