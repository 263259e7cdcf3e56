"""Config tables: sources, streams, locations, links, field mappings, validation rules.

They are ordinary DataFrames of tens to hundreds of rows. The seed rows are fixed values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.mappings import FIELD_MAPPINGS, Mapping

SYNC_MODE = "full_refresh_append"
SCHEDULE = "0 * * * *"

# The two APIs, their feeds, and the cities with coordinates and traffic boxes.
SOURCES = {
    "openweather": ("OpenWeather Free 2.5", "OPENWEATHER_API_KEY", "appid",
                    ["current_weather", "air_pollution", "weather_forecast"]),
    "tomtom": ("TomTom Traffic", "TOMTOM_API_KEY", "api_key", ["traffic_flow", "traffic_incidents"]),
}
CITIES = {
    "Skopje": ("41.9981", "21.4321"),
    "Berlin": ("52.5200", "13.4050"),
    "London": ("51.5074", "-0.1278"),
    "Amsterdam": ("52.3676", "4.9041"),
    "Belgrade": ("44.7866", "20.4489"),
    "Brussels": ("50.8503", "4.3517"),
    "Barcelona": ("41.3874", "2.1686"),
    "Prilep": ("41.3442", "21.5544"),
    "Bitola": ("41.0314", "21.3347"),
    "Ohrid": ("41.1231", "20.8016"),
}
TRAFFIC_BOXES = {
    "London": ("51.40", "-0.25", "51.60", "0.00"),
    "Berlin": ("52.40", "13.20", "52.65", "13.65"),
    "Amsterdam": ("52.28", "4.75", "52.45", "5.05"),
    "Belgrade": ("44.70", "20.35", "44.87", "20.55"),
    "Brussels": ("50.78", "4.25", "50.92", "4.45"),
    "Barcelona": ("41.32", "2.08", "41.46", "2.25"),
}
# Fixed values: (stream, column, rule, bound, severity, description).
RULES = [
    ("current_weather", None, "min_row_count", "1", "error", "a sync brings weather rows"),
    ("current_weather", "temp_celsius", "min", "-60", "warn", "air temperature is plausible"),
    ("current_weather", "temp_celsius", "max", "60", "warn", "air temperature is plausible"),
    ("current_weather", "humidity_pct", "max", "100", "warn", "humidity is a percentage"),
    ("current_weather", None, "freshness_minutes", "120", "warn", "newest extract is recent"),
    ("air_pollution", None, "min_row_count", "1", "error", "a sync brings pollution rows"),
    ("air_pollution", "aqi", "accepted_values", "[1,2,3,4,5]", "error", "AQI is on its scale"),
    ("weather_forecast", None, "min_row_count", "1", "error", "a sync brings forecast rows"),
    ("weather_forecast", "temp_celsius", "min", "-60", "warn", "forecast temperature is plausible"),
    ("weather_forecast", "temp_celsius", "max", "60", "warn", "forecast temperature is plausible"),
    ("traffic_flow", None, "min_row_count", "1", "error", "a sync brings flow rows"),
    ("traffic_flow", "current_speed_kmh", "min", "0", "warn", "speed is not negative"),
    ("traffic_incidents", "magnitude_of_delay", "accepted_values", "[0,1,2,3,4]", "warn", "magnitude is on its scale"),
]

SCHEMAS = {
    "sources": "source_id int, source_name string, connector_name string, api_key_env string, "
    "api_key_field string, schedule_cron string, is_active boolean, created_at timestamp, updated_at timestamp",
    "streams": "stream_id int, source_id int, stream_name string, target_schema string, target_table string, "
    "sync_mode string, is_active boolean, created_at timestamp, updated_at timestamp",
    "locations": "location_id int, city string, latitude decimal(18,6), longitude decimal(18,6), "
    "is_active boolean, updated_at timestamp",
    "source_locations": "source_id int, location_id int, min_lat decimal(18,6), min_lon decimal(18,6), "
    "max_lat decimal(18,6), max_lon decimal(18,6), is_active boolean, updated_at timestamp",
    "field_mappings": "mapping_id int, stream_id int, target_column string, source_expr string, data_type string, "
    "is_required boolean, is_active boolean, ordinal int, description string, updated_at timestamp",
    "validation_rules": "rule_id int, stream_id int, target_column string, rule_type string, rule_value string, "
    "severity string, is_active boolean, description string, updated_at timestamp",
    "validation_runs": "run_id bigint, run_ts timestamp, pipeline_run_id string, stream_name string, "
    "target_column string, check_type string, status string, rows_checked bigint, null_count bigint, "
    "detail string, resolved boolean, resolved_at timestamp, resolved_note string",
}


class ConfigError(ValueError):
    """A config row breaks a constraint of its table."""


def seed_config(spark: SparkSession, now=None) -> dict[str, DataFrame]:
    """The seeded config tables."""
    source_ids = {name: i for i, name in enumerate(SOURCES, start=1)}
    stream_names = [(source, s) for source, spec in SOURCES.items() for s in spec[3]]
    stream_ids = {s: i for i, (_, s) in enumerate(stream_names, start=1)}
    location_ids = {city: i for i, city in enumerate(CITIES, start=1)}

    def dec(values):
        return [None if v is None else Decimal(v) for v in values]

    links = [("openweather", city, (None,) * 4) for city in CITIES]
    links += [("tomtom", city, box) for city, box in TRAFFIC_BOXES.items()]
    mappings = [(stream_ids[s], m) for s in stream_ids for m in FIELD_MAPPINGS[s]]
    rows = {
        "sources": [
            (source_ids[n], n, spec[0], spec[1], spec[2], SCHEDULE, True, now, now) for n, spec in SOURCES.items()
        ],
        "streams": [
            (stream_ids[s], source_ids[src], s, "staging", s, SYNC_MODE, True, now, now) for src, s in stream_names
        ],
        "locations": [(location_ids[c], c, *dec(at), True, now) for c, at in CITIES.items()],
        "source_locations": [(source_ids[s], location_ids[c], *dec(box), True, now) for s, c, box in links],
        "field_mappings": [
            (i, sid, m.target_column, m.source_expr, m.data_type, m.is_required, m.is_active, m.ordinal, None, now)
            for i, (sid, m) in enumerate(mappings, start=1)
        ],
        "validation_rules": [
            (i, stream_ids[r[0]], r[1], r[2], r[3], r[4], True, r[5], now) for i, r in enumerate(RULES, start=1)
        ],
        "validation_runs": [],
    }
    return {name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in SCHEMAS}


def active_streams(config: dict[str, DataFrame]) -> DataFrame:
    """Active streams of active sources, by name."""
    on = config["sources"].filter("is_active").select("source_id", "source_name")
    streams = config["streams"].filter("is_active")
    return streams.join(on, "source_id").orderBy("stream_name")


def active_rules(config: dict[str, DataFrame], stream: str) -> DataFrame:
    """Active rules of a stream, stream-level rules first."""
    stream_id = config["streams"].filter(F.col("stream_name") == stream).select("stream_id")
    rules = config["validation_rules"].filter("is_active").join(stream_id, "stream_id")
    return rules.orderBy(F.asc_nulls_first("target_column"), "rule_type")


def ordered_rules(config: dict[str, DataFrame]) -> DataFrame:
    """Active rules of all active streams with their position: stream-level rules (no column) come first."""
    streams = active_streams(config).select("stream_id", "stream_name")
    rules = config["validation_rules"].filter("is_active").join(streams, "stream_id")
    order = Window.partitionBy("stream_name").orderBy(F.asc_nulls_first("target_column"), "rule_type", "rule_id")
    return rules.withColumn("position", F.row_number().over(order))


def active_locations(config: dict[str, DataFrame], source: str | None = None) -> DataFrame:
    """Active cities of a source, or of every active one, with their bounding boxes."""
    named = F.lit(True) if source is None else F.col("source_name") == source
    source_id = config["sources"].filter(named & F.col("is_active")).select("source_id", *(["source_name"] if source is None else []))
    links = config["source_locations"].filter("is_active").drop("updated_at").join(source_id, "source_id")
    cities = config["locations"].filter("is_active").select("location_id", "city", "latitude", "longitude")
    return links.drop("is_active").join(cities, "location_id").orderBy("city")


def all_mappings(config: dict[str, DataFrame], stream: str) -> list[Mapping]:
    """All mapping rows of one stream; a stream has a few dozen, so they are read to the driver."""
    stream_id = config["streams"].filter(F.col("stream_name") == stream).select("stream_id")
    rows = config["field_mappings"].join(stream_id, "stream_id").orderBy("ordinal")
    return [Mapping(*r) for r in rows.select(*Mapping._fields).collect()]


def mapping_violations(mappings: DataFrame) -> DataFrame:
    """A required field may not be inactive: dropping its column would break the models."""
    return mappings.filter(F.col("is_required") & ~F.col("is_active"))


def rule_violations(rules: DataFrame) -> DataFrame:
    """Rules whose severity or type is outside the domain of the table."""
    from tidemark.operators.contract import RULE_TYPES, SEVERITIES

    return rules.filter(~F.col("severity").isin(*SEVERITIES) | ~F.col("rule_type").isin(*RULE_TYPES))


def check_config(config: dict[str, DataFrame]) -> None:
    """Raise when a config row breaks a table constraint."""
    bad = [r["target_column"] for r in mapping_violations(config["field_mappings"]).select("target_column").collect()]
    if bad:
        raise ConfigError(f"required fields are inactive: {', '.join(bad)}")
    bad = [r["rule_type"] for r in rule_violations(config["validation_rules"]).select("rule_type").collect()]
    if bad:
        raise ConfigError(f"rules outside their domain: {', '.join(bad)}")
