"""The five feeds derived from ``events`` and ``customer``, in Spark and in the oracle's SQL.

Every event is one API record of the city ``city-<user_id>``. It is synced twice: at the next full
hour, and an hour later with a slightly higher value, so that dedupe and lookbacks have work to do.
The scalar expressions below mean the same in both engines and are shared; the models are not.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import hour_of, ntz
from tidemark.operators.staging import build_staging
from tidemark.queries.registry import dealt, dealt_in_order, table
from tidemark.sources.feeds import FEEDS
from tidemark.sources.landing import PARTITION
from tidemark.sources.mappings import FIELD_MAPPINGS

AS_OF = datetime(2024, 1, 15, 12, 0)
LEADS = (3, 24, 96)
TRAFFIC_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")

CODE = "case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3 when 'purchase' then 4 else 5 end"
CONDITION = (
    "case when k < 95 then case event_type when 'view' then 'Clear' when 'click' then 'Clouds' "
    "when 'signup' then 'Rain' when 'purchase' then 'Thunderstorm' else 'Snow' end end"
)


def num(expr: str) -> str:
    return f"cast({expr} as decimal(18,6))"


def num_if(when: str, expr: str) -> str:
    return f"case when {when} then {num(expr)} end"


# Column of the flat record -> expression over (event_id, user_id, event_type, city, code, k, v).
WEATHER = {
    "api_locality": "city",
    "latitude": num("user_id * 0.01 + k * 0.00001"),
    "longitude": num("0 - user_id * 0.01 - k * 0.00003"),
    "country": "'N' || cast(length(cast(user_id as string)) as string)",
    "temp_celsius": num("v * 0.1 - 9"),
    "feels_like_celsius": num("v * 0.1 - 10.5"),
    "temp_min_celsius": num("v * 0.1 - 11"),
    "temp_max_celsius": num("v * 0.1 - 7"),
    "humidity_pct": "k",
    "pressure_hpa": "950 + k",
    "sea_level_pressure_hpa": "1000 + k",
    "ground_level_pressure_hpa": "900 + k",
    "wind_speed_ms": num("v * 0.04"),
    "wind_direction_deg": "k * 3",
    "wind_gust_ms": num_if("k >= 50", "v * 0.05"),
    "weather_main": CONDITION,
    "weather_description": f"lower({CONDITION})",
    "cloudiness_pct": "k",
    "visibility_m": "k * 100",
    "rain_1h_mm": num_if("k < 40", "k * 0.1"),
    "snow_1h_mm": num_if("k >= 90", "v * 0.01"),
    "timezone_offset_sec": "k * 60",
}
POLLUTION = {
    "aqi": "code",
    "co_ug_m3": num("v * 1.5"),
    "no_ug_m3": num("v * 0.01"),
    "no2_ug_m3": num("v * 0.9"),
    "o3_ug_m3": num("v * 0.3"),
    "so2_ug_m3": num("v * 0.1"),
    "pm2_5_ug_m3": num("v * 0.2"),
    "pm10_ug_m3": num("v * 0.4"),
    "nh3_ug_m3": num_if("k >= 10", "v * 0.05"),
}
FORECAST = {
    "precipitation_probability": num("k * 0.01"),
    **{c: e for c, e in WEATHER.items() if c in (
        "temp_celsius", "feels_like_celsius", "temp_min_celsius", "temp_max_celsius", "humidity_pct", "pressure_hpa",
        "sea_level_pressure_hpa", "ground_level_pressure_hpa", "wind_speed_ms", "wind_direction_deg", "wind_gust_ms",
        "weather_main", "weather_description", "cloudiness_pct", "visibility_m",
    )},
    "rain_3h_mm": num_if("k < 50", "k * 0.2"),
    "snow_3h_mm": num_if("k >= 90", "v * 0.02"),
    "day_or_night": "case when k < 50 then 'd' else 'n' end",
}
FLOW = {
    "road_class": "'FRC' || cast(code as string)",
    "road_closure": "k >= 95",
    "current_speed_kmh": "k",
    "free_flow_speed_kmh": "k + (code - 1) * 5",
    "current_travel_time_sec": "100 + k",
    "free_flow_travel_time_sec": "90 + k",
    "confidence": num("v * 0.001"),
}
INCIDENT = {
    "incident_id": "case when k < 98 then 'inc-' || cast(user_id as string) || '-' || event_type end",
    "feature_type": "'Feature'",
    "road_from": "'from-' || cast(k as string)",
    "road_to": "'to-' || cast(code as string)",
    "time_validity": "case when k < 80 then 'present' else 'future' end",
    "magnitude_of_delay": "case when k = 97 then 9 else code - 1 end",
    "delay_sec": "case when k >= 5 then k * 10 end",
    "length_m": num("v"),
    "category_id": "code * 2",
    "number_of_reports": "k",
    "probability": "case when k < 50 then 'certain' else 'probable' end",
    "geometry": "'{\"type\":\"Point\"}'",
}


def syncs(
    spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None, in_order: bool = False
) -> DataFrame:
    """Every event in both of its syncs, from one scan of the table; or those extracted from ``since`` to before ``until``.

    An event is extracted less than an hour to two hours after it, so events outside are left out in the scan.
    With ``in_order`` a task has a range of time, by extract date, so that it can write the days it has as they are.
    """
    ts = F.col("ts").cast("timestamp_ntz")
    value = F.col("value").cast("decimal(18,2)")
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("n")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value", "props")
    if since is not None:
        events = events.filter(ts >= ntz(since - timedelta(hours=2)))
    if until is not None:
        events = events.filter(ts < ntz(until))
    base = (dealt_in_order(events, "ts", "event_id") if in_order else dealt(events, "event_id", "ts")).select(
        "event_id", "user_id", "event_type", ts.alias("ts"), F.get_json_object("props", "$.k").cast("int").alias("k"),
        value.alias("value"), both,
    )
    every = base.select(
        "event_id", "user_id", "event_type", "ts", "k", "n",
        F.concat(F.lit("e"), F.col("event_id").cast("string"), F.lit("-"), F.col("n").cast("string")).alias("raw_id"),
        F.concat(F.lit("city-"), F.col("user_id").cast("string")).alias("city"),
        F.expr(CODE).alias("code"),
        (F.col("value") + F.col("n") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,6)").alias("v"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        hour_of("ts").alias("hr"),
        (hour_of("ts") + F.make_dt_interval(hours=F.col("n") + 1)).cast("timestamp").alias("extracted_at"),
    )
    at = F.col("extracted_at")
    for edge, inside in ((since, at.__ge__), (until, at.__lt__)):
        if edge is not None:
            every = every.filter(inside(ntz(edge).cast("timestamp")))
    return every.sortWithinPartitions(at.cast("date")) if in_order else every


SYNCS_SQL = f"""syncs AS (
  SELECT *, {CODE} AS code FROM (
    SELECT event_id, user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, n,
           'e' || event_id || '-' || n AS raw_id, 'city-' || user_id AS city,
           CAST(CAST(value AS DECIMAL(18,2)) + n * 0.01 AS DECIMAL(18,6)) AS v,
           CAST(floor(epoch(ts)) AS BIGINT) AS dt, date_trunc('hour', ts) AS hr,
           date_trunc('hour', ts) + to_hours(n + 1) AS extracted_at
    FROM events CROSS JOIN (VALUES (0), (1)) AS r(n)))"""


def flat(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    return rows.select("*", *[F.expr(e).alias(f"f_{c}") for c, e in fields.items()])


def _struct(**parts: str):
    return F.struct(*[F.col(f"f_{c}").alias(name) for name, c in parts.items()])


def _optional(c: str, name: str):
    """A nested object that is missing when it has no value."""
    return F.when(F.col(f"f_{c}").isNotNull(), F.struct(F.col(f"f_{c}").alias(name)))


def _conditions():
    item = F.struct(
        F.lit(800).alias("id"), F.col("f_weather_main").alias("main"), F.col("f_weather_description").alias("description"),
        F.lit("01d").alias("icon"),
    )
    return F.when(F.col("f_weather_main").isNotNull(), F.array(item)).otherwise(F.array().cast("array<struct<id:int,main:string,description:string,icon:string>>"))


def _main():
    return _struct(
        temp="temp_celsius", feels_like="feels_like_celsius", temp_min="temp_min_celsius", temp_max="temp_max_celsius",
        pressure="pressure_hpa", humidity="humidity_pct", sea_level="sea_level_pressure_hpa",
        grnd_level="ground_level_pressure_hpa",
    )


def _wind():
    return _struct(speed="wind_speed_ms", deg="wind_direction_deg", gust="wind_gust_ms")


def _landing(rows: DataFrame, feed: str, columns: dict) -> DataFrame:
    schema = FEEDS[feed].landing_schema
    columns = {
        "raw_id": F.col("raw_id"), "extracted_at": F.col("extracted_at"), "city": F.col("city"),
        PARTITION: F.col("extracted_at").cast("date"), **columns,
    }
    return rows.select(*[
        (columns[f.name] if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _weather_landing(rows: DataFrame) -> DataFrame:
    return _landing(flat(rows, WEATHER), "current_weather", {
        "name": F.col("f_api_locality"), "dt": F.col("dt"), "timezone": F.col("f_timezone_offset_sec"),
        "visibility": F.col("f_visibility_m"), "coord": _struct(lat="latitude", lon="longitude"),
        "weather": _conditions(), "main": _main(), "wind": _wind(),
        "clouds": _struct(all="cloudiness_pct"), "rain": _optional("rain_1h_mm", "1h"),
        "snow": _optional("snow_1h_mm", "1h"),
        "sys": F.struct(
            F.col("f_country").alias("country"), (F.col("dt") - 3600).alias("sunrise"), (F.col("dt") + 3600).alias("sunset")
        ),
    })


def _pollution_landing(rows: DataFrame) -> DataFrame:
    return _landing(flat(rows, POLLUTION), "air_pollution", {
        "dt": F.col("dt"), "main": _struct(aqi="aqi"),
        "components": _struct(co="co_ug_m3", no="no_ug_m3", no2="no2_ug_m3", o3="o3_ug_m3", so2="so2_ug_m3",
                              pm2_5="pm2_5_ug_m3", pm10="pm10_ug_m3", nh3="nh3_ug_m3"),
    })


def _forecast_landing(rows: DataFrame) -> DataFrame:
    """Each sync brings one record per lead time."""
    slots = rows.withColumn("lead", F.explode(F.array(*[F.lit(h) for h in LEADS])))
    target = F.col("hr") + F.make_dt_interval(hours=F.col("lead"))
    slots = slots.withColumn("slot", target)
    return _landing(flat(slots, FORECAST), "weather_forecast", {
        "dt": F.unix_seconds(F.col("slot").cast("timestamp")), "dt_txt": F.col("slot").cast("string"),
        "pop": F.col("f_precipitation_probability"), "visibility": F.col("f_visibility_m"), "main": _main(),
        "weather": _conditions(), "wind": _wind(), "clouds": _struct(all="cloudiness_pct"),
        "rain": _optional("rain_3h_mm", "3h"), "snow": _optional("snow_3h_mm", "3h"), "sys": _struct(pod="day_or_night"),
    })


def _flow_landing(rows: DataFrame) -> DataFrame:
    return _landing(flat(rows, FLOW), "traffic_flow", {
        "frc": F.col("f_road_class"), "confidence": F.col("f_confidence"), "roadClosure": F.col("f_road_closure"),
        "currentSpeed": F.col("f_current_speed_kmh"), "freeFlowSpeed": F.col("f_free_flow_speed_kmh"),
        "currentTravelTime": F.col("f_current_travel_time_sec"), "freeFlowTravelTime": F.col("f_free_flow_travel_time_sec"),
    })


def _incident_landing(rows: DataFrame) -> DataFrame:
    return _landing(flat(rows, INCIDENT), "traffic_incidents", {
        "type": F.col("f_feature_type"), "geometry": F.col("f_geometry"),
        "properties": F.struct(
            *[F.col(f"f_{c}").alias(n) for n, c in {
                "id": "incident_id", "to": "road_to", "from": "road_from", "delay": "delay_sec", "length": "length_m",
            }.items()],
            F.lit(None).cast("string").alias("endTime"),
            F.date_format("hr", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("startTime"),
            *[F.col(f"f_{c}").alias(n) for n, c in {
                "iconCategory": "category_id", "timeValidity": "time_validity", "numberOfReports": "number_of_reports",
                "magnitudeOfDelay": "magnitude_of_delay", "probabilityOfOccurrence": "probability",
            }.items()],
        ),
    })


BUILDERS = {
    "current_weather": _weather_landing,
    "air_pollution": _pollution_landing,
    "weather_forecast": _forecast_landing,
    "traffic_flow": _flow_landing,
    "traffic_incidents": _incident_landing,
}


def landing(
    spark: SparkSession, sf_dir: str, feed: str, since: datetime | None = None, until: datetime | None = None, in_order: bool = False
) -> DataFrame:
    """Landing rows of a feed: every event of every user, or those extracted from ``since`` to before ``until``."""
    return BUILDERS[feed](syncs(spark, sf_dir, since, until, in_order))


def covered(spark: SparkSession, sf_dir: str, flow: DataFrame) -> DataFrame:
    """Traffic rows of the cities that count as covered: those of some customer segments only."""
    some = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin(*TRAFFIC_SEGMENTS))
    return flow.join(some.select(F.concat(F.lit("city-"), F.col("c_custkey").cast("string")).alias("city")), "city", "left_semi")


def staged(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return build_staging(landing(spark, sf_dir, feed), FIELD_MAPPINGS[feed])
