"""Small literal payloads for the five feeds."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.operators.staging import build_staging
from tidemark.sources import landing
from tidemark.sources.mappings import FIELD_MAPPINGS


def epoch(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def weather(at: str, temp=20.0, main="Clear", rain=None, country="DE", **extra) -> dict:
    body = {
        "name": "x", "dt": epoch(at), "timezone": 0, "visibility": 10000, "coord": {"lat": 52.52, "lon": 13.405},
        "weather": [{"id": 800, "main": main, "description": main.lower(), "icon": "01d"}] if main else [],
        "main": {"temp": temp, "feels_like": temp, "temp_min": temp, "temp_max": temp, "pressure": 1000, "humidity": 50},
        "wind": {"speed": 3.5, "deg": 10}, "clouds": {"all": 20}, "sys": {"country": country, "sunrise": 1, "sunset": 2},
    }
    if rain is not None:
        body["rain"] = {"1h": rain}
    return {**body, **extra}


def pollution(*records: tuple) -> dict:
    return {
        "list": [
            {"dt": epoch(at), "main": {"aqi": aqi}, "components": {
                "co": 1.0, "no": 0.1, "no2": no2, "o3": 3.0, "so2": 1.0, "pm2_5": pm25, "pm10": pm10, "nh3": 0.2}}
            for at, aqi, pm25, pm10, no2 in records
        ]
    }


def forecast(*records: tuple) -> dict:
    return {
        "list": [
            {"dt": epoch(at), "dt_txt": at, "pop": pop, "visibility": 1,
             "main": {"temp": temp, "feels_like": temp, "temp_min": temp, "temp_max": temp, "pressure": 1000, "humidity": 40},
             "weather": [{"id": 1, "main": main, "description": "d", "icon": "i"}], "wind": {"speed": wind, "deg": 1},
             "clouds": {"all": 1}, "sys": {"pod": "d"}}
            for at, temp, pop, wind, main in records
        ]
    }


def flow(current: int, free: int, closed=False) -> dict:
    return {"flowSegmentData": {"frc": "FRC2", "currentSpeed": current, "freeFlowSpeed": free, "currentTravelTime": 10,
                                "freeFlowTravelTime": 8, "confidence": 0.9, "roadClosure": closed}}


def incidents(*records: tuple) -> dict:
    return {
        "incidents": [
            {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]},
             "properties": {"id": i, "magnitudeOfDelay": magnitude, "delay": delay, "length": 12.5, "iconCategory": 6,
                            "startTime": "2026-01-05T08:00:00Z", "endTime": None, "from": "a", "to": "b",
                            "timeValidity": "present", "numberOfReports": 1, "probabilityOfOccurrence": "certain"}}
            for i, magnitude, delay in records
        ]
    }


def records(spark, feed: str, *bodies: tuple):
    """Parse (city, payload) pairs."""
    df = spark.createDataFrame([(c, json.dumps(b)) for c, b in bodies], "city string, payload string")
    return landing.extract_records(df, feed)


def staged(spark, feed: str, *syncs: tuple):
    """Staged rows of (extracted_at, city, payload) triples."""
    out = None
    for i, (at, city, body) in enumerate(syncs):
        part = records(spark, feed, (city, body))
        part = landing.with_header(part, F.lit(at).cast("timestamp_ntz")).withColumn("raw_id", F.lit(f"r{i}"))
        out = part if out is None else out.unionByName(part)
    return build_staging(out, FIELD_MAPPINGS[feed])


def sync(spark, root: str, feed: str, at: str, *bodies: tuple) -> None:
    """Append one sync to landing."""
    landing.append_snapshot(records(spark, feed, *bodies), root, feed, datetime.fromisoformat(at))


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
