from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators.staging import build_staging
from tidemark.sources import config as cfg
from tidemark.sources import landing
from tidemark.sources.feeds import FEEDS
from tidemark.sources.mappings import FIELD_MAPPINGS, Mapping


def test_mapping_counts():
    assert {f: len(m) for f, m in FIELD_MAPPINGS.items()} == {
        "current_weather": 26, "air_pollution": 12, "weather_forecast": 23, "traffic_flow": 10, "traffic_incidents": 17,
    }
    assert len(cfg.RULES) == 13


@pytest.mark.parametrize("feed", sorted(FEEDS))
def test_all_expressions_analyse(spark, feed):
    empty = spark.createDataFrame([], FEEDS[feed].landing_schema)
    out = build_staging(empty, FIELD_MAPPINGS[feed])
    assert out.columns == ["raw_id", "extracted_at", *[m.target_column for m in FIELD_MAPPINGS[feed]]]


def test_weather_record(spark):
    row = h.staged(spark, "current_weather", ("2026-01-05 10:00:00", "Berlin", h.weather("2026-01-05 09:40:00", 3.25))).first()
    assert row["observed_at"] == datetime(2026, 1, 5, 9, 40)
    assert row["temp_celsius"] == Decimal("3.25")
    assert row["weather_main"] == "Clear"
    assert row["rain_1h_mm"] is None and row["wind_gust_ms"] is None


def test_empty_condition_array_is_null(spark):
    row = h.staged(spark, "current_weather", ("2026-01-05 10:00:00", "Berlin", h.weather("2026-01-05 09:40:00", main=None))).first()
    assert row["weather_main"] is None


def test_array_records_explode_and_empty_gives_none(spark):
    body = h.pollution(("2026-01-05 09:00:00", 2, 5, 6, 7), ("2026-01-05 10:00:00", 4, 25, 50, 200))
    assert h.records(spark, "air_pollution", ("Berlin", body)).count() == 2
    assert h.records(spark, "air_pollution", ("Berlin", {"list": []}), ("Oslo", {})).count() == 0


def test_zero_free_flow_has_no_congestion(spark):
    df = h.staged(
        spark, "traffic_flow", ("2026-01-05 10:00:00", "A", h.flow(30, 0)), ("2026-01-05 10:00:00", "B", h.flow(30, 40)),
        ("2026-01-05 10:00:00", "C", h.flow(50, 40)),
    )
    assert h.rows(df, "city", "congestion_score") == [("A", None), ("B", Decimal("0.25")), ("C", Decimal("-0.25"))]


def test_incident_labels_and_geometry(spark):
    df = h.staged(spark, "traffic_incidents", ("2026-01-05 10:00:00", "A", h.incidents(("i1", 3, 60), ("i2", 9, 5))))
    assert h.rows(df, "incident_id", "delay_severity") == [("i1", "Major"), ("i2", None)]
    assert "LineString" in df.first()["geometry"]
    assert df.first()["started_at"] is not None


def test_aqi_label_outside_scale_is_null(spark):
    body = h.pollution(*[("2026-01-05 09:00:00", aqi, 1, 1, 1) for aqi in (0, 1, 5, 6)])
    df = h.staged(spark, "air_pollution", ("2026-01-05 10:00:00", "A", body))
    assert h.rows(df, "aqi", "aqi_label") == [(0, None), (1, "Good"), (5, "Very Poor"), (6, None)]


def test_wrong_type_fails_the_run(spark):
    body = h.weather("2026-01-05 09:40:00")
    body["main"]["humidity"] = 50.5
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        h.records(spark, "current_weather", ("Berlin", body)).collect()


def test_inactive_field_disappears_and_required_is_guarded(spark):
    empty = spark.createDataFrame([], FEEDS["traffic_flow"].landing_schema)
    mappings = FIELD_MAPPINGS["traffic_flow"]
    without = [m._replace(is_active=m.target_column != "confidence") for m in mappings]
    assert "confidence" not in build_staging(empty, without).columns
    broken = [m._replace(is_active=m.target_column != "city") for m in mappings]
    with pytest.raises(cfg.ConfigError, match="city"):
        build_staging(empty, broken)


def test_projection_follows_ordinal(spark):
    empty = spark.createDataFrame([], "raw_id string, extracted_at timestamp, a int, b int")
    out = build_staging(empty, [Mapping("b", "b", ordinal=2), Mapping("a", "a", "string", ordinal=1)])
    assert out.columns == ["raw_id", "extracted_at", "a", "b"]
    assert out.schema["a"].dataType.simpleString() == "string"


def test_append_tag_latest_and_prune(spark, root):
    feed = "traffic_flow"
    places = spark.createDataFrame([(1, "Berlin"), (2, "London")], "location_id int, city string")
    bare = h.records(spark, feed, ("1", h.flow(1, 2)), ("2", h.flow(3, 4))).withColumn("location_id", F.col("city").cast("int"))
    tagged = landing.tag_partition(bare.drop("city"), places)
    for at in ("2026-01-03 10:00:00", "2026-01-04 09:00:00", "2026-01-04 11:00:00", "2026-01-05 10:00:00", "2026-01-05 10:04:00"):
        landing.append_snapshot(tagged, root, feed, datetime.fromisoformat(at))
    stored = landing.read_landing(spark, root, feed)
    assert stored.count() == 10 and stored.select("raw_id").distinct().count() == 10
    assert landing.latest_batch(stored).count() == 4
    assert landing.latest_batch(stored, 1).count() == 2
    landing.prune(spark, root, feed, datetime(2026, 1, 5, 10, 30))
    left = landing.read_landing(spark, root, feed)
    assert h.rows(left.select(F.col("extracted_at").cast("string")).distinct()) == [
        ("2026-01-04 11:00:00",), ("2026-01-05 10:00:00",), ("2026-01-05 10:04:00",),
    ]
    landing.prune(spark, root, feed, datetime(2026, 1, 9))
    from tidemark.sources import paths

    assert paths.partition_values(spark, landing.landing_path(root, feed), landing.PARTITION) == []


def test_latest_batch_of_empty_landing(spark):
    empty = spark.createDataFrame([], FEEDS["traffic_flow"].landing_schema)
    assert landing.latest_batch(empty).count() == 0


def test_seed_config(spark):
    config = cfg.seed_config(spark)
    counts = {n: config[n].count() for n in ("sources", "streams", "locations", "source_locations", "field_mappings", "validation_rules")}
    assert counts == {"sources": 2, "streams": 5, "locations": 10, "source_locations": 16, "field_mappings": 88, "validation_rules": 13}
    cfg.check_config(config)
    assert [r["stream_name"] for r in cfg.active_streams(config).collect()] == sorted(FEEDS)
    assert cfg.active_locations(config, "tomtom").count() == 6
    rules = [(r["target_column"], r["rule_type"]) for r in cfg.active_rules(config, "current_weather").collect()]
    assert rules[:2] == [(None, "freshness_minutes"), (None, "min_row_count")]
    assert cfg.all_mappings(config, "air_pollution") == FIELD_MAPPINGS["air_pollution"]
    bad = {**config, "field_mappings": config["field_mappings"].withColumn("is_active", F.col("target_column") != "aqi")}
    with pytest.raises(cfg.ConfigError, match="aqi"):
        cfg.check_config(bad)
    odd = {**config, "validation_rules": config["validation_rules"].withColumn("severity", F.lit("fatal"))}
    with pytest.raises(cfg.ConfigError):
        cfg.check_config(odd)
