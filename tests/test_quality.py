from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import checks, contract, maintain
from tidemark.operators.contract import Rule
from tidemark.plans.warehouse import INTERMEDIATE_TESTS, MART_TESTS, SchemaTestError, Warehouse
from tidemark.sources import config as cfg
from tidemark.sources.feeds import FEEDS
from tidemark.sources.mappings import FIELD_MAPPINGS, Mapping

AS_OF = datetime(2026, 1, 5, 12)


def _audit(spark, syncs, rules=(), fields=None, feed="current_weather"):
    landed = None
    for at, city, body in syncs:
        part = h.landing.with_header(h.records(spark, feed, (city, body)), F.lit(at).cast("timestamp_ntz"))
        landed = part if landed is None else landed.unionByName(part)
    landed = spark.createDataFrame([], FEEDS[feed].landing_schema) if landed is None else landed
    frame = contract.stream_audit(landed, feed, fields or FIELD_MAPPINGS[feed], list(rules), AS_OF)
    return {(r["check_type"], r["target_column"]): r for r in frame.collect()}


def test_latest_batch_only_and_certificate(spark):
    got = _audit(spark, [("2026-01-05 09:00:00", None, h.weather("2026-01-05 08:00:00")), ("2026-01-05 11:00:00", "A", h.weather("2026-01-05 10:00:00"))])
    assert got["required", "city"]["rows_checked"] == 1 and got["required", "city"]["status"] == "ok"
    assert got["certify", None]["status"] == "certified"


def test_required_all_null_blocks(spark):
    got = _audit(spark, [("2026-01-05 11:00:00", None, h.weather("2026-01-05 10:00:00"))])
    row = got["required", "city"]
    assert (row["status"], row["null_count"]) == ("null", 1) and "none of 1 rows has a value" in row["detail"]
    assert ("certify", None) not in got and contract.blocks(row)


def test_required_missing_column_blocks(spark):
    fields = [*FIELD_MAPPINGS["current_weather"], Mapping("gone", "no_such", None, True, True, 99)]
    got = _audit(spark, [("2026-01-05 11:00:00", "A", h.weather("2026-01-05 10:00:00"))], fields=fields)
    assert got["required", "gone"]["status"] == "missing" and ("certify", None) not in got


def test_every_rule_type(spark):
    syncs = [("2026-01-05 11:00:00", "A", h.weather("2026-01-05 10:00:00", -70)), ("2026-01-05 11:02:00", "B", h.weather("2026-01-05 10:00:00", 61, "Fog", rain=1))]
    rules = [
        Rule(None, "min_row_count", "3"), Rule(None, "freshness_minutes", "57", "warn"), Rule("temp_celsius", "min", "-60", "warn"),
        Rule("temp_celsius", "max", "60", "warn"), Rule("rain_1h_mm", "not_null", "", "warn"), Rule("rain_1h_mm", "max_null_pct", "49.9", "warn"),
        Rule("snow_1h_mm", "max_null_pct", "100", "warn"), Rule("weather_main", "accepted_values", '["Clear"]', "warn"),
        Rule("humidity_pct", "accepted_values", "[50]"), Rule("humidity_pct", "weird", "1", "warn"), Rule("typo", "min", "1"),
        Rule("pressure_hpa", "max", "not a number", "warn"),
    ]
    fields = FIELD_MAPPINGS["current_weather"]
    got = _audit(spark, syncs, rules[:-1], fields)
    status = {k: v["status"] for k, v in got.items() if k[0] != "required"}
    assert status == {
        ("min_row_count", None): "below_threshold", ("freshness_minutes", None): "below_threshold", ("min", "temp_celsius"): "below_threshold",
        ("max", "temp_celsius"): "below_threshold", ("not_null", "rain_1h_mm"): "below_threshold", ("max_null_pct", "rain_1h_mm"): "below_threshold",
        ("max_null_pct", "snow_1h_mm"): "ok", ("accepted_values", "weather_main"): "below_threshold", ("accepted_values", "humidity_pct"): "ok",
        ("weird", "humidity_pct"): "missing", ("min", "typo"): "config_warning",
    }
    assert got["freshness_minutes", None]["detail"].endswith("freshness_minutes 57: measured 58.0")
    assert contract.blocks(got["weird", "humidity_pct"]) and not contract.blocks(got["min", "temp_celsius"])
    assert not contract.blocks(got["min", "typo"]) and got["min", "typo"]["rows_checked"] is None


def test_malformed_rule_values_block(spark):
    syncs = [("2026-01-05 11:00:00", "A", h.weather("2026-01-05 10:00:00"))]
    rules = [Rule(None, "min_row_count", "many", "warn"), Rule("weather_main", "accepted_values", "5", "warn"), Rule("humidity_pct", "max_null_pct", None, "warn")]
    got = _audit(spark, syncs, rules)
    bad = [got["min_row_count", None], got["accepted_values", "weather_main"], got["max_null_pct", "humidity_pct"]]
    assert [r["status"] for r in bad] == ["missing"] * 3 and all(contract.blocks(r) for r in bad)


def test_inactive_column_and_empty_batch_are_quiet(spark):
    fields = [m._replace(is_active=m.target_column != "humidity_pct") for m in FIELD_MAPPINGS["current_weather"]]
    got = _audit(spark, [("2026-01-05 11:00:00", "A", h.weather("2026-01-05 10:00:00"))], [Rule("humidity_pct", "max", "1")], fields)
    assert got["max", "humidity_pct"]["status"] == "ok"
    rules = [Rule("temp_celsius", "min", "0"), Rule("temp_celsius", "max_null_pct", "0"), Rule(None, "freshness_minutes", "9")]
    got = _audit(spark, [], rules)
    assert {k[0]: v["status"] for k, v in got.items() if k[0] in ("min", "max_null_pct", "freshness_minutes")} == {
        "min": "ok", "max_null_pct": "ok", "freshness_minutes": "below_threshold",
    }
    assert got["required", "city"]["status"] == "ok"


def _sync_all(spark, root, at, aqi=2):
    hour = at[:13]
    h.sync(spark, root, "current_weather", at, ("Berlin", h.weather(f"{hour}:00:00", 10.0, "Rain", rain=0.5)), ("Skopje", h.weather(f"{hour}:00:00", 14.0)))
    h.sync(spark, root, "air_pollution", at, ("Berlin", h.pollution((f"{hour}:00:00", aqi, 30, 60, 10))), ("Skopje", h.pollution((f"{hour}:00:00", 1, 1, 1, 1))))
    h.sync(spark, root, "weather_forecast", at, ("Berlin", h.forecast((f"{hour}:30:00", 11.0, 0.8, 11, "Rain"), ("2026-01-07 12:00:00", 36.0, 0.1, 1, "Clear"))))
    h.sync(spark, root, "traffic_flow", at, ("Berlin", h.flow(20, 40)))
    h.sync(spark, root, "traffic_incidents", at, ("Berlin", h.incidents(("i1", 3, 100), ("i2", 1, 20))))


def test_gate_writes_audit_then_raises(spark, root):
    config = cfg.seed_config(spark)
    with pytest.raises(contract.ContractError, match="no landing data"):
        contract.gate(spark, root, config, AS_OF, "run-0")
    _sync_all(spark, root, "2026-01-05 11:30:00", aqi=7)
    with pytest.raises(contract.ContractError, match="accepted_values"):
        contract.gate(spark, root, config, AS_OF, "run-1")
    log = spark.read.parquet(contract.audit_path(root))
    assert contract.open_failures(log.filter("pipeline_run_id = 'run-1'")).count() == 1
    assert contract.resolve_stored(spark, root, "air_pollution", AS_OF, "fixed") == 2
    assert contract.resolve_stored(spark, root, "air_pollution", AS_OF, "fixed") == 0
    log = spark.read.parquet(contract.audit_path(root))
    assert log.filter("resolved").count() == 2 and log.filter("resolved and status = 'ok'").count() == 0


def test_failing_cast_is_reported_per_check(spark, root):
    config = cfg.seed_config(spark)
    _sync_all(spark, root, "2026-01-05 11:30:00")
    broken = F.when(F.col("target_column") == "frc_num", "cast(frc as int)").otherwise(F.col("source_expr"))
    extra = config["field_mappings"].filter("target_column = 'road_class'").withColumns(
        {"target_column": F.lit("frc_num"), "is_required": F.lit(True), "mapping_id": F.lit(900), "ordinal": F.lit(50)}
    )
    config = {**config, "field_mappings": config["field_mappings"].unionByName(extra).withColumn("source_expr", broken)}
    result = contract.validate_streams(spark, root, config, AS_OF)
    assert len(result.failures) == 1 and "frc_num required: not computable" in result.failures[0]
    assert "traffic_flow" not in result.certified and "air_pollution" in result.certified


def test_hourly_runs_end_to_end(spark, root):
    config = cfg.seed_config(spark)
    house = Warehouse(spark, root)
    _sync_all(spark, root, "2026-01-05 11:30:00")
    result = house.run(datetime(2026, 1, 5, 12), config, "run-1")
    assert sorted(result.certified) == sorted(FEEDS) and not result.warnings
    _sync_all(spark, root, "2026-01-05 12:30:00", aqi=5)
    house.run(datetime(2026, 1, 5, 13), config, "run-2")
    assert house.written["int_city_hourly_weather"] == ["2026-01-05"] and house.written["fct_weather_daily"] == ["2026-01-05"]
    results = house.test({**INTERMEDIATE_TESTS, **MART_TESTS}).collect()
    assert len(results) == 82 and not [r for r in results if r["violations"]]
    wide = house.table("mart_city_daily").filter("city = 'Berlin'").first()
    assert (wide["country"], float(wide["avg_aqi"]), wide["total_incidents"], wide["major_incidents"]) == ("DE", 3.5, 2, 1)
    assert h.rows(house.table("dim_city"), "city", "has_traffic_data") == [("Berlin", True), ("Skopje", False)]
    assert house.table("fct_forecast_accuracy").count() == 2
    assert house.table("mart_forecast_latest").count() == 1
    stored = {n: h.rows(house.table(n)) for n in MART_TESTS}
    house.run(datetime(2026, 1, 5, 13), config, "run-2", validate=False)
    for n in MART_TESTS:
        assert h.rows(house.table(n).select(*house.table(n).columns)) == stored[n], n
    fresh = Warehouse(spark, root)
    fresh.run(datetime(2026, 1, 5, 13), config, "run-3", full_refresh=True, validate=False)
    for n in MART_TESTS:
        assert h.rows(fresh.table(n)) == stored[n], n
    assert set(house.backfill()) == set(INTERMEDIATE_TESTS)
    house.prune_landing(datetime(2026, 1, 6, 12, 0))
    assert h.landing.read_landing(spark, root, "traffic_flow").count() == 1


def test_failing_schema_test_stops_the_run(spark, root):
    house = Warehouse(spark, root)
    _sync_all(spark, root, "2026-01-05 11:30:00")
    bodies = h.pollution(("2026-01-05 11:00:00", 2, 1, 1, 1))
    bodies["list"][0]["main"] = {}
    h.sync(spark, root, "air_pollution", "2026-01-05 11:31:00", ("Oslo", bodies))
    with pytest.raises(SchemaTestError, match="int_city_hourly_pollution.aqi not_null: 1"):
        house.run(datetime(2026, 1, 5, 12), cfg.seed_config(spark), validate=False)


def test_schema_test_functions(spark):
    child = spark.createDataFrame([(1, "x"), (1, "y"), (3, None), (None, "x")], "k int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert h.rows(checks.duplicate_keys(child, "k")) == [(1, 2)]
    assert checks.null_rows(child, "k").count() == 1
    assert h.rows(checks.orphans(child, "k", parent, "k")) == [(3, 1)]
    assert h.rows(checks.outside_values(child, "v", ("x",)), "v") == [("y",)]


def test_upsert_preserves_switches_and_matches_nulls(spark):
    schema = cfg.SCHEMAS["validation_rules"]
    old = spark.createDataFrame([(1, 1, None, "min_row_count", "1", "error", False, "d", None), (2, 1, "t", "min", "0", "warn", True, "d", None)], schema)
    new = spark.createDataFrame([(9, 1, None, "min_row_count", "5", "warn", True, "n", None), (8, 1, "t", "max", "9", "warn", True, "n", None)], schema)
    out = maintain.upsert(old, new, ["stream_id", "target_column", "rule_type"], ["rule_value", "severity", "description"], AS_OF)
    got = h.rows(out, "rule_id", "rule_type", "rule_value", "severity", "is_active", F.col("updated_at").isNotNull())
    assert got == [
        (1, "min_row_count", "5", "warn", False, True), (2, "min", "0", "warn", True, False), (8, "max", "9", "warn", True, True),
    ]


def test_reseed_is_idempotent_and_keeps_switches(spark):
    seed = cfg.seed_config(spark)
    paused = maintain.set_city_active(seed, "Ohrid", False, AS_OF)
    again = maintain.reseed(paused, seed, AS_OF)
    assert {n: again[n].count() for n in seed} == {n: seed[n].count() for n in seed}
    assert again["locations"].filter("not is_active").count() == 1
    assert again["source_locations"].filter("not is_active").count() == 1


def test_city_helpers(spark):
    config = cfg.seed_config(spark)
    config = maintain.add_city(config, "Zagreb", "45.8150", "15.9819")
    assert cfg.active_locations(config, "openweather").count() == 11 and cfg.active_locations(config, "tomtom").count() == 6
    config = maintain.add_city(config, "Zagreb", "45.8", "15.9", ("45.75", "15.85", "45.88", "16.05"))
    assert config["locations"].count() == 11 and cfg.active_locations(config, "tomtom").count() == 7
    assert config["locations"].filter("city = 'Zagreb'").first()["latitude"] == Decimal("45.8")
    config = maintain.set_city_active(config, "Zagreb", False)
    assert cfg.active_locations(config, "openweather").count() == 10
    config = maintain.remove_city(config, "Zagreb")
    assert config["locations"].count() == 10 and config["source_locations"].count() == 16


def test_insert_if_absent_matches_null_keys(spark):
    old = spark.createDataFrame([(1, None), (2, "a")], "i int, k string")
    new = spark.createDataFrame([(7, None), (8, "b")], "i int, k string")
    assert h.rows(maintain.insert_if_absent(old, new, ["k"])) == [(1, None), (2, "a"), (8, "b")]
