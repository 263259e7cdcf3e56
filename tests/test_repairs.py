"""Cases that once lost rows, hid them, or stopped a table for good."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import checks, contract
from tidemark.operators.incremental import Restriction, Table, refresh
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import landing, paths
from tidemark.sources.mappings import FIELD_MAPPINGS


def _land(spark, root, at):
    h.sync(spark, root, "air_pollution", at, ("Aarhus", h.pollution((at, 2, 10.5, 20.0, 30.0))))


def test_newest_days_follow_the_window(spark, root):
    for day in range(4):
        _land(spark, root, f"2026-01-0{day + 1}T10:00:00")
    read = lambda minutes: landing.newest_days(spark, root, "air_pollution", minutes).count()
    assert (read(5), read(1440), read(3 * 1440)) == (2, 2, 4)


def test_unknown_location_is_kept_with_a_null_city(spark):
    records = spark.createDataFrame([(1, "a"), (2, "b")], "location_id int, x string")
    locations = spark.createDataFrame([(1, "Aarhus")], "location_id int, city string")
    assert h.rows(landing.tag_partition(records, locations), "x", "city") == [("a", "Aarhus"), ("b", None)]


def test_body_without_the_record_gives_no_row(spark):
    bodies = spark.createDataFrame([("Aarhus", "{}"), ("Oslo", '{"flowSegmentData": {"frc": "FRC1"}}')], "city string, payload string")
    assert h.rows(landing.extract_records(bodies, "traffic_flow"), "city", "frc") == [("Oslo", "FRC1")]


def _table(**kw):
    return Table("t", "marts", "k", "day", "day", timedelta(days=1), **kw)


@pytest.mark.parametrize("by_range", [False, True])
def test_null_day_does_not_stop_later_runs(spark, root, by_range):
    table = _table(replace_range=by_range)
    source = spark.createDataFrame([("a", date(2026, 1, 1), 1), ("n", None, 2)], "k string, day date, v int")
    later = spark.createDataFrame([("b", date(2026, 1, 2), 3), ("m", None, 4)], "k string, day date, v int")
    for df in (source, later, later):
        refresh(spark, root, table, lambda src: src, {"src": df}, {})
    found = h.rows(spark.read.parquet(table.path(root)), "k", "v")
    kept = [] if by_range else [("a", 1)]  # a range replacement drops what is no longer produced after its bound
    assert found == [*kept, ("b", 3), ("m", 4), ("n", 2)]
    assert not paths.exists(spark, f"{root}/_batches/t")


def test_orphans_reduce_both_sides_before_the_join(spark):
    child = spark.range(1000).select(F.lit(7).alias("fk")).union(spark.range(3).select(F.lit(8)))
    parent = spark.range(500).select(F.lit(8).alias("id"))
    found = checks.orphans(child, "fk", parent, "id")
    assert h.rows(found, "fk", "n") == [(7, 1000)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert plan.index("Aggregate", join) > join


def test_accepted_numbers_compare_as_numbers(spark, root):
    _land(spark, root, "2026-01-01T10:00:00")
    rows = landing.read_landing(spark, root, "air_pollution")
    rule = contract.Rule("pm2_5_ug_m3", "accepted_values", '["0", "10.5"]')
    found = contract.stream_audit(rows, "air_pollution", FIELD_MAPPINGS["air_pollution"], [rule], datetime(2026, 1, 1, 10))
    assert [r["status"] for r in found.collect() if r["check_type"] == "accepted_values"] == ["ok"]


def test_full_refresh_keeps_what_landing_no_longer_has(spark, root):
    house = Warehouse(spark, root)
    for at in ("2026-01-01T10:00:00", "2026-01-05T10:00:00"):
        _land(spark, root, at)
        for feed, body in (
            ("current_weather", h.weather(at)), ("weather_forecast", h.forecast((at, 20.0, 0.1, 3.0, "Clear"))),
            ("traffic_flow", h.flow(30, 50)), ("traffic_incidents", h.incidents(("i1", 2, 60))),
        ):
            h.sync(spark, root, feed, at, ("Aarhus", body))
        house.run(datetime.fromisoformat(at), test="none")
    before = house.table("int_city_hourly_pollution").count()
    house.prune_landing(datetime(2026, 1, 5, 10))
    house.run(datetime(2026, 1, 5, 11), full_refresh=True, test="none")
    assert house.table("int_city_hourly_pollution").count() == before
    with pytest.raises(ValueError, match="a rebuild loses them"):
        house.run(datetime(2026, 1, 5, 11), full_refresh="all", test="none")


def test_one_stored_audit_row_is_resolved(spark, root):
    rows = [("a", None, "batch", "missing", "error", 1, None, "x"), ("b", None, "batch", "missing", "error", 1, None, "y")]
    runs = contract.as_runs(spark.createDataFrame(rows, contract.AUDIT_DDL), datetime(2026, 1, 5), "r")
    contract.append_audit(runs, root)
    stored = spark.read.parquet(contract.audit_path(root))
    run_id = stored.filter("stream_name = 'a'").first()["run_id"]
    assert contract.resolve_stored_run(spark, root, run_id, datetime(2026, 1, 6), "seen") == 1
    assert h.rows(spark.read.parquet(contract.audit_path(root)), "stream_name", "resolved") == [("a", True), ("b", False)]
