from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators import contract
from tidemark.operators.contract import Rule
from tidemark.operators.incremental import read_table
from tidemark.operators.staging import build_staging
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL
from tidemark.sources import landing, paths
from tidemark.sources.mappings import FIELD_MAPPINGS, Mapping
from tidemark.streaming import gate, streams

FEED = "current_weather"
FIELDS = FIELD_MAPPINGS[FEED]
TABLE = INCREMENTAL["int_city_hourly_weather"].table
RULES = [Rule("temp_celsius", "max", "50"), Rule("rain_1h_mm", "not_null", "", "warn"), Rule(None, "freshness_minutes", "10", "warn"), Rule("tmep", "min", "1")]
LATER = datetime(2026, 1, 5, 12)


def _sink(root):
    return streams.keyed_replace(root, TABLE, lambda rows: m.hourly_weather(build_staging(rows, FIELDS)))


def _run(spark, root, fields=FIELDS, rules=RULES):
    judge = gate.gated(root, FEED, fields, rules, _sink(root), lambda newest: LATER)
    streams.run_available(landing.stream_landing(spark, root, FEED), judge, f"{root}/_ck", "append")
    return judge


def _cities(spark, root):
    return h.rows(read_table(spark, TABLE.path(root)), "city", "temp_celsius")


def _log(spark, root, *columns):
    return spark.read.parquet(contract.audit_path(root)).select(*columns)


LINE = ("target_column", "check_type", "status", "rows_checked", "null_count", "detail")


def test_lines_equal_the_batch_gate(spark, root):
    h.sync(spark, root, FEED, "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 09:00:00", 10)), ("B", h.weather("2026-01-05 09:00:00", 60, rain=1.0)))
    _run(spark, root)
    expected = contract.stream_audit(landing.read_landing(spark, root, FEED), FEED, FIELDS, RULES, LATER)
    assert h.rows(_log(spark, root, *LINE)) == h.rows(expected, *LINE)
    assert {r["status"] for r in expected.collect()} == {"ok", "below_threshold", "config_warning"}


def test_blocked_batch_leaves_the_target_and_waits(spark, root):
    h.sync(spark, root, FEED, "2026-01-05 09:00:00", ("A", h.weather("2026-01-05 08:00:00", 10)))
    _run(spark, root)
    before = _cities(spark, root)
    h.sync(spark, root, FEED, "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 08:30:00", 60)), ("B", h.weather("2026-01-05 09:00:00", 20)))
    _run(spark, root)
    assert _cities(spark, root) == before and len(before) == 1
    assert h.rows(gate.quarantined(spark, root, FEED), "city", "micro_batch") == [("A", 1), ("B", 1)]
    h.sync(spark, root, FEED, "2026-01-05 11:00:00", ("C", h.weather("2026-01-05 10:00:00", 30)))
    _run(spark, root)
    assert [c for c, _ in _cities(spark, root)] == ["A", "C"]
    # somebody looks at the batch and lets it through
    opened = gate.release(spark, root, FEED, 1, _sink(root), LATER, "sensor is right")
    assert [c for c, _ in _cities(spark, root)] == ["A", "B", "C"] and opened > 0
    runs = spark.read.parquet(contract.audit_path(root)).filter(F.col("pipeline_run_id") == gate.run_name(FEED, 1))
    assert runs.filter(contract.is_open()).count() == 0
    with pytest.raises(ValueError):
        gate.release(spark, root, FEED, 1, _sink(root), LATER)


def test_replayed_batch_is_logged_once(spark, root):
    h.sync(spark, root, FEED, "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 09:00:00", 60)))
    judge = _run(spark, root)
    lines = h.rows(_log(spark, root, *LINE))
    judge(landing.read_landing(spark, root, FEED), 0)
    assert h.rows(_log(spark, root, *LINE)) == lines
    assert gate.quarantined(spark, root, FEED).count() == 1
    judge(landing.read_landing(spark, root, FEED).limit(0), 9)
    assert h.rows(_log(spark, root, *LINE)) == lines
    assert not paths.exists(spark, TABLE.path(root))


def test_check_that_fails_on_the_data_blocks(spark, root):
    fields = [*FIELDS, Mapping("number", "cast(name as int)", None, False, True, 90)]
    h.sync(spark, root, FEED, "2026-01-05 10:00:00", ("A", h.weather("2026-01-05 09:00:00", 10)))
    _run(spark, root, fields, [Rule("number", "max", "5", "warn"), Rule("temp_celsius", "max", "50")])
    assert h.rows(_log(spark, root, "target_column", "status").filter("check_type = 'max'")) == [("number", "missing"), ("temp_celsius", "ok")]
    assert gate.quarantined(spark, root, FEED).count() == 1 and not paths.exists(spark, TABLE.path(root))
