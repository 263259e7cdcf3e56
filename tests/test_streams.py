from __future__ import annotations

import os

from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators.staging import build_staging
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL
from tidemark.operators.incremental import read_table
from tidemark.sources import landing
from tidemark.sources.mappings import FIELD_MAPPINGS
from tidemark.streaming import streams

FEED = "air_pollution"
TARGET = INCREMENTAL["int_city_hourly_pollution"].table


def _staged_stream(spark, root):
    return build_staging(landing.stream_landing(spark, root, FEED), FIELD_MAPPINGS[FEED])


def _sync(spark, root, at, *readings):
    h.sync(spark, root, FEED, at, *[(city, h.pollution((seen, aqi, 1, 1, 1))) for city, seen, aqi in readings])


def _batch(spark, root):
    return m.hourly_pollution(build_staging(landing.read_landing(spark, root, FEED), FIELD_MAPPINGS[FEED]))


def test_restarted_stream_equals_batch(spark, root):
    """Three arrivals with late and repeated rows; each run continues from the checkpoint."""
    arrivals = [
        ("2026-01-05 10:00:00", ("A", "2026-01-05 09:10:00", 1), ("B", "2026-01-05 09:20:00", 2)),
        ("2026-01-05 11:00:00", ("A", "2026-01-05 09:50:00", 3), ("A", "2026-01-05 10:10:00", 4)),
        ("2026-01-05 12:00:00", ("B", "2026-01-05 09:05:00", 5), ("B", "2026-01-05 11:05:00", 1)),
    ]
    for at, *readings in arrivals:
        _sync(spark, root, at, *readings)
        sink = streams.keyed_replace(root, TARGET, m.hourly_pollution)
        streams.run_available(_staged_stream(spark, root), sink, f"{root}/_ck/a", "append")
    stored = read_table(spark, TARGET.path(root))
    expected = _batch(spark, root)
    assert h.rows(stored.select(*expected.columns)) == h.rows(expected)
    streams.run_available(_staged_stream(spark, root), sink, f"{root}/_ck/a", "append")
    assert read_table(spark, TARGET.path(root)).count() == expected.count()


def test_stateful_dedupe_equals_batch(spark, root):
    sink = streams.keyed_replace(root, TARGET, lambda b: b.select(m.city_hour_key().alias("city_hour_key"), "*"))
    for at, *readings in [
        ("2026-01-05 10:00:00", ("A", "2026-01-05 09:10:00", 1), ("A", "2026-01-05 09:40:00", 2)),
        ("2026-01-05 11:00:00", ("A", "2026-01-05 09:30:00", 3), ("A", "2026-01-05 10:10:00", 4)),
    ]:
        _sync(spark, root, at, *readings)
        rows = m.observed_rows(_staged_stream(spark, root), (), m.POLLUTION_MEASURES)
        streams.run_available(streams.hourly_dedupe(rows, ["city"], "observed_at", m.POLLUTION_RANK), sink, f"{root}/_ck/b")
    expected = _batch(spark, root)
    assert h.rows(read_table(spark, TARGET.path(root)).select(*expected.columns)) == h.rows(expected)


def test_late_rows_are_dropped_by_the_watermark(spark, root):
    seen = []

    def collect(batch, _):
        seen.extend((r["city"], r["n"]) for r in batch.collect())

    for at, *readings in [
        ("2026-01-05 20:00:00", ("A", "2026-01-05 19:00:00", 1)),
        ("2026-01-05 21:00:00", ("A", "2026-01-05 20:30:00", 1)),
        ("2026-01-05 22:00:00", ("LATE", "2026-01-05 01:00:00", 1)),
    ]:
        _sync(spark, root, at, *readings)
        rolled = streams.tumbling_rollup(
            _staged_stream(spark, root).select("city", "observed_at"), ["city"], "observed_at", "1 hour", [F.count(F.lit(1)).alias("n")]
        )
        streams.run_available(rolled, collect, f"{root}/_ck/c")
    assert ("A", 1) in seen and "LATE" not in {c for c, _ in seen}


def test_state_has_no_more_partitions_than_the_cores_need(spark, root, monkeypatch):
    monkeypatch.setattr(streams, "STATES", 1)
    before, cores = spark.conf.get(streams.PARTITIONS), spark.sparkContext.defaultParallelism
    spark.conf.set(streams.PARTITIONS, 3 * cores)
    try:
        spark.range(5).selectExpr("id", "timestamp'2024-01-01' as at").write.parquet(f"{root}/in")
        stream = spark.readStream.schema("id long, at timestamp").parquet(f"{root}/in")
        seen = []
        streams.run_available(streams.drop_repeats(stream, ["id"], "at"), lambda b, _: seen.append(b.count()), f"{root}/cp", "append")
        assert sum(seen) == 5 and spark.conf.get(streams.PARTITIONS) == str(3 * cores)
        assert len([p for p in os.listdir(f"{root}/cp/state/0") if p.isdigit()]) == cores
    finally:
        spark.conf.set(streams.PARTITIONS, before)
