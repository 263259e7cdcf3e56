"""The derived feeds: how their rows are dealt over tasks, and which of them an arrival reads."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.queries import derived as d
from tidemark.queries.incremental_on_tables import CUTS, land_rows, slices
from tidemark.session import use_utc
from tidemark.sources import landing as land


@pytest.fixture
def events(spark, root):
    """One file with one row group: every six hours of January and around the cuts, some rows repeated, one without time."""
    use_utc(spark)
    start = datetime(2024, 1, 1)
    times = [start + timedelta(hours=6 * i, seconds=i) for i in range(120)]
    times += [c + timedelta(seconds=s) for c in CUTS for s in (-7201, -7200, -3601, -3600, -1, 0, 1)] + times[:5] + [None]
    rows = [(i if i % 9 else None, t, i % 7, "view", 1.5, '{"k": 50}') for i, t in enumerate(times)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/events.parquet")
    return root


def test_events_of_one_row_group_are_dealt_over_all_cores(spark, events):
    assert spark.read.parquet(f"{events}/events.parquet").rdd.getNumPartitions() == 1
    for feed in d.BUILDERS:
        assert d.landing(spark, events, feed).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_slices_hold_every_row_with_an_extract_time_once(spark, events):
    at = F.col("extracted_at").cast("timestamp_ntz")
    every = d.landing(spark, events, "air_pollution")
    edges = [datetime(2000, 1, 1), *CUTS, datetime(3000, 1, 1)]
    for low, high, (_, rows) in zip(edges[:-1], edges[1:], slices(spark, events, "air_pollution"), strict=True):
        expected = every.filter((at >= F.lit(low)) & (at < F.lit(high)))
        assert rows.count() == expected.count() > 0 and rows.exceptAll(expected).isEmpty()


def test_an_arrival_deals_only_the_events_it_can_hold(spark, events):
    _, rows = list(slices(spark, events, "air_pollution"))[1]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("RepartitionByExpression"):]
    assert "Filter" in dealt and "2024-01-10 22:00:00" in dealt and "2024-01-21 00:00:00" in dealt


def test_arrivals_are_dealt_by_time_and_written_by_day_without_another_shuffle_or_sort(spark, events):
    _, rows = list(slices(spark, events, "air_pollution"))[1]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning(ts") == plan.count("Exchange ") == 1
    land_rows(rows, events, "air_pollution")
    landed = land.read_landing(spark, events, "air_pollution")
    assert landed.select(land.PARTITION).distinct().count() == 10
    assert landed.select(*rows.columns).exceptAll(rows).isEmpty() and landed.count() == rows.count()
