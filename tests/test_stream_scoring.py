from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.operators.incremental import read_table
from tidemark.operators.staging import build_staging
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL
from tidemark.sources import landing
from tidemark.sources.mappings import FIELD_MAPPINGS
from tidemark.streaming import scoring, streams

FEEDS = ("weather_forecast", "current_weather")
TABLE = INCREMENTAL["fct_forecast_accuracy"].table


def _predict(spark, root, at, city, target, temp=10.0):
    h.sync(spark, root, "weather_forecast", at, (city, h.forecast((target, temp, 0.6, 1.0, "Rain"))))


def _observe(spark, root, at, city, seen, temp=11.0):
    h.sync(spark, root, "current_weather", at, (city, h.weather(seen, temp, "Rain", rain=0.4)))


def _run(spark, root):
    """One run over what has landed; returns the rows in the join's state."""
    staged = [build_staging(landing.stream_landing(spark, root, f), FIELD_MAPPINGS[f]) for f in FEEDS]
    scored = scoring.score_on_arrival(*staged).withColumn("forecast_date_utc", F.to_date("forecast_at"))
    done = streams.run_available(scored, streams.keyed_replace(root, TABLE), f"{root}/_ck", "append")
    states = [s for s in done.recentProgress[-1]["stateOperators"] if s["operatorName"] == "symmetricHashJoin"]
    return states[0]["numRowsTotal"]


def _batch(spark, root):
    staged = [build_staging(landing.read_landing(spark, root, f), FIELD_MAPPINGS[f]) for f in FEEDS]
    return m.forecast_accuracy(m.forecast_history(staged[0]), m.hourly_weather(staged[1]), datetime(2027, 1, 1))


def test_scores_equal_batch_and_state_shrinks(spark, root):
    first = datetime(2026, 1, 5)
    for i in range(12):  # predictions of one morning for the days ahead, most of them never observed
        _predict(spark, root, "2026-01-05 06:00:00", "A", str(first + timedelta(hours=8 + 9 * i)), 10 + i)
    _predict(spark, root, "2026-01-05 07:00:00", "A", "2026-01-05 08:00:00", 3.0)
    _predict(spark, root, "2026-01-05 09:00:00", "A", "2026-01-05 08:00:00", 4.0)  # after its slot: no prediction
    _observe(spark, root, "2026-01-05 08:10:00", "A", "2026-01-05 08:05:00", 11.0)
    _observe(spark, root, "2026-01-05 08:55:00", "A", "2026-01-05 08:50:00", 12.0)  # the later reading counts
    waiting = _run(spark, root)
    _predict(spark, root, "2026-01-06 06:00:00", "B", "2026-01-06 08:00:00")
    _observe(spark, root, "2026-01-06 08:30:00", "B", "2026-01-06 08:20:00")
    waiting = max(waiting, _run(spark, root))
    assert waiting >= 12
    # an arrival long after: every horizon has passed
    _predict(spark, root, "2026-01-20 06:00:00", "C", "2026-01-20 08:00:00")
    _observe(spark, root, "2026-01-20 08:30:00", "C", "2026-01-20 08:20:00")
    assert _run(spark, root) < waiting
    _predict(spark, root, "2026-01-22 06:00:00", "D", "2026-01-23 08:00:00")
    _observe(spark, root, "2026-01-22 06:30:00", "D", "2026-01-22 06:20:00")
    _run(spark, root)
    expected = _batch(spark, root)
    assert expected.count() == 4  # A twice, B, C
    assert h.rows(read_table(spark, TABLE.path(root)).select(*expected.columns)) == h.rows(expected)


def test_waiting_predictions_can_lie_on_disk(spark, root):
    """At 6 GB the state of an arrival did not fit the executors' heap."""
    def run(**where):
        staged = [build_staging(landing.stream_landing(spark, root, f), FIELD_MAPPINGS[f]) for f in FEEDS]
        scored = scoring.score_on_arrival(*staged).withColumn("forecast_date_utc", F.to_date("forecast_at"))
        done = streams.run_available(scored, streams.keyed_replace(root, TABLE), f"{root}/_ck", "append", **where)
        return [s["customMetrics"] for p in done.recentProgress for s in p["stateOperators"]]

    before = {key: spark.conf.get(key, None) for key in streams.STATE}
    _predict(spark, root, "2026-01-05 06:00:00", "A", "2026-01-05 08:00:00")
    _observe(spark, root, "2026-01-05 08:10:00", "A", "2026-01-05 08:05:00")
    assert all("rocksdbPutCount" in m for m in run(on_disk=True))
    _predict(spark, root, "2026-01-08 06:00:00", "B", "2026-01-09 08:00:00")
    _observe(spark, root, "2026-01-08 08:30:00", "B", "2026-01-08 08:20:00")
    assert all("rocksdbPutCount" in m for m in run())  # a checkpoint keeps its kind of store
    _observe(spark, root, "2026-01-20 08:30:00", "C", "2026-01-20 08:20:00")
    run(on_disk=True)
    expected = _batch(spark, root)
    assert expected.count() == 1
    assert h.rows(read_table(spark, TABLE.path(root)).select(*expected.columns)) == h.rows(expected)
    assert {key: spark.conf.get(key, None) for key in streams.STATE} == before


def test_only_what_a_score_needs_waits_in_state(spark, root):
    """Equal ranks are still decided by whole rows, as in the batch model."""
    _predict(spark, root, "2026-01-05 06:00:00", "A", "2026-01-05 08:00:00")
    _observe(spark, root, "2026-01-05 08:10:00", "A", "2026-01-05 08:05:00")
    forecasts, weather = (build_staging(landing.stream_landing(spark, root, f), FIELD_MAPPINGS[f]) for f in FEEDS)
    assert set(scoring.predictions(forecasts).columns) == {"_closed", *scoring.PREDICTED}
    assert set(scoring.observations(weather).columns) == {"_closed", *scoring.OBSERVED}


def test_repeats_within_the_watermark_are_dropped(spark, root):
    def run():
        stream = landing.stream_landing(spark, root, "traffic_incidents").select(
            "city", F.col("properties.id").alias("id"), "extracted_at"
        )
        kept = streams.drop_repeats(stream, ["city", "id"], "extracted_at", "6 hours")
        streams.run_available(kept, streams.append_once(f"{root}/events"), f"{root}/_ck2", "append")
        return h.rows(spark.read.parquet(f"{root}/events"), "city", "id")

    h.sync(spark, root, "traffic_incidents", "2026-01-05 10:00:00", ("A", h.incidents(("i1", 1, 5), ("i2", 1, 5))))
    assert run() == [("A", "i1"), ("A", "i2")]
    h.sync(spark, root, "traffic_incidents", "2026-01-05 12:00:00", ("A", h.incidents(("i1", 1, 5), ("i3", 1, 5))), ("B", h.incidents(("i1", 1, 5))))
    assert run() == [("A", "i1"), ("A", "i2"), ("A", "i3"), ("B", "i1")]
    assert run() == [("A", "i1"), ("A", "i2"), ("A", "i3"), ("B", "i1")]
    # days later the key has left the state and counts as new
    for at in ("2026-01-08 10:00:00", "2026-01-09 10:00:00"):
        h.sync(spark, root, "traffic_incidents", at, ("C", h.incidents(("i9", 1, 5))))
        run()
    h.sync(spark, root, "traffic_incidents", "2026-01-09 11:00:00", ("A", h.incidents(("i1", 1, 5))))
    assert run().count(("A", "i1")) == 2


def test_replayed_append_overwrites_itself(spark, root):
    sink = streams.append_once(f"{root}/events")
    for number, rows in ((0, [(1,)]), (1, [(2,), (3,)]), (1, [(2,), (3,)])):
        sink(spark.createDataFrame(rows, "i int"), number)
    assert h.rows(spark.read.parquet(f"{root}/events"), "i") == [(1,), (2,), (3,)]
