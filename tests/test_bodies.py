from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.sources import bodies, landing

AT = "2026-01-05 10:00:00"
HEALTHY = {
    "current_weather": [h.weather(AT, 20.25, rain=0.5), h.weather(AT, -3, main=None)],
    "air_pollution": [h.pollution((AT, 1, 2.5, 3.5, 4.5), (AT, 5, 1, 1, 1)), {"list": []}],
    "weather_forecast": [h.forecast((AT, 1.5, 0.25, 3.0, "Rain"))],
    "traffic_flow": [h.flow(10, 20), h.flow(1, 2, True)],
    "traffic_incidents": [h.incidents(("i1", 3, 60), (None, 1, None))],
}


def _payloads(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "request int, payload string")


def _dead(spark, feed, *texts):
    found = bodies.dead_letters(bodies.read_bodies(_payloads(spark, *texts), feed))
    return h.rows(found, "request", "reason", "path", "position")


@pytest.mark.parametrize("feed", HEALTHY)
def test_healthy_bodies_read_as_by_the_strict_parser(spark, feed):
    payloads = _payloads(spark, *[json.dumps(b) for b in HEALTHY[feed]])
    read = bodies.read_bodies(payloads, feed)
    strict = landing.extract_records(payloads, feed)
    good = bodies.good_records(read)
    assert good.columns == strict.columns and good.count() > 0
    as_text = lambda df: h.rows(df.select("request", F.to_json(F.struct(*[c for c in df.columns if c != "geometry"])).alias("j")))
    assert as_text(good) == as_text(strict)
    assert bodies.dead_letters(read).count() == 0


def test_reasons(spark):
    whole = json.dumps(h.pollution((AT, 1, 1, 1, 1)))
    found = _dead(spark, "air_pollution", None, whole[:-3], "{}", '{"list":null}', '{"list":{"dt":1}}', '{"list":[]}', '{"list":[3,null,{"dt":1}]}', whole, "[1]", "")
    assert found == [
        (0, "no_body", None, None), (1, "not_json", None, None), (2, "no_record", None, None), (3, "no_record", None, None),
        (4, "bad_value", '$["list"]', None), (6, "bad_record", None, 0), (6, "bad_record", None, 1), (8, "no_record", None, None), (9, "not_json", None, None),
    ]


def test_paths_of_bad_values(spark):
    def broken(**change):
        return json.dumps({**h.weather(AT), **change})

    found = _dead(
        spark, "current_weather", broken(dt="soon"), broken(main=5), broken(main={"temp": [1]}), broken(weather="sunny"),
        broken(weather=[{"id": 1}, {"id": "x"}]), broken(visibility=2.5), broken(visibility="12"), broken(visibility=None), broken(wind={"speed": 1, "deg": 1e30}),
    )
    assert found == [
        (0, "bad_value", "$.dt", None), (1, "bad_value", "$.main", None), (2, "bad_value", "$.main.temp", None), (3, "bad_value", "$.weather", None),
        (4, "bad_value", "$.weather[].id", None), (5, "bad_value", "$.visibility", None), (8, "bad_value", "$.wind.deg", None),
    ]


def test_records_and_dead_letters_are_stored(spark, root):
    good, bad = h.pollution((AT, 1, 1, 1, 1)), h.pollution((AT, 1, 1, 1, 1), (AT, 2, 1, 1, 1))
    bad["list"][1]["main"]["aqi"] = "high"
    for at, texts in (("2026-01-05 10:00:00", [json.dumps(good), "{"]), ("2026-01-06 10:00:00", [json.dumps(bad)])):
        rows = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "city string, payload string")
        bodies.land_bodies(rows, root, "air_pollution", F.lit(at))
    landed = landing.read_landing(spark, root, "air_pollution")
    assert h.rows(landed.select("city", F.col("extracted_date").cast("string"), "main.aqi")) == [("c0", "2026-01-05", 1), ("c0", "2026-01-06", 1)]
    dead = bodies.read_dead_letters(spark, root, "air_pollution")
    assert h.rows(dead, "city", "reason", "payload") == [("c0", "bad_value", json.dumps(bad)), ("c1", "not_json", "{")]


def test_names_with_a_meaning_are_refused(spark, root):
    with pytest.raises(ValueError):
        bodies.read_bodies(_payloads(spark, "{}").withColumn("reason", F.lit(1)), "air_pollution")
    with pytest.raises(ValueError):
        bodies.land_bodies(_payloads(spark, "{}").withColumn("extracted_at", F.lit(1)), root, "air_pollution", F.lit(AT))


@pytest.mark.parametrize("feed", HEALTHY)
def test_generated_methods_are_short_enough_to_be_compiled(spark, feed):
    """The JVM leaves methods of more than 8000 bytes of code to the interpreter, which is many times slower."""
    read = bodies.read_bodies(_payloads(spark, "{}"), feed)
    parts = read._jdf.queryExecution().debug().codegenToSeq()
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) <= 8000
