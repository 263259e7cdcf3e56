from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from tidemark.functions import keys, labels, sql, times
from tidemark.operators import contract
from tidemark.operators.maintain import toggle_active

AT = datetime(2026, 1, 5, 9)
LOG = "run_id bigint, run_ts timestamp, stream_name string, status string, resolved boolean, resolved_at timestamp, resolved_note string"


def _log(spark):
    rows = [
        (1, AT, "a", "null", False, None, None), (2, AT, "a", "ok", False, None, None), (3, AT, "a", "missing", True, AT, "seen"),
        (4, AT, "b", "below_threshold", False, None, None), (5, AT, None, "null", False, None, None), (6, AT, "a", None, None, None, None),
    ]
    return spark.createDataFrame(rows, LOG)


def test_scalars_equal_the_column_functions(spark):
    sql.register_scalars(spark)
    day, early = datetime(2026, 2, 28, 23, 40), datetime(2026, 2, 27, 1, 10)
    df = spark.createDataFrame(
        [(day, early, "x", "0.75"), (early, day, None, "0.2"), (None, day, "", None), (day, None, "-", "0.1999")],
        "a timestamp_ntz, b timestamp_ntz, s string, v string",
    ).withColumn("v", F.col("v").cast("decimal(18,6)"))
    df.createOrReplaceTempView("scalars_t")
    got = spark.sql(
        "SELECT feed_surrogate_key(array(s, CAST(a AS STRING))), feed_date_key(CAST(a AS DATE)), feed_comfort_label(v), "
        "feed_congestion_label(v), feed_lead_time_hours(a, b) FROM scalars_t"
    )
    expected = df.select(
        keys.surrogate_key("s", "a"), keys.date_key("a"), labels.comfort_label(F.col("v")), labels.congestion_label(F.col("v")),
        times.lead_time_hours("a", "b"),
    )
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in expected.collect())
    names = spark.sql("SELECT feed_aqi_label(5), feed_aqi_label(6), feed_aqi_label(NULL), feed_delay_severity(0)").first()
    assert tuple(names) == ("Very Poor", None, None, "Unknown")


def test_log_functions_equal_the_operators(spark):
    log = _log(spark)
    log.createOrReplaceTempView("log_t")
    sql.register_log(spark, "log_t")
    opened = spark.sql("SELECT run_id FROM feed_open_failures() ORDER BY run_id").collect()
    assert [r[0] for r in opened] == sorted(r["run_id"] for r in contract.open_failures(log).collect()) == [1, 4, 5]
    note = f"TIMESTAMP_NTZ '{AT}', 'it''s fixed'"
    for call, other in (
        (f"feed_resolve_stream('a', {note})", contract.resolve_stream(log, "a", AT, "it's fixed")),
        (f"feed_resolve_run(2, {note})", contract.resolve_run(log, 2, AT, "it's fixed")),
        (f"feed_resolve_run(4, TIMESTAMP_NTZ '{AT}')", contract.resolve_run(log, 4, AT)),
        (f"feed_resolve_stream(NULL, {note})", log),
    ):
        assert h.rows(spark.sql(f"SELECT * FROM {call}"), "run_id", "resolved", "resolved_at", "resolved_note") == h.rows(
            other, "run_id", "resolved", "resolved_at", "resolved_note"
        )


def test_toggle_equals_the_operator(spark):
    df = spark.createDataFrame([("A", True, None), ("B", True, AT), (None, True, AT)], "city string, is_active boolean, updated_at timestamp")
    df.createOrReplaceTempView("cities_t")
    sql.register_config(spark, "cities_t", "city")
    got = spark.sql(f"SELECT * FROM feed_toggle_active('A', false, TIMESTAMP_NTZ '{AT}')")
    assert h.rows(got) == h.rows(toggle_active(df, F.col("city") == "A", False, AT))


def test_columns_named_like_arguments_are_refused(spark):
    _log(spark).withColumnRenamed("run_ts", "Done_At").createOrReplaceTempView("clash_t")
    with pytest.raises(ValueError, match="done_at"):
        sql.register_log(spark, "clash_t")
