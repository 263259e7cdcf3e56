"""Stored sketches and key marks, and the functions for plain SQL, on the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import sql
from tidemark.functions.labels import AQI_NAMES, COMFORT_FLOORS, COMFORT_REST, DELAY_NAMES, NO_DATA
from tidemark.operators import keymarks, sketches
from tidemark.queries import oracle as o
from tidemark.queries import quality_on_tables as quality
from tidemark.queries.registry import REGISTRY, query, table
from tidemark.session import scratch_dir
from tidemark.sources.partitions import write_days

# ---- distinct counts that merge -------------------------------------------------------------------

HALF = date(2024, 1, 11)


@query(
    "distinct_ranges",
    "WITH s AS (SELECT * FROM events WHERE value > 50 OR CAST(ts AS DATE) >= DATE '2024-01-11') "
    "SELECT event_type, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, count(DISTINCT user_id) AS users, "
    "count(DISTINCT user_id) FILTER (WHERE value > 100) AS users_above_100, TRUE AS near FROM s GROUP BY 1, 2",
)
def distinct_ranges(spark, sf):
    """Two arrivals store sketches by day: a part of all days, then the later days whole, which replaces their sketches.

    Weeks are unions of their days' sketches; ``near`` says that they lie within four standard errors of the exact counts.
    """
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    items = {"users": F.col("user_id"), "users_above_100": F.when(F.col("value") > 100, F.col("user_id"))}
    path = scratch_dir(spark, "sketches")
    late = F.col("day") >= F.lit(HALF)
    for arrival in (events.filter("value > 50"), events.filter(late)):
        sketches.refresh_sketches(spark, path, arrival, ["event_type"], "day", items)
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    days = spark.read.schema("event_type string, users binary, users_above_100 binary, day date").parquet(path)
    guess = sketches.merged_counts(days.select("*", week), ["event_type", "week"], list(items))
    per_user = events.filter((F.col("value") > 50) | late).groupBy("event_type", week, "user_id").agg(F.max(F.col("value") > 100).alias("above"))
    exact = per_user.groupBy("event_type", "week").agg(
        F.count("user_id").alias("users"), F.count_if(F.col("above") & F.col("user_id").isNotNull()).alias("users_above_100")
    )
    both = exact.alias("x").join(guess.alias("g"), ["event_type", "week"])
    apart = [F.abs(F.col(f"x.{i}") - F.col(f"g.{i}")) <= sketches.relative_error(4) * F.col(f"x.{i}") + 0.5 for i in items]
    return both.select("event_type", "week", *[F.col(f"x.{i}") for i in items], (apart[0] & apart[1]).alias("near"))


# ---- uniqueness over all history ------------------------------------------------------------------

NEWEST = "2001-01"
_ORDER_KEYS = (
    "SELECT o_custkey * 1000 + CAST(floor(o_totalprice / 1000) AS BIGINT) AS order_key, strftime(o_orderdate, '%Y-%m') AS month FROM orders"
)


@query(
    "test_unique_marked",
    f"WITH k AS ({_ORDER_KEYS}) SELECT order_key, count(*) AS n FROM k GROUP BY order_key "
    f"HAVING count(*) > 1 AND count(*) FILTER (WHERE month >= '{NEWEST}') > 0",
)
def test_unique_marked(spark, sf):
    """Orders of the newest months against all stored months, of which only those with a set key bit are read."""
    keys = table(spark, sf, "orders").select(
        (F.col("o_custkey") * 1000 + F.floor(F.col("o_totalprice") / 1000)).cast("bigint").alias("order_key"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    root = scratch_dir(spark, "marked")
    write_days(keys.filter(F.col("month") < NEWEST), f"{root}/orders", "month")
    history = spark.read.schema("order_key bigint, month string").parquet(f"{root}/orders")
    keymarks.refresh_marks(spark, f"{root}/marks", history, "order_key", "month", whole=True)
    marks = keymarks.stored_marks(spark, f"{root}/marks", "month", "string")
    return keymarks.duplicate_new_keys(spark, keys.filter(F.col("month") >= NEWEST), history, marks, "order_key", "month")


# ---- functions for plain SQL ----------------------------------------------------------------------


def _cases(values: dict[int, str], arg: str) -> str:
    return f"CASE {arg} {' '.join(f'WHEN {k} THEN {v!r}' for k, v in values.items())} END"


_SCORE = "CAST(CAST(value AS DECIMAL(18,2)) * 0.002 AS DECIMAL(18,6))"
_STEPS = " ".join(f"WHEN {_SCORE} >= {bound} THEN {name!r}" for bound, name in COMFORT_FLOORS)


@query(
    "sql_scalars",
    f"SELECT event_id, {o.datekey('CAST(ts AS DATE)')} AS date_key, {o.key('event_type', 'user_id')} AS user_key, "
    f"{_cases(AQI_NAMES, '(user_id % 6)')} AS aqi, {_cases(DELAY_NAMES, '(user_id % 6)')} AS delay, "
    f"CASE WHEN value IS NULL THEN {NO_DATA!r} {_STEPS} ELSE {COMFORT_REST!r} END AS comfort FROM events",
)
def sql_scalars(spark, sf):
    sql.register_scalars(spark)
    table(spark, sf, "events").createOrReplaceTempView("feed_events")
    return spark.sql(
        "SELECT event_id, feed_date_key(CAST(ts AS DATE)) AS date_key, feed_surrogate_key(array(event_type, CAST(user_id AS STRING))) AS user_key, "
        "feed_aqi_label(CAST(user_id % 6 AS INT)) AS aqi, feed_delay_severity(CAST(user_id % 6 AS INT)) AS delay, "
        f"feed_comfort_label({_SCORE}) AS comfort FROM feed_events"
    )


def _log(spark, sf):
    quality.event_log(spark, sf).createOrReplaceTempView("feed_event_log")
    sql.register_log(spark, "feed_event_log")


@query(
    "sql_open_failures",
    f"WITH g AS ({quality._LOG_SQL}) SELECT stream_name, status, count(*) AS n, max(run_ts) AS newest FROM g "
    "WHERE NOT resolved AND status <> 'ok' GROUP BY 1, 2",
)
def sql_open_failures(spark, sf):
    _log(spark, sf)
    return spark.sql("SELECT stream_name, status, count(*) AS n, max(run_ts) AS newest FROM feed_open_failures() GROUP BY stream_name, status")


@query("sql_resolve_stream", REGISTRY["log_resolve_stream"].sql)
def sql_resolve_stream(spark, sf):
    _log(spark, sf)
    return spark.sql(f"SELECT * FROM feed_resolve_stream('error', TIMESTAMP_NTZ '{quality.RESOLVED_AT}', 'outage over')")


@query("sql_resolve_run", REGISTRY["log_resolve_run"].sql)
def sql_resolve_run(spark, sf):
    _log(spark, sf)
    return spark.sql(f"SELECT * FROM feed_resolve_run(7, TIMESTAMP_NTZ '{quality.RESOLVED_AT}', 'fixed')")


@query(
    "sql_toggle_active",
    "SELECT c_custkey, is_active AND c_custkey <> 3 AS is_active, CASE WHEN c_custkey = 3 THEN TIMESTAMP "
    f"'{quality.TOUCHED}' ELSE TIMESTAMP '{quality.OLD_DAY}' END AS updated_at FROM (SELECT c_custkey, c_mktsegment <> 'MACHINERY' AS is_active FROM customer)",
)
def sql_toggle_active(spark, sf):
    quality._accounts(spark, sf, "all").createOrReplaceTempView("feed_accounts")
    sql.register_config(spark, "feed_accounts", "c_custkey")
    return spark.sql(f"SELECT c_custkey, is_active, updated_at FROM feed_toggle_active(3, false, TIMESTAMP_NTZ '{quality.TOUCHED}')")
