"""Contract, audit, schema tests and keyed maintenance on the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import ntz
from tidemark.operators import checks, contract, maintain
from tidemark.operators.contract import Rule
from tidemark.queries import derived as d
from tidemark.queries.models_on_tables import MODELS
from tidemark.queries.oracle import chain
from tidemark.queries.registry import query, table
from tidemark.sources.mappings import FIELD_MAPPINGS, Mapping

RUN_AT = datetime(2024, 2, 1, 6, 0)
RESOLVED_AT = datetime(2024, 2, 1, 9, 0)
WINDOW_MINUTES = 30 * 24 * 60

# One rule of every type, plus a mistyped column, an inactive column and a rule that cannot be evaluated.
FIELDS = [
    *FIELD_MAPPINGS["current_weather"],
    Mapping("never_there", "sys.country || cast(null as string)", None, True, True, 90),
    Mapping("retired", "name", None, False, False, 91),
    Mapping("renamed_upstream", "no_such_field", None, True, True, 92),
]
RULES = [
    Rule(None, "freshness_minutes", "120", "warn"),
    Rule(None, "min_row_count", "1", "error"),
    Rule("feels_like_celsius", "max_null_pct", "10", "error"),
    Rule("humidity_pct", "max", "98", "warn"),
    Rule("pressure_hpa", "not_null", "", "error"),
    Rule("rain_1h_mm", "max_null_pct", "10", "warn"),
    Rule("retired", "not_null", "", "error"),
    Rule("snow_1h_mm", "not_null", "", "warn"),
    Rule("temp_celsius", "min", "-9", "error"),
    Rule("temp_celsius", "unheard_of", "1", "warn"),
    Rule("tempreature", "min", "0", "error"),
    Rule("weather_main", "accepted_values", '["Clear", "Clouds", "Rain"]', "error"),
]


def _line(column: str, check: str, status: str, severity: str, rows: str, nulls: str = "NULL") -> str:
    column = f"'{column}'" if column else "NULL"
    return (
        f"SELECT 'current_weather' AS stream_name, {column} AS target_column, '{check}' AS check_type, {status} AS status, "
        f"'{severity}' AS severity, CAST({rows} AS BIGINT) AS rows_checked, CAST({nulls} AS BIGINT) AS null_count FROM t"
    )


def _required(column: str) -> str:
    filled = f"n_{column}"
    return _line(column, "required", f"CASE WHEN n > 0 AND {filled} = 0 THEN 'null' ELSE 'ok' END", "error", "n", f"n - {filled}")


def _breach(column: str, check: str, condition: str, severity: str) -> str:
    return _line(column, check, f"CASE WHEN {condition} THEN 'below_threshold' ELSE 'ok' END", severity, "n")


AUDIT_SQL = (
    chain("stg_current_weather")
    + ", b AS (SELECT * FROM stg_current_weather WHERE extracted_at >= (SELECT max(extracted_at) FROM stg_current_weather) "
    f"- INTERVAL {WINDOW_MINUTES} MINUTE), t AS (SELECT count(*) AS n, count(city) AS n_city, count(temp_celsius) AS n_temp_celsius, "
    "count(observed_at) AS n_observed_at, 0 AS n_never_there, count(*) FILTER (WHERE humidity_pct > 98) AS humid, "
    "count(*) - count(rain_1h_mm) AS no_rain, count(*) - count(snow_1h_mm) AS no_snow, count(*) - count(feels_like_celsius) AS no_feel, "
    "count(*) - count(pressure_hpa) AS no_pressure, count(*) FILTER (WHERE temp_celsius < -9) AS cold, "
    "count(*) FILTER (WHERE weather_main NOT IN ('Clear', 'Clouds', 'Rain')) AS odd, max(extracted_at) AS newest FROM b), a AS ("
    + " UNION ALL ".join([
        _required("city"), _required("temp_celsius"), _required("observed_at"), _required("never_there"),
        _line("renamed_upstream", "required", "'missing'", "error", "n"),
        _breach("", "freshness_minutes", f"newest < TIMESTAMP '{RUN_AT}' - INTERVAL 120 MINUTE", "warn"),
        _breach("", "min_row_count", "n < 1", "error"),
        _breach("feels_like_celsius", "max_null_pct", "10 * no_feel > n", "error"),
        _breach("humidity_pct", "max", "humid > 0", "warn"),
        _breach("pressure_hpa", "not_null", "no_pressure > 0", "error"),
        _breach("rain_1h_mm", "max_null_pct", "10 * no_rain > n", "warn"),
        _line("retired", "not_null", "'ok'", "error", "n"),
        _breach("snow_1h_mm", "not_null", "no_snow > 0", "warn"),
        _breach("temp_celsius", "min", "cold > 0", "error"),
        _line("temp_celsius", "unheard_of", "'missing'", "error", "n"),
        _line("tempreature", "min", "'config_warning'", "warn", "NULL"),
        _breach("weather_main", "accepted_values", "odd > 0", "error"),
    ])
    + ")"
)
_CERTIFY = (
    " UNION ALL SELECT 'current_weather', NULL, 'certify', 'certified', 'warn', n, NULL FROM t WHERE NOT EXISTS "
    "(SELECT 1 FROM a WHERE status IN ('missing', 'null') OR (status = 'below_threshold' AND severity = 'error'))"
)


def audit(spark: SparkSession, sf: str) -> DataFrame:
    """All checks over the last 30 days of the derived weather feed, in one aggregate."""
    landing = d.landing(spark, sf, "current_weather")
    return contract.stream_audit(landing, "current_weather", FIELDS, RULES, RUN_AT, WINDOW_MINUTES)


COUNTS = ("rows_checked", "null_count")
_COUNTS = "* REPLACE (CAST(rows_checked AS DOUBLE) AS rows_checked, CAST(null_count AS DOUBLE) AS null_count)"


@query("contract_audit", f"{AUDIT_SQL} SELECT {_COUNTS} FROM (SELECT * FROM a{_CERTIFY})", COUNTS)
def contract_audit(spark, sf):
    return audit(spark, sf).drop("detail")


@query(
    "contract_certified",
    f"{chain('stg_air_pollution')} SELECT {_COUNTS} FROM (SELECT 'air_pollution' AS stream_name, c.target_column, c.check_type, c.status, c.severity, "
    "CAST((SELECT count(*) FROM stg_air_pollution WHERE extracted_at >= (SELECT max(extracted_at) FROM stg_air_pollution) - INTERVAL 5 MINUTE) AS BIGINT) "
    "AS rows_checked, CAST(c.nulls AS BIGINT) AS null_count FROM (VALUES ('city', 'required', 'ok', 'error', 0), ('aqi', 'required', 'ok', 'error', 0), "
    "('pm2_5_ug_m3', 'required', 'ok', 'error', 0), ('observed_at', 'required', 'ok', 'error', 0), (NULL, 'min_row_count', 'ok', 'error', NULL), "
    "('aqi', 'accepted_values', 'ok', 'error', NULL), (NULL, 'certify', 'certified', 'warn', NULL)) AS c(target_column, check_type, status, severity, nulls))",
    COUNTS,
)
def contract_certified(spark, sf):
    """The seeded rules of a clean feed over its latest batch: everything passes, the stream is certified."""
    rules = [Rule(None, "min_row_count", "1"), Rule("aqi", "accepted_values", "[1,2,3,4,5]")]
    landing = d.landing(spark, sf, "air_pollution")
    return contract.stream_audit(landing, "air_pollution", FIELD_MAPPINGS["air_pollution"], rules, RUN_AT).drop("detail")


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return contract.as_runs(audit(spark, sf), RUN_AT, "run-1")


_OPEN = "status IN ('missing', 'null', 'below_threshold', 'config_warning')"


@query(
    "contract_open",
    f"{AUDIT_SQL} SELECT TIMESTAMP '{RUN_AT}' AS run_ts, 'run-1' AS pipeline_run_id, stream_name, target_column, check_type, status FROM a WHERE {_OPEN}",
)
def contract_open(spark, sf):
    return contract.open_failures(runs(spark, sf)).drop("run_id", "detail")


@query(
    "contract_resolve",
    f"{AUDIT_SQL}, x AS (SELECT * FROM a{_CERTIFY}) SELECT stream_name, target_column, check_type, status, {_OPEN} AS resolved, "
    f"CASE WHEN {_OPEN} THEN TIMESTAMP '{RESOLVED_AT}' END AS resolved_at, CASE WHEN {_OPEN} THEN 'sensor replaced' END AS resolved_note FROM x",
)
def contract_resolve(spark, sf):
    resolved = contract.resolve_stream(runs(spark, sf), "current_weather", RESOLVED_AT, "sensor replaced")
    return resolved.select("stream_name", "target_column", "check_type", "status", "resolved", "resolved_at", "resolved_note")


_LOG_SQL = (
    "SELECT event_id AS run_id, ts AS run_ts, event_type AS stream_name, CASE WHEN value > 100 THEN 'below_threshold' WHEN value > 50 THEN 'null' ELSE 'ok' END "
    "AS status, value > 200 AS resolved FROM events"
)


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as an audit log: the event type is the stream, the value decides the status."""
    v = F.col("value")
    none = F.lit(None)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.col("ts").cast("timestamp").alias("run_ts"), F.col("event_type").alias("stream_name"),
        F.when(v > 100, "below_threshold").when(v > 50, "null").otherwise("ok").alias("status"), (v > 200).alias("resolved"),
        none.cast("timestamp").alias("resolved_at"), none.cast("string").alias("resolved_note"),
    )


@query("log_open", f"WITH g AS ({_LOG_SQL}) SELECT run_id, run_ts, stream_name, status FROM g WHERE NOT resolved AND status <> 'ok'")
def log_open(spark, sf):
    return contract.open_failures(event_log(spark, sf))


@query(
    "log_resolve_stream",
    f"WITH g AS ({_LOG_SQL}), h AS (SELECT *, NOT resolved AND status <> 'ok' AND stream_name = 'error' AS hit FROM g) "
    f"SELECT run_id, run_ts, stream_name, status, resolved OR hit AS resolved, CASE WHEN hit THEN TIMESTAMP '{RESOLVED_AT}' END AS resolved_at, "
    "CASE WHEN hit THEN 'outage over' END AS resolved_note FROM h",
)
def log_resolve_stream(spark, sf):
    return contract.resolve_stream(event_log(spark, sf), "error", RESOLVED_AT, "outage over")


@query(
    "log_resolve_run",
    f"WITH g AS ({_LOG_SQL}) SELECT run_id, run_ts, stream_name, status, resolved OR run_id = 7 AS resolved, "
    f"CASE WHEN run_id = 7 THEN TIMESTAMP '{RESOLVED_AT}' END AS resolved_at, CASE WHEN run_id = 7 THEN 'fixed' END AS resolved_note FROM g",
)
def log_resolve_run(spark, sf):
    return contract.resolve_run(event_log(spark, sf), 7, RESOLVED_AT, "fixed")


# ---- schema tests ---------------------------------------------------------------------------------


@query("test_unique", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def test_unique(spark, sf):
    return checks.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "test_not_null",
    f"{chain('int_city_hourly_weather')} SELECT city_hour_key, city, weather_main FROM int_city_hourly_weather WHERE weather_main IS NULL",
)
def test_not_null(spark, sf):
    rows = MODELS["int_city_hourly_weather"](spark, sf).select("city_hour_key", "city", "weather_main")
    return checks.null_rows(rows, "weather_main")


@query(
    "test_relationships",
    "SELECT c_custkey, count(*) AS n FROM customer WHERE c_custkey IS NOT NULL AND c_custkey NOT IN (SELECT user_id FROM events) GROUP BY c_custkey",
)
def test_relationships(spark, sf):
    """Customers without any event, as orphans of the events' users."""
    return checks.orphans(table(spark, sf, "customer").select("c_custkey"), "c_custkey", table(spark, sf, "events"), "user_id")


@query(
    "test_accepted_values",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
)
def test_accepted_values(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return checks.outside_values(orders, "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"))


SUITE = {
    "orders": checks.TableTests(
        unique=("o_orderkey",), not_null=("o_orderkey", "o_custkey"), relationships=(("o_custkey", "customer", "c_custkey"),),
        accepted=(("o_orderstatus", ("F", "O")),),
    ),
    "lineitem": checks.TableTests(unique=("l_orderkey",), relationships=(("l_orderkey", "orders", "o_orderkey"), ("l_suppkey", "supplier", "s_suppkey"))),
    "customer": checks.TableTests(unique=("c_custkey",), relationships=(("c_custkey", "events", "user_id"),)),
}


@query(
    "schema_tests",
    "SELECT table_name, column_name, test, CAST(violations AS BIGINT) AS violations FROM ("
    "SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders UNION ALL "
    "SELECT 'orders', 'o_custkey', 'not_null', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders UNION ALL "
    "SELECT 'orders', 'o_orderstatus', 'accepted_values', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders UNION ALL "
    "SELECT 'orders', 'o_orderkey', 'unique', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL "
    "SELECT 'orders', 'o_custkey', 'relationships', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL "
    "SELECT 'lineitem', 'l_orderkey', 'unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) UNION ALL "
    "SELECT 'lineitem', 'l_orderkey', 'relationships', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL "
    "SELECT 'lineitem', 'l_suppkey', 'relationships', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL "
    "SELECT 'customer', 'c_custkey', 'unique', count(*) FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1) UNION ALL "
    "SELECT 'customer', 'c_custkey', 'relationships', count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events))",
)
def schema_tests(spark, sf):
    names = ("orders", "lineitem", "customer", "supplier", "events")
    return checks.run_tests({n: table(spark, sf, n) for n in names}, SUITE)


# ---- keyed maintenance ----------------------------------------------------------------------------

TOUCHED = datetime(2024, 2, 2)
OLD_DAY = "2023-01-01 00:00:00"


def _accounts(spark: SparkSession, sf: str, half: str) -> DataFrame:
    """Old half: customers with a positive balance (``all``: any). New half: those of two segments, with changes."""
    c = table(spark, sf, "customer")
    if half in ("old", "all"):
        return (c if half == "all" else c.filter("c_acctbal > 0")).select(
            "c_custkey", "c_name", "c_nationkey", (F.col("c_mktsegment") != "MACHINERY").alias("is_active"),
            F.lit(OLD_DAY).cast("timestamp").alias("updated_at"),
        )
    return c.filter(F.col("c_mktsegment").isin("MACHINERY", "BUILDING")).select(
        "c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_nationkey") + 100).alias("c_nationkey"),
        F.lit(True).alias("is_active"), ntz(TOUCHED).cast("timestamp").alias("updated_at"),
    )


_OLD = (
    f"o AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment <> 'MACHINERY' AS is_active, TIMESTAMP '{OLD_DAY}' AS updated_at FROM customer WHERE c_acctbal > 0)"
)
_NEW = (
    f"n AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey + 100 AS c_nationkey, TRUE AS is_active, TIMESTAMP '{TOUCHED}' AS updated_at FROM customer "
    "WHERE c_mktsegment IN ('MACHINERY', 'BUILDING'))"
)


@query(
    "upsert",
    f"WITH {_OLD}, {_NEW} SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name, "
    "coalesce(n.c_nationkey, o.c_nationkey) AS c_nationkey, coalesce(o.is_active, n.is_active) AS is_active, "
    "coalesce(n.updated_at, o.updated_at) AS updated_at FROM o FULL JOIN n ON o.c_custkey = n.c_custkey",
)
def upsert(spark, sf):
    """Named columns are refreshed, the operators' switch survives, the change time is touched."""
    return maintain.upsert(
        _accounts(spark, sf, "old"), _accounts(spark, sf, "new"), ["c_custkey"], ["c_name", "c_nationkey"], TOUCHED
    )


@query(
    "insert_if_absent",
    f"WITH {_OLD}, {_NEW} SELECT * FROM o UNION ALL SELECT * FROM n WHERE c_custkey NOT IN (SELECT c_custkey FROM o)",
)
def insert_if_absent(spark, sf):
    return maintain.insert_if_absent(_accounts(spark, sf, "old"), _accounts(spark, sf, "new"), ["c_custkey"])


@query(
    "cascade_delete",
    "WITH g AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0) SELECT 'customer' AS side, c_custkey AS id, c_custkey FROM customer "
    "WHERE c_custkey NOT IN (FROM g) UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (FROM g)",
)
def cascade_delete(spark, sf):
    """Customers in debt are removed together with their orders."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    left, links = maintain.cascade_delete(customers, orders, customers.filter("c_acctbal < 0"), "c_custkey")
    return left.select(F.lit("customer").alias("side"), F.col("c_custkey").alias("id"), "c_custkey").unionByName(
        links.select(F.lit("orders").alias("side"), F.col("o_orderkey").alias("id"), "c_custkey")
    )


@query(
    "toggle_active",
    f"WITH {_OLD.replace(' WHERE c_acctbal > 0', '')} SELECT c_custkey, c_name, c_nationkey, is_active AND c_nationkey <> 3 AS is_active, "
    f"CASE WHEN c_nationkey = 3 THEN TIMESTAMP '{TOUCHED}' ELSE updated_at END AS updated_at FROM o",
)
def toggle_active(spark, sf):
    return maintain.toggle_active(_accounts(spark, sf, "all"), F.col("c_nationkey") == 3, False, TOUCHED)
