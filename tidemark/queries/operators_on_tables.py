"""Single operators on the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import labels
from tidemark.functions.keys import date_key, surrogate_key
from tidemark.functions.measures import (
    avg_rounded,
    comfort_index,
    comfort_parts,
    exact,
    max_rounded,
    min_rounded,
    most_frequent,
    ratio_rounded,
    rounded,
    share_rounded,
    sum_or_zero,
)
from tidemark.functions.times import hour_of
from tidemark.operators import dims
from tidemark.operators.dedupe import Ranking, keep_latest, latest_reading
from tidemark.operators.rollup import distinct_counts, mode_and_means
from tidemark.operators.staging import build_staging
from tidemark.operators.trends import previous, prior_avg, rolling_avg
from tidemark.plans.models import one_row_per
from tidemark.queries import derived as d
from tidemark.queries import oracle as o
from tidemark.queries.registry import query, table
from tidemark.session import scratch_dir
from tidemark.sources import bodies
from tidemark.sources import landing as land
from tidemark.sources.mappings import FIELD_MAPPINGS, Mapping

# ---- shared inputs --------------------------------------------------------------------------------

EVENT_MAPPINGS = [
    Mapping("city", "user_id", "bigint", True, True, 1),
    Mapping("event_type", "event_type", None, False, True, 2),
    Mapping("value", "v", "decimal(18,2)", True, True, 3),
    Mapping("k", "k", "int", False, True, 4),
    Mapping("observed_at", "ts", None, True, True, 5),
]
HOUR_RANK = Ranking(("city", "date_utc", "hour_utc"), ("observed_at", "extracted_at"), ("value",))

L_SQL = (
    "L AS (SELECT raw_id, extracted_at, user_id AS city, event_type, CAST(v AS DECIMAL(18,2)) AS value, k, ts AS observed_at FROM syncs)"
)
H_SQL = (
    "H AS (SELECT *, CAST(observed_at AS DATE) AS date_utc, CAST(hour(observed_at) AS INTEGER) AS hour_utc FROM L QUALIFY row_number() "
    "OVER (PARTITION BY city, date_trunc('hour', observed_at) ORDER BY observed_at DESC, extracted_at DESC) = 1)"
)
D_SQL = (
    f"D AS (SELECT city, date_utc, {o.avg('value', 2)} AS avg_value, min(value) AS min_value, max(value) AS max_value, "
    "sum(value) AS sum_value, count(*) AS n FROM H GROUP BY city, date_utc)"
)
BASE_SQL = f"WITH {d.SYNCS_SQL}, {L_SQL}, {H_SQL}, {D_SQL}"


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """Both syncs of the events, through the config-driven projection."""
    return build_staging(d.syncs(spark, sf), EVENT_MAPPINGS)


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    rows = landed(spark, sf).filter(F.col("city").isNotNull()).withColumns(
        {"date_utc": F.to_date("observed_at"), "hour_utc": F.hour("observed_at")}
    )
    return keep_latest(rows, HOUR_RANK)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return hourly(spark, sf).groupBy("city", "date_utc").agg(
        avg_rounded("value", 2).alias("avg_value"),
        min_rounded("value", 2).alias("min_value"),
        max_rounded("value", 2).alias("max_value"),
        sum_or_zero("value", 2).alias("sum_value"),
        F.count(F.lit(1)).alias("n"),
    )


def base_sql(select: str) -> str:
    return f"{BASE_SQL}\n{select}"


# ---- staging --------------------------------------------------------------------------------------

_STG = "SELECT raw_id, extracted_at, city, event_type, CAST(value AS DOUBLE) AS value, {k}observed_at FROM L"


@query("stg_project", base_sql(_STG.format(k="k, ")))
def stg_project(spark, sf):
    return landed(spark, sf)


@query("stg_inactive_field", base_sql(_STG.format(k="")))
def stg_inactive_field(spark, sf):
    """An inactive mapping makes its column disappear."""
    mappings = [m._replace(is_active=m.target_column != "k") for m in EVENT_MAPPINGS]
    return build_staging(d.syncs(spark, sf), mappings)


def _payloads(spark: SparkSession, sf: str, body) -> DataFrame:
    rows = d.syncs(spark, sf).withColumn("location_id", F.col("user_id"))
    return rows.select("raw_id", "extracted_at", "location_id", F.to_json(body).alias("payload"))


def _components(factor: str):
    names = {"co": "1.5", "no": "0.01", "no2": "0.9", "o3": "0.3", "so2": "0.1", "pm2_5": "0.2", "pm10": "0.4", "nh3": "0.05"}
    return F.struct(*[F.expr(d.num(f"v * {f} * {factor}")).alias(n) for n, f in names.items()])


@query(
    "extract_records",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, user_id AS location_id, aqi, CAST(v * f * 0.2 AS DOUBLE) AS pm2_5_ug_m3, "
    "date_trunc('second', ts) + to_hours(h) AS observed_at FROM (SELECT *, code AS aqi, CAST(1 AS DECIMAL(2,1)) AS f, 0 AS h FROM syncs "
    "UNION ALL SELECT *, 6 - code, CAST(0.5 AS DECIMAL(2,1)), 1 FROM syncs)",
)
def extract_records(spark, sf):
    """Responses with a record array: packed to JSON text per event, then parsed and exploded."""
    record = lambda aqi, factor, shift: F.struct(
        (F.col("dt") + shift).alias("dt"), F.struct(F.expr(aqi).alias("aqi")).alias("main"), _components(factor).alias("components")
    )
    body = F.struct(F.array(record("code", "1.0", 0), record("6 - code", "0.5", 3600)).alias("list"))
    records = land.extract_records(_payloads(spark, sf, body), "air_pollution")
    mapped = build_staging(records.withColumn("city", F.col("location_id").cast("string")), FIELD_MAPPINGS["air_pollution"])
    return mapped.select("raw_id", F.col("city").cast("bigint").alias("location_id"), "aqi", "pm2_5_ug_m3", "observed_at")


# Bodies by k: cut off, without records, with a second record whose aqi or whose components are no such thing, or whole.
_BROKEN = (
    "case when k % 10 = 0 then 'cut' when k % 10 = 1 then 'none' when k % 10 = 2 then 'aqi' when k % 10 = 3 then 'components' else 'whole' end"
)


def _bodies(spark, sf):
    def record(aqi: str, factor: str, shift: int) -> Column:
        return F.struct((F.col("dt") + shift).alias("dt"), F.struct(F.expr(aqi).alias("aqi")).alias("main"), _components(factor).alias("components"))

    packed = F.to_json(F.struct(F.array(record("code", "1.0", 0), record("6 - code", "0.5", 3600)).alias("list")))
    text = F.col("text")  # a column of its own, so that it is packed once for all its uses
    second = F.concat(F.lit('"main":{"aqi":'), F.expr("6 - code").cast("string"), F.lit('},"components":{'))
    body = (
        F.when(F.col("broken") == "cut", F.substr(text, F.lit(1), F.length(text) - 7))
        .when(F.col("broken") == "none", F.lit('{"message":"no data"}'))
        .when(F.col("broken") == "aqi", _swap_last(text, second, F.lit('"main":{"aqi":"high"},"components":{')))
        .when(F.col("broken") == "components", _swap_last(text, F.lit('"components":{'), F.lit('"components":7,"extra":{')))
        .otherwise(text)
    )
    rows = d.flat(d.syncs(spark, sf), d.POLLUTION).withColumns({"broken": F.expr(_BROKEN), "text": packed})
    return rows.select("city", F.col("extracted_at").alias("synced_at"), F.col("raw_id").alias("request_id"), body.alias("payload"))


def _swap_last(text: Column, old: Column, new: Column) -> Column:
    """Replace the last occurrence."""
    at = F.length(text) - F.instr(F.reverse(text), F.reverse(old)) - F.length(old) + 1
    return F.concat(F.substr(text, F.lit(1), at), new, F.substr(text, at + F.length(old) + 1))


def _landed_bodies(spark, sf) -> str:
    root = scratch_dir(spark, "bodies")
    bodies.land_bodies(_bodies(spark, sf), root, "air_pollution", F.col("synced_at"))
    return root


@query(
    "body_records",
    f"WITH {d.SYNCS_SQL}, b AS (SELECT *, {_BROKEN} AS broken FROM syncs) SELECT city, extracted_at, aqi, CAST(v * f * 0.2 AS DOUBLE) AS pm2_5_ug_m3, "
    "date_trunc('second', ts) + to_hours(h) AS observed_at FROM (SELECT *, code AS aqi, CAST(1 AS DECIMAL(2,1)) AS f, 0 AS h FROM b WHERE broken NOT IN ('cut', 'none') "
    "UNION ALL SELECT *, 6 - code, CAST(0.5 AS DECIMAL(2,1)), 1 FROM b WHERE broken = 'whole')",
)
def body_records(spark, sf):
    """The whole records of bodies that are partly broken, read back from landing."""
    landed = land.read_landing(spark, _landed_bodies(spark, sf), "air_pollution")
    return build_staging(landed, FIELD_MAPPINGS["air_pollution"]).select("city", "extracted_at", "aqi", "pm2_5_ug_m3", "observed_at")


@query(
    "dead_letters",
    f"WITH {d.SYNCS_SQL}, b AS (SELECT *, {_BROKEN} AS broken FROM syncs) SELECT raw_id AS request_id, city, extracted_at, "
    "CASE broken WHEN 'cut' THEN 'not_json' WHEN 'none' THEN 'no_record' ELSE 'bad_value' END AS reason, "
    "CASE broken WHEN 'aqi' THEN '$.main.aqi' WHEN 'components' THEN '$.components' END AS path, "
    "CASE WHEN broken IN ('aqi', 'components') THEN 1.0 END::DOUBLE AS position, CASE WHEN broken = 'none' THEN '{\"message\":\"no data\"}' END AS short_body "
    "FROM b WHERE broken <> 'whole'",
    ("position",),
)
def dead_letters(spark, sf):
    """Broken bodies and records with their reasons; the raw body is kept."""
    dead = bodies.read_dead_letters(spark, _landed_bodies(spark, sf), "air_pollution")
    body = F.when(F.length("payload") < 30, F.col("payload")).alias("short_body")
    return dead.select("request_id", "city", "extracted_at", "reason", "path", "position", body)


@query(
    "extract_nested_object",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, user_id AS location_id, 'FRC' || code AS frc, k AS current_speed, k + (code - 1) * 5 AS free_flow_speed, "
    "k >= 95 AS road_closure FROM syncs",
)
def extract_nested_object(spark, sf):
    """Responses whose record is a nested object."""
    flow = d.flat(d.syncs(spark, sf), d.FLOW)
    inner = F.struct(
        F.col("f_road_class").alias("frc"), F.col("f_current_speed_kmh").alias("currentSpeed"),
        F.col("f_free_flow_speed_kmh").alias("freeFlowSpeed"), F.col("f_road_closure").alias("roadClosure"),
    )
    payloads = flow.select("raw_id", F.col("user_id").alias("location_id"), F.to_json(F.struct(inner.alias("flowSegmentData"))).alias("payload"))
    return land.extract_records(payloads, "traffic_flow").select(
        "raw_id", "location_id", "frc", F.col("currentSpeed").alias("current_speed"),
        F.col("freeFlowSpeed").alias("free_flow_speed"), F.col("roadClosure").alias("road_closure"),
    )


@query(
    "tag_partition",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, c_name AS city, v_k.k FROM (SELECT raw_id, user_id, k FROM syncs) v_k LEFT JOIN customer ON c_custkey = user_id",
)
def tag_partition(spark, sf):
    """Records carry the id of the requested location; the location table names the city."""
    locations = table(spark, sf, "customer").select(F.col("c_custkey").alias("location_id"), F.col("c_name").alias("city"))
    records = d.syncs(spark, sf).select("raw_id", F.col("user_id").alias("location_id"), "k")
    return land.tag_partition(records, locations)


# ---- dedupe ---------------------------------------------------------------------------------------


@query(
    "dedupe_hour",
    base_sql(
        f"SELECT {o.key('city', 'date_trunc(\'hour\', observed_at)')} AS city_hour_key, raw_id, city, observed_at, extracted_at, "
        "CAST(value AS DOUBLE) AS value, event_type FROM H"
    ),
)
def dedupe_hour(spark, sf):
    return hourly(spark, sf).select(
        surrogate_key("city", hour_of("observed_at")).alias("city_hour_key"),
        "raw_id", "city", "observed_at", "extracted_at", "value", "event_type",
    )


@query(
    "dedupe_key",
    base_sql(
        "SELECT raw_id, city, event_type, observed_at, extracted_at FROM L QUALIFY row_number() OVER "
        "(PARTITION BY city, event_type, observed_at ORDER BY extracted_at DESC) = 1"
    ),
)
def dedupe_key(spark, sf):
    rows = landed(spark, sf).select("raw_id", "city", "event_type", "observed_at", "extracted_at")
    return keep_latest(rows, Ranking(("city", "event_type", "observed_at"), ("extracted_at",)))


@query(
    "latest_reading",
    base_sql(
        "SELECT city, observed_at, event_type, CAST(value AS DOUBLE) AS value FROM H QUALIFY row_number() OVER "
        "(PARTITION BY city ORDER BY observed_at DESC) = 1"
    ),
)
def newest_reading(spark, sf):
    return latest_reading(hourly(spark, sf).select("city", "observed_at", "event_type", "value"), ["city"], "observed_at")


# ---- rollups --------------------------------------------------------------------------------------


@query(
    "daily_rollup",
    base_sql(
        "SELECT city, CAST(date_utc AS VARCHAR) AS date_utc, CAST(avg_value AS DOUBLE) AS avg_value, CAST(min_value AS DOUBLE) AS min_value, "
        "CAST(max_value AS DOUBLE) AS max_value, CAST(sum_value AS DOUBLE) AS sum_value, n, top_type FROM D JOIN ("
        + o.mode_table("H", "city, date_utc", "event_type", "top_type") + ") USING (city, date_utc)"
    ),
)
def daily_rollup(spark, sf):
    return hourly(spark, sf).groupBy("city", "date_utc").agg(
        avg_rounded("value", 2).alias("avg_value"),
        min_rounded("value", 2).alias("min_value"),
        max_rounded("value", 2).alias("max_value"),
        sum_or_zero("value", 2).alias("sum_value"),
        F.count(F.lit(1)).alias("n"),
        most_frequent("event_type").alias("top_type"),
    )


_CENTS = "CAST(CAST({c} AS DECIMAL(18,2)) AS DECIMAL(18,6))"


def _cents(c: str) -> str:
    return _CENTS.format(c=c)


@query(
    "daily_measures",
    f"SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, CAST({o.avg(_cents('l_extendedprice'), 2)} AS DOUBLE) AS avg_price, "
    f"CAST({o.avg(_cents('l_quantity'), 3)} AS DOUBLE) AS avg_quantity, CAST({o.avg(_cents('l_discount'), 0)} AS DOUBLE) AS avg_discount, "
    "min(l_quantity) AS min_quantity, max(l_extendedprice) AS max_price, "
    f"CAST(coalesce(sum({_cents('CASE WHEN l_returnflag = \'R\' THEN l_quantity END')}), 0) AS DOUBLE) AS returned_quantity, "
    "count(*) AS n FROM lineitem GROUP BY CAST(l_shipdate AS DATE)",
)
def daily_measures(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("day"),
        *[exact(F.col(c).cast("decimal(18,2)")).alias(c) for c in ("l_extendedprice", "l_quantity", "l_discount")],
        "l_returnflag",
    )
    return items.groupBy("day").agg(
        avg_rounded("l_extendedprice", 2).alias("avg_price"),
        avg_rounded("l_quantity", 3).alias("avg_quantity"),
        avg_rounded("l_discount", 0).alias("avg_discount"),
        min_rounded("l_quantity", 2).alias("min_quantity"),
        max_rounded("l_extendedprice", 2).alias("max_price"),
        sum_or_zero(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")), 2).alias("returned_quantity"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "daily_filtered_counts",
    "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, count(*) FILTER (WHERE value > 50) AS above_50, "
    f"CAST({o.half_up('CAST(count(*) FILTER (WHERE value > 50) AS HUGEINT)', 'count(*)', 3)} AS DOUBLE) AS share_above_50 "
    "FROM events GROUP BY event_type, CAST(ts AS DATE)",
)
def daily_filtered_counts(spark, sf):
    high = F.col("value") > 50
    return table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(high).alias("above_50"), share_rounded(high, 3).alias("share_above_50")
    )


@query(
    "daily_distinct",
    "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS users, "
    "count(DISTINCT user_id) FILTER (WHERE value > 50) AS users_above_50, "
    f"CAST({o.avg(_cents('value'), 0)} AS DOUBLE) AS avg_value FROM events GROUP BY event_type, CAST(ts AS DATE)",
)
def daily_distinct(spark, sf):
    events = table(spark, sf, "events").select(
        "event_type", F.to_date("ts").alias("day"), "user_id", exact(F.col("value").cast("decimal(18,2)")).alias("value")
    )
    return distinct_counts(
        events, ["event_type", "day"], "user_id", F.col("value") > 50, "value", 0, ("users", "users_above_50", "avg_value")
    )


@query(
    "hourly_fact",
    base_sql(
        f"SELECT {o.key('city', 'date_trunc(\'hour\', observed_at)')} AS city_hour_key, {o.key('city')} AS city_key, "
        f"{o.datekey('date_utc')} AS date_key, hour_utc, city, observed_at, CAST(value AS DOUBLE) AS value FROM H"
    ),
)
def hourly_fact(spark, sf):
    return hourly(spark, sf).select(
        surrogate_key("city", hour_of("observed_at")).alias("city_hour_key"),
        surrogate_key("city").alias("city_key"),
        date_key("date_utc").alias("date_key"),
        "hour_utc", "city", "observed_at", "value",
    )


# ---- joins and dimensions -------------------------------------------------------------------------

F1_SQL = (
    "F1 AS (SELECT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day, count(*) AS orders, "
    f"{o.avg(_cents('o_totalprice'), 2)} AS avg_total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"
)
F2_SQL = (
    "F2 AS (SELECT s_nationkey AS nation, CAST(l_shipdate AS DATE) AS day, count(*) AS items, "
    f"{o.avg(_cents('l_discount'), 3)} AS avg_discount FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"
)


def _per_nation(facts: DataFrame, owner: str, owners: DataFrame, rows: str, measure: str, digits: int, **counts) -> DataFrame:
    """Facts per nation and day. Each owner's day is summed before the join, so a hot owner is one row a day there."""
    days = facts.groupBy(owner, "day").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(measure).alias("_sum"), F.count(measure).alias("_filled"),
        *[F.count_if(c).alias(n) for n, c in counts.items()],
    )
    return days.join(owners, owner).groupBy("nation", "day").agg(
        F.sum("_rows").alias(rows), ratio_rounded(F.sum("_sum"), F.sum("_filled"), digits).alias(f"avg_{measure}"),
        *[F.sum(n).alias(n) for n in counts],
    )


def nation_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day"),
        exact(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
    )
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return _per_nation(orders, "c_custkey", customers, "orders", "total", 2)


def nation_items(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.to_date("l_shipdate").alias("day"),
        exact(F.col("l_discount").cast("decimal(18,2)")).alias("discount"),
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    return _per_nation(items, "s_suppkey", suppliers, "items", "discount", 3)


@query(
    "flow_incident_daily",
    f"WITH {F1_SQL}, {F2_SQL} SELECT F1.nation, CAST(F1.day AS VARCHAR) AS day, orders, CAST(avg_total AS DOUBLE) AS avg_total, "
    "coalesce(items, 0) AS items, CAST(avg_discount AS DOUBLE) AS avg_discount FROM F1 LEFT JOIN F2 USING (nation, day)",
)
def flow_incident_daily(spark, sf):
    """Left join of two daily facts; days that only the first one has stay, with a count of 0."""
    both = nation_orders(spark, sf).join(nation_items(spark, sf), ["nation", "day"], "left")
    return both.select("nation", "day", "orders", "avg_total", F.coalesce("items", F.lit(0)).alias("items"), "avg_discount")


@query(
    "dim_entity",
    f"SELECT {o.key('n_nationkey')} AS nation_key, n_nationkey AS nation, n_name AS name, segment, CAST(avg_balance AS DOUBLE) AS avg_balance, "
    "TRUE AS has_customers, n_nationkey IN (SELECT s_nationkey FROM supplier) AS has_suppliers FROM nation JOIN "
    f"(SELECT c_nationkey AS n_nationkey, {o.avg(_cents('c_acctbal'), 4)} AS avg_balance FROM customer GROUP BY 1) USING (n_nationkey) LEFT JOIN "
    "(SELECT c_nationkey AS n_nationkey, segment FROM (" + o.mode_table("customer", "c_nationkey", "c_mktsegment", "segment") + ")) USING (n_nationkey)",
)
def dim_entity(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), "c_mktsegment", exact(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance")
    )
    profile = mode_and_means(customers, ["nation"], ("c_mktsegment", "segment"), {"avg_balance": ("balance", 4)})
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))
    supplied = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("_supplied")).distinct()
    return (
        names.join(profile, "nation")
        .join(supplied, F.col("nation") == F.col("_supplied"), "left")
        .select(
            surrogate_key("nation").alias("nation_key"), "nation", "name", "segment", "avg_balance",
            F.lit(True).alias("has_customers"), F.col("_supplied").isNotNull().alias("has_suppliers"),
        )
    )


@query(
    "dim_date",
    "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders), "
    "s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b), "
    "n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1) "
    f"SELECT {o.datekey('d')} AS date_key, CAST(d AS VARCHAR) AS date_utc, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, "
    "CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, "
    "dayname(d) AS day_name, CAST(week(d) AS INTEGER) AS week_of_year, isodow(d) > 5 AS is_weekend, coalesce(orders, 0) AS orders "
    "FROM s LEFT JOIN n USING (d)",
)
def dim_date(spark, sf):
    """Calendar over the days the orders span, with the orders of each day."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_utc"))
    span = orders.agg(F.min("date_utc").alias("first_day"), F.max("date_utc").alias("last_day"))
    counts = orders.groupBy("date_utc").agg(F.count(F.lit(1)).alias("orders"))
    days = dims.calendar(dims.date_spine(span)).join(counts, "date_utc", "left")
    return days.withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(
    "dim_hour",
    base_sql(
        "SELECT CAST(h AS INTEGER) AS hour_utc, right('0' || h, 2) || ':00' AS hour_label, CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' "
        "WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END AS day_part, coalesce(n, 0) AS readings, CAST(avg_value AS DOUBLE) AS avg_value "
        f"FROM range(24) r(h) LEFT JOIN (SELECT hour_utc AS h, count(*) AS n, {o.avg('value', 2)} AS avg_value FROM H GROUP BY 1) USING (h)"
    ),
)
def dim_hour(spark, sf):
    """Time-of-day profile: the hour dimension with the readings of each hour."""
    by_hour = hourly(spark, sf).groupBy("hour_utc").agg(F.count(F.lit(1)).alias("readings"), avg_rounded("value", 2).alias("avg_value"))
    hours = dims.dim_hour(spark).join(by_hour, "hour_utc", "left")
    return hours.withColumn("readings", F.coalesce("readings", F.lit(0)))


_NT = "least(greatest(coalesce(CAST(avg_total * 100 AS HUGEINT), 0), 0), 3000)"
_NA = "CAST(avg_code * 100 AS HUGEINT)"
_NC = "CAST(coalesce(avg_discount, 0.5) * 1000 AS HUGEINT)"


@query(
    "obt_daily",
    f"WITH {F1_SQL}, {F2_SQL}, E AS (SELECT c_nationkey AS nation, CAST(ts AS DATE) AS day, {o.avg('CAST(' + d.CODE + ' AS HUGEINT)', 2)} AS avg_code, "
    f"count(*) FILTER (WHERE {d.CODE} >= 4) AS poor FROM events JOIN customer ON c_custkey = user_id GROUP BY 1, 2), "
    "B AS (SELECT nation, day FROM F1 UNION SELECT nation, day FROM F2 UNION SELECT nation, day FROM E), "
    "J AS (SELECT * FROM B LEFT JOIN F1 USING (nation, day) LEFT JOIN F2 USING (nation, day) LEFT JOIN E USING (nation, day) "
    "LEFT JOIN (SELECT n_nationkey AS nation, n_name AS name FROM nation) USING (nation)), "
    f"S AS (SELECT *, {o.half_up(f'(4 * {_NT} + 30 * (500 - {_NA}) + 6 * (1000 - {_NC}))', '30000', 3)} AS score FROM J) "
    f"SELECT {o.key('nation', 'day')} AS nation_date_key, nation, name, CAST(day AS VARCHAR) AS day, CAST(orders AS DOUBLE) AS orders, CAST(items AS DOUBLE) AS items, "
    "CAST(avg_total AS DOUBLE) AS avg_total, CAST(avg_discount AS DOUBLE) AS avg_discount, CAST(avg_code AS DOUBLE) AS avg_code, "
    "CAST(score AS DOUBLE) AS comfort_index, CAST(score AS DOUBLE) AS livability_score, "
    "CASE WHEN score IS NULL THEN 'No data' WHEN score < 0.25 THEN 'Poor' WHEN score < 0.5 THEN 'Fair' WHEN score < 0.75 THEN 'Good' ELSE 'Excellent' END "
    "AS comfort_index_label, CASE WHEN avg_discount IS NULL THEN 'No data' WHEN avg_discount < 0.2 THEN 'Low' WHEN avg_discount < 0.4 THEN 'Moderate' "
    "WHEN avg_discount < 0.6 THEN 'High' ELSE 'Severe' END AS congestion_label, CAST(poor > 2 AS VARCHAR) AS aqi_alert FROM S",
    ("orders", "items", "aqi_alert"),
)
def obt_daily(spark, sf):
    """Wide nation-day table over three daily facts of different coverage."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"))
    events = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), F.expr(d.CODE).alias("code"))
    activity = _per_nation(events, "user_id", customers, "events", "code", 2, poor=F.col("code") >= 4).drop("events")
    orders, items = nation_orders(spark, sf), nation_items(spark, sf)
    grain = ["nation", "day"]
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))
    wide = one_row_per(grain, orders, items, activity).join(names, "nation", "left")
    score = comfort_index(*comfort_parts(F.col("avg_total"), F.col("avg_code"), F.col("avg_discount")))
    return wide.withColumn("comfort_index", score).select(
        surrogate_key("nation", "day").alias("nation_date_key"), "nation", "name", "day", "orders", "items",
        "avg_total", "avg_discount", "avg_code", "comfort_index", F.col("comfort_index").alias("livability_score"),
        labels.comfort_label(F.col("comfort_index")).alias("comfort_index_label"),
        labels.congestion_label(F.col("avg_discount")).alias("congestion_label"),
        (F.col("poor") >= 3).alias("aqi_alert"),
    )


# ---- trends ---------------------------------------------------------------------------------------

_BY, _AT = ["city"], "date_utc"


@query(
    "trend_daily",
    base_sql(
        "SELECT city, CAST(date_utc AS VARCHAR) AS date_utc, CAST(avg_value AS DOUBLE) AS avg_value, CAST(a7 AS DOUBLE) AS avg_7, "
        "CAST(a30 AS DOUBLE) AS avg_30, CAST(avg_value - a30 AS DOUBLE) AS anomaly, CASE WHEN avg_value - a30 > 5 THEN 'Hot anomaly' "
        "WHEN avg_value - a30 < -5 THEN 'Cold anomaly' ELSE 'Normal' END AS anomaly_label, CAST(avg_value - p1 AS DOUBLE) AS dod_change, "
        f"CAST(avg_value - p7 AS DOUBLE) AS wow_change FROM (SELECT *, {o.over('avg_value', 2, o._W7)} AS a7, {o.over('avg_value', 2, o._W30)} AS a30, "
        f"lag(avg_value) OVER ({o._ORDERED}) AS p1, lag(avg_value, 7) OVER ({o._ORDERED}) AS p7 FROM D)"
    ),
)
def trend_daily(spark, sf):
    v = F.col("avg_value")
    days = daily(spark, sf).select("city", "date_utc", v).withColumns({
        "avg_7": rolling_avg("avg_value", 7, 2, _BY, _AT),
        "avg_30": rolling_avg("avg_value", 30, 2, _BY, _AT),
        "_p1": previous("avg_value", 1, _BY, _AT),
        "_p7": previous("avg_value", 7, _BY, _AT),
    })
    gap = v - F.col("avg_30")
    return days.select(
        "city", "date_utc", v, "avg_7", "avg_30", rounded(gap, 2).alias("anomaly"), labels.anomaly_label(gap).alias("anomaly_label"),
        rounded(v - F.col("_p1"), 2).alias("dod_change"), rounded(v - F.col("_p7"), 2).alias("wow_change"),
    )


@query(
    "prior_window_trend",
    base_sql(
        "SELECT city, CAST(date_utc AS VARCHAR) AS date_utc, CAST(r AS DOUBLE) AS recent, CAST(p AS DOUBLE) AS prior, "
        "CASE WHEN p IS NULL THEN 'Insufficient data' WHEN r > p + 0.02 THEN 'Improving' WHEN r < p - 0.02 THEN 'Worsening' ELSE 'Stable' END AS trend "
        f"FROM (SELECT *, {o.over('avg_value', 3, o._W7)} AS r, {o.over('avg_value', 3, o._P7)} AS p FROM D)"
    ),
)
def prior_window_trend(spark, sf):
    days = daily(spark, sf).select("city", "date_utc", "avg_value").select(
        "city", "date_utc", rolling_avg("avg_value", 7, 3, _BY, _AT).alias("recent"), prior_avg("avg_value", 7, 3, _BY, _AT).alias("prior")
    )
    return days.withColumn("trend", labels.trend_label(F.col("recent"), F.col("prior")))


# ---- batch windows and retention ------------------------------------------------------------------


@query(
    "latest_batch",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, city, extracted_at FROM syncs WHERE extracted_at >= (SELECT max(extracted_at) FROM syncs) - INTERVAL 5 MINUTE",
)
def latest_batch(spark, sf):
    return land.latest_batch(d.landing(spark, sf, "current_weather")).select("raw_id", "city", "extracted_at")


KEEP_FROM = datetime(2024, 1, 20, 9, 30)


@query(
    "keep_recent",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, city, extracted_at FROM syncs WHERE extracted_at >= TIMESTAMP '{KEEP_FROM}' - INTERVAL 1 DAY",
)
def keep_recent(spark, sf):
    return land.keep_recent(d.landing(spark, sf, "current_weather"), KEEP_FROM, 1).select("raw_id", "city", "extracted_at")
