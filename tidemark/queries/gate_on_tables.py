"""The gate observed end to end: blocking runs, their audit log, missing tables, quarantined micro-batches, and the config behind them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import contract
from tidemark.operators.contract import ContractError, Rule
from tidemark.operators.incremental import read_table
from tidemark.operators.staging import active_mappings, build_staging
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL, Warehouse
from tidemark.queries import derived as d
from tidemark.queries import oracle as o
from tidemark.queries.incremental_on_tables import CUTS, END, land_rows, slices
from tidemark.queries.models_on_tables import MODELS
from tidemark.queries.registry import query, table
from tidemark.session import scratch_dir
from tidemark.sources import config as cfg
from tidemark.sources import landing as land
from tidemark.sources.mappings import FIELD_MAPPINGS
from tidemark.streaming import gate, streams

FEED, MODEL = "current_weather", "int_city_hourly_weather"
TABLE = INCREMENTAL[MODEL].table
#: The second arrival has humidities of 150, which the rule below refuses.
BROKEN = 1
RULES = [Rule("humidity_pct", "max", "100", "error"), Rule("temp_celsius", "min", "-9", "warn"), Rule(None, "min_row_count", "1", "error")]


def arrivals(spark: SparkSession, sf: str):
    for i, (as_of, rows) in enumerate(slices(spark, sf, FEED)):
        if i == BROKEN:
            wrong = F.when(F.col("main.humidity") == 50, F.lit(150)).otherwise(F.col("main.humidity"))
            rows = rows.withColumn("main", F.col("main").withField("humidity", wrong.cast("int")))
        yield i, as_of, rows


_DUE = " + ".join(f"CAST(extracted_at >= TIMESTAMP '{c}' AS INTEGER)" for c in CUTS)
_LANDED = (
    f"{o.chain('stg_current_weather')}, landed AS (SELECT * REPLACE (CASE WHEN arrival = {BROKEN} AND humidity_pct = 50 THEN 150 ELSE humidity_pct END "
    f"AS humidity_pct) FROM (SELECT *, {_DUE} AS arrival FROM stg_current_weather))"
)


def _winners(arrived: str) -> str:
    hourly = o.CTES[MODEL].replace("stg_current_weather", f"(SELECT * FROM landed WHERE {arrived})")
    return f"{_LANDED}, stored AS ({hourly}) {o.select_portable('stored', *o.OUTPUT_CASTS[MODEL])}"


def _streamed(spark: SparkSession, sf: str) -> str:
    root = scratch_dir(spark, "gate-stream")
    replace = streams.keyed_replace(root, TABLE, lambda rows: m.hourly_weather(build_staging(rows, FIELD_MAPPINGS[FEED])), unique=True)
    sink = gate.gated(root, FEED, FIELD_MAPPINGS[FEED], RULES, replace)
    for _, _, rows in arrivals(spark, sf):
        land_rows(rows, root, FEED)
        streams.run_available(land.stream_landing(spark, root, FEED), sink, f"{root}/_checkpoints/gate", "append")
    return root


def _line(column: str, check: str, status: str, severity: str, nulls: str = "NULL") -> str:
    name = f"'{column}'" if column else "NULL"
    return (
        f"SELECT 'current_weather-' || arrival AS pipeline_run_id, newest AS run_ts, {name} AS target_column, '{check}' AS check_type, {status} AS status, "
        f"CAST(n AS DOUBLE) AS rows_checked, CAST({nulls} AS DOUBLE) AS null_count, FALSE AS resolved FROM t"
    )


_STREAM_LINES = " UNION ALL ".join([
    *[_line(c, "required", "'ok'", "error", f"n - n_{c}") for c in ("city", "temp_celsius", "observed_at")],
    _line("humidity_pct", "max", "CASE WHEN humid > 0 THEN 'below_threshold' ELSE 'ok' END", "error"),
    _line("temp_celsius", "min", "CASE WHEN cold > 0 THEN 'below_threshold' ELSE 'ok' END", "warn"),
    _line("", "min_row_count", "'ok'", "error"),
    _line("", "certify", "'certified'", "warn") + " WHERE humid = 0",
])


@query(
    "stream_gate_audit",
    f"{_LANDED}, t AS (SELECT arrival, max(extracted_at) AS newest, count(*) AS n, count(city) AS n_city, count(temp_celsius) AS n_temp_celsius, "
    "count(observed_at) AS n_observed_at, count(*) FILTER (WHERE humidity_pct > 100) AS humid, count(*) FILTER (WHERE temp_celsius < -9) AS cold "
    f"FROM landed GROUP BY arrival) {_STREAM_LINES}",
    ("rows_checked", "null_count"),
)
def stream_gate_audit(spark, sf):
    """The audit log after three micro-batches, of which the second is refused."""
    log = spark.read.parquet(contract.audit_path(_streamed(spark, sf)))
    return log.select("pipeline_run_id", "run_ts", "target_column", "check_type", "status", "rows_checked", "null_count", "resolved")


@query("stream_gate_stored", _winners(f"arrival <> {BROKEN}"))
def stream_gate_stored(spark, sf):
    """The target holds nothing of the refused micro-batch."""
    return read_table(spark, TABLE.path(_streamed(spark, sf))).select(*MODELS[MODEL](spark, sf).columns)


@query(
    "stream_gate_quarantine",
    f"{_LANDED} SELECT CAST(arrival AS INTEGER) AS micro_batch, raw_id, city, extracted_at, humidity_pct FROM landed WHERE arrival = {BROKEN}",
)
def stream_gate_quarantine(spark, sf):
    """The refused rows wait in quarantine as they landed."""
    held = gate.quarantined(spark, _streamed(spark, sf), FEED)
    return held.select("micro_batch", "raw_id", "city", "extracted_at", F.col("main.humidity").alias("humidity_pct"))


# ---- batch ----------------------------------------------------------------------------------------


def _with_rules(spark: SparkSession, rules: list[Rule]) -> dict[str, DataFrame]:
    config = cfg.seed_config(spark)
    stream_id = config["streams"].filter(F.col("stream_name") == FEED).first()["stream_id"]
    rows = [(i, stream_id, r.target_column, r.rule_type, r.rule_value, r.severity, True, None, None) for i, r in enumerate(rules, 1)]
    return config | {"validation_rules": spark.createDataFrame(rows, cfg.SCHEMAS["validation_rules"])}


def _only(config: dict[str, DataFrame], *streams_: str) -> dict[str, DataFrame]:
    listed = F.col("stream_name").isin(*streams_)
    return config | {"streams": config["streams"].withColumn("is_active", listed)}


@query("gate_blocks", _winners("arrival = 0"))
def gate_blocks(spark, sf):
    """A run whose batch breaks an error rule stops before it touches a table; one that breaks a warning goes on."""
    house = Warehouse(spark, scratch_dir(spark, "gate"))
    config = _only(_with_rules(spark, [Rule("humidity_pct", "min", "60", "error"), Rule("temp_celsius", "min", "100", "warn")]), FEED)
    loose = _only(_with_rules(spark, [Rule("temp_celsius", "min", "100", "warn")]), FEED)
    for i, as_of, rows in arrivals(spark, sf):
        if i > BROKEN:
            break
        land_rows(rows, house.root, FEED)
        try:
            contract.gate(spark, house.root, loose if i == 0 else config, as_of, f"arrival-{i}", minutes=WHOLE)
        except ContractError:
            continue
        house.refresh(MODEL, as_of)
    return house.table(MODEL).select(*MODELS[MODEL](spark, sf).columns)


#: A window that holds every batch whole.
WHOLE = 100 * 24 * 60
RUN_AT = datetime(2024, 3, 1, 6, 0)
STREAMS = ("air_pollution", "traffic_flow", "traffic_incidents")


def _audit_line(stream: str, column: str | None, check: str, status: str, counted: bool = True, nulls: str = "NULL") -> str:
    rows = f"(SELECT count(*) FROM stg_{stream})" if counted else "NULL"
    target = f"'{column}'" if column else "NULL"
    return (
        f"SELECT 'run-' || run AS pipeline_run_id, TIMESTAMP '{RUN_AT}' + to_hours(run) AS run_ts, '{stream}' AS stream_name, {target} AS target_column, "
        f"'{check}' AS check_type, {status} AS status, CAST({rows} AS DOUBLE) AS rows_checked, CAST({nulls} AS DOUBLE) AS null_count FROM (VALUES (1), (2)) AS r(run)"
    )


def _required_lines(stream: str) -> list[str]:
    required = [f.target_column for f in active_mappings(FIELD_MAPPINGS[stream]) if f.is_required]
    return [
        _audit_line(stream, c, "required", "'ok'", nulls=f"(SELECT count(*) - count({c}) FROM stg_{stream})") for c in required
    ]


@query(
    "gate_audit_log",
    f"{o.chain('stg_traffic_incidents')} "
    + " UNION ALL ".join([
        *_required_lines("air_pollution"),
        _audit_line("air_pollution", None, "min_row_count", "'ok'"),
        _audit_line("air_pollution", "aqi", "accepted_values", "'ok'"),
        _audit_line("air_pollution", None, "certify", "'certified'"),
        *_required_lines("traffic_flow"),
        _audit_line("traffic_flow", None, "min_row_count", "'ok'"),
        _audit_line("traffic_flow", "current_speed_kmh", "min", "'ok'"),
        _audit_line("traffic_flow", None, "certify", "'certified'"),
        _audit_line("traffic_incidents", None, "batch", "'missing'", counted=False),
    ]),
    ("rows_checked", "null_count"),
)
def gate_audit_log(spark, sf):
    """Two runs of the seeded checks, read back from the log; one stream has no landing table, so both runs block."""
    root = scratch_dir(spark, "audit")
    for feed in STREAMS[:2]:
        land_rows(d.landing(spark, sf, feed, in_order=True), root, feed)
    config = _only(cfg.seed_config(spark), *STREAMS)
    for run in (1, 2):
        try:
            contract.gate(spark, root, config, RUN_AT.replace(hour=6 + run), f"run-{run}", minutes=WHOLE)
        except ContractError:
            continue
    log = spark.read.parquet(contract.audit_path(root))
    return log.select("pipeline_run_id", "run_ts", "stream_name", "target_column", "check_type", "status", "rows_checked", "null_count")


# ---- full refresh ---------------------------------------------------------------------------------


@query("full_refresh", o.model_sql("int_city_hourly_weather"))
def full_refresh(spark, sf):
    """Arrivals in reverse order: what the lookback left out is stored after a rebuild from landing."""
    house = Warehouse(spark, scratch_dir(spark, "refresh"))
    for _, rows in reversed(list(slices(spark, sf, FEED))):
        land_rows(rows, house.root, FEED)
        house.refresh(MODEL, END)
    house.refresh(MODEL, END, full_refresh=True)
    return house.table(MODEL).select(*MODELS[MODEL](spark, sf).columns)


# ---- config tables filled from the given ones -----------------------------------------------------


def _config(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Nations are sources, parts are streams and mappings, customers are locations, line items are rules."""
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    none, part = F.lit(None), table(spark, sf, "part")
    return {
        "sources": nation.select(
            F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("source_name"), (F.col("n_regionkey") != 3).alias("is_active")
        ),
        "streams": part.select(
            F.col("p_partkey").alias("stream_id"), (F.col("p_partkey") % 25).alias("source_id"),
            F.concat(F.lit("stream-"), F.col("p_partkey").cast("string")).alias("stream_name"), (F.col("p_size") > 10).alias("is_active"),
        ),
        "locations": customer.select(
            F.col("c_custkey").alias("location_id"), F.col("c_name").alias("city"), F.col("c_acctbal").alias("latitude"),
            (-F.col("c_acctbal")).alias("longitude"), (F.col("c_mktsegment") != "BUILDING").alias("is_active"), none.alias("updated_at"),
        ),
        "source_locations": customer.select(
            F.col("c_nationkey").alias("source_id"), F.col("c_custkey").alias("location_id"), (F.col("c_acctbal") > 0).alias("is_active"),
            none.alias("updated_at"),
        ),
        "field_mappings": part.select(
            F.col("p_partkey").alias("mapping_id"), F.col("p_name").alias("target_column"), (F.col("p_size") % 5 == 0).alias("is_required"),
            (F.col("p_size") > 10).alias("is_active"),
        ),
        "validation_rules": table(spark, sf, "lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("rule_id"), F.col("l_partkey").alias("stream_id"),
            F.when(F.col("l_linenumber") > 2, F.concat(F.lit("column-"), F.col("l_suppkey").cast("string"))).alias("target_column"),
            F.col("l_returnflag").alias("rule_type"), (F.col("l_linestatus") == "O").alias("is_active"),
        ),
    }


_SOURCES = "s AS (SELECT n_nationkey AS source_id, n_name AS source_name FROM nation WHERE n_regionkey <> 3)"
_STREAMS = (
    f"{_SOURCES}, t AS (SELECT p_partkey AS stream_id, 'stream-' || p_partkey AS stream_name, p_partkey % 25 AS source_id, source_name "
    "FROM part JOIN s ON s.source_id = p_partkey % 25 WHERE p_size > 10)"
)


@query("join_config_streams", f"WITH {_STREAMS} SELECT stream_id, stream_name, source_id, source_name FROM t")
def join_config_streams(spark, sf):
    """Active streams of active sources."""
    return cfg.active_streams(_config(spark, sf)).select("stream_id", "stream_name", "source_id", "source_name")


@query(
    "join_config_locations",
    f"WITH {_SOURCES} SELECT source_id, source_name, c_custkey AS location_id, c_name AS city, c_acctbal AS latitude, -c_acctbal AS longitude "
    "FROM customer JOIN s ON source_id = c_nationkey WHERE c_mktsegment <> 'BUILDING' AND c_acctbal > 0",
)
def join_config_locations(spark, sf):
    """Active cities of every active source, by active links."""
    return cfg.active_locations(_config(spark, sf)).select("source_id", "source_name", "location_id", "city", "latitude", "longitude")


@query(
    "sort_nulls_first",
    f"WITH {_STREAMS} SELECT stream_name, target_column, rule_type, CAST(row_number() OVER (PARTITION BY stream_name ORDER BY target_column NULLS FIRST, "
    "rule_type, rule_id) AS INTEGER) AS position FROM (SELECT l_partkey AS stream_id, CASE WHEN l_linenumber > 2 THEN 'column-' || l_suppkey END AS target_column, "
    "l_returnflag AS rule_type, concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS rule_id FROM lineitem WHERE l_linestatus = 'O') "
    "JOIN t USING (stream_id)",
)
def sort_nulls_first(spark, sf):
    """Rules in gate order: those without a column come first."""
    return cfg.ordered_rules(_config(spark, sf)).select("stream_name", "target_column", "rule_type", "position")


@query(
    "guard_required_active",
    "SELECT p_partkey AS mapping_id, p_name AS target_column FROM part WHERE p_size % 5 = 0 AND NOT p_size > 10",
)
def guard_required_active(spark, sf):
    """Required fields that are switched off: the config that holds them is refused."""
    return cfg.mapping_violations(_config(spark, sf)["field_mappings"]).select("mapping_id", "target_column")
