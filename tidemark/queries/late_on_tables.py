"""Arrivals out of order: what is stored, what came too late, and whether the rows add up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import read_table
from tidemark.operators.late import Ledger
from tidemark.operators.staging import build_staging
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL, Warehouse
from tidemark.queries import derived as d
from tidemark.queries import oracle as o
from tidemark.queries.incremental_on_tables import CUTS, END, land_rows
from tidemark.queries.models_on_tables import MODELS
from tidemark.queries.registry import query
from tidemark.session import scratch_dir
from tidemark.sources import landing as land
from tidemark.sources.mappings import FIELD_MAPPINGS
from tidemark.streaming import streams

FEED, MODEL = "current_weather", "int_city_hourly_weather"
TABLE = INCREMENTAL[MODEL].table


def arrivals(spark: SparkSession, sf: str):
    """The three batches by extract time, but a tenth of all rows (by humidity) lands one batch later."""
    at = F.col("extracted_at").cast("timestamp_ntz")
    due = sum((at >= F.lit(c)).cast("int") for c in CUTS)
    held_up = (F.col("main.humidity") % 10 == 7).cast("int")
    arrival = F.least(due + held_up, F.lit(len(CUTS)))
    for i, until in enumerate((*CUTS, None)):  # the last one also takes rows without humidity or extract time, however old
        rows = d.landing(spark, sf, FEED, until=until, in_order=True)
        yield until or END, rows.withColumn("_arrival", arrival).filter(F.col("_arrival") == i).drop("_arrival")


def _late_chain(read_again: bool) -> str:
    """CTEs of the three runs. A batch run reads again what lies in the lookback, a micro-batch is new rows only."""
    due = " + ".join(f"CAST(extracted_at >= TIMESTAMP '{c}' AS INTEGER)" for c in CUTS)
    among = "arrival <=" if read_again else "arrival ="

    def newest(i: int, where: str) -> str:
        best = o._latest(f"(SELECT * FROM x WHERE {where})", "city, date_trunc('hour', observed_at)", "observed_at DESC, extracted_at DESC, temp_celsius DESC")
        return f"(SELECT max(extracted_at) FROM ({best}))"

    def edge(i: int) -> str:
        return f"(SELECT m{i - 1} - INTERVAL 6 HOUR FROM mark{i - 1})"

    return o.chain("stg_current_weather") + (
        f", x AS (SELECT *, least({due} + CAST(humidity_pct % 10 = 7 AS INTEGER), {len(CUTS)}) AS arrival FROM stg_current_weather)"
        f", mark0 AS (SELECT {newest(0, 'arrival = 0')} AS m0)"
        f", mark1 AS (SELECT greatest((SELECT m0 FROM mark0), {newest(1, f'{among} 1 AND extracted_at > {edge(1)}')}) AS m1)"
        f", judged AS (SELECT *, CASE arrival WHEN 1 THEN {edge(1)} WHEN 2 THEN {edge(2)} END AS late_bound FROM x)"
        ", late AS (SELECT * FROM judged WHERE extracted_at <= late_bound)"
        ", timely AS (SELECT * FROM judged WHERE late_bound IS NULL OR extracted_at > late_bound)"
        f", stored AS ({o.CTES[MODEL].replace('stg_current_weather', 'timely')})"
    )


def _stored_sql(read_again: bool) -> str:
    return _late_chain(read_again) + " " + o.select_portable("stored", *o.OUTPUT_CASTS[MODEL])


def _ledger_sql(read_again: bool) -> str:
    return _late_chain(read_again) + (
        " SELECT CAST(arrival AS INTEGER) AS arrival, raw_id, city, extracted_at, 'beyond_lookback' AS late_reason, late_bound FROM late"
    )


def _house(spark: SparkSession, sf: str) -> Warehouse:
    house = Warehouse(spark, scratch_dir(spark, "late"), track_late=True)
    for as_of, rows in arrivals(spark, sf):
        land_rows(rows, house.root, FEED)
        house.refresh(MODEL, as_of)
    return house


def _ledger(ledger: Ledger, spark: SparkSession) -> DataFrame:
    return ledger.rows(spark).select("arrival", "raw_id", "city", "extracted_at", "late_reason", "late_bound")


@query("late_rows_stored", _stored_sql(True))
def late_rows_stored(spark, sf):
    """Rows within the lookback are absorbed although they land late; older ones are not."""
    return _house(spark, sf).table(MODEL).select(*MODELS[MODEL](spark, sf).columns)


@query("late_rows_ledger", _ledger_sql(True))
def late_rows_ledger(spark, sf):
    """Every row that landed too late, with the arrival and the bound that ruled it out."""
    return _ledger(_house(spark, sf).late(MODEL), spark)


@query(
    "late_rows_balance",
    _late_chain(True) + ", k AS (SELECT city, date_trunc('hour', observed_at) AS h, count(*) AS n FROM timely GROUP BY ALL), "
    "l AS (SELECT CAST(observed_at AS DATE) AS day, count(*) AS landed, count(*) FILTER (WHERE extracted_at <= late_bound) AS late FROM judged GROUP BY 1), "
    "s AS (SELECT CAST(h AS DATE) AS day, count(*) AS stored, sum(n - 1) AS superseded FROM k GROUP BY 1) "
    "SELECT CAST(day AS VARCHAR) AS day, landed, coalesce(stored, 0) AS stored, CAST(coalesce(superseded, 0) AS BIGINT) AS superseded, late, "
    "CAST(0 AS BIGINT) AS unusable, TRUE AS balanced FROM l LEFT JOIN s USING (day)",
)
def late_rows_balance(spark, sf):
    """Landed rows of every day: stored, superseded, late or unusable."""
    return _house(spark, sf).reconcile(MODEL)


def _streamed(spark: SparkSession, sf: str) -> str:
    """The same arrivals as a stream; the ledger takes the rows behind the stored mark."""
    root = scratch_dir(spark, "late-stream")
    sink = streams.split_by_lookback(
        root, TABLE, lambda rows: m.hourly_weather(build_staging(rows, FIELD_MAPPINGS[FEED])), "extracted_at", unique=True
    )
    for _, rows in arrivals(spark, sf):
        land_rows(rows, root, FEED)
        streams.run_available(land.stream_landing(spark, root, FEED), sink, f"{root}/_checkpoints/late", "append")
    return root


@query("stream_late_stored", _stored_sql(False))
def stream_late_stored(spark, sf):
    return read_table(spark, TABLE.path(_streamed(spark, sf))).select(*MODELS[MODEL](spark, sf).columns)


@query("stream_late_ledger", _ledger_sql(False))
def stream_late_ledger(spark, sf):
    return _ledger(Ledger(_streamed(spark, sf), MODEL), spark)
