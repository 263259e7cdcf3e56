"""Incremental loads: the derived feeds arrive in three batches; the oracle is one full build.

The tables live in a fresh folder of the shared scratch space. The last query of each function
reads the final table, so that what is compared is what was stored.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key
from tidemark.functions.times import ntz
from tidemark.operators.incremental import backfill_keys, delete_insert
from tidemark.plans import models as m
from tidemark.plans.warehouse import INCREMENTAL, Warehouse
from tidemark.queries import derived as d
from tidemark.queries.models_on_tables import MODELS
from tidemark.queries.oracle import CTES, NULLABLE, OUTPUT_CASTS, chain, model_sql, nullable, select_portable
from tidemark.queries.registry import query, stored
from tidemark.session import scratch_dir
from tidemark.sources import config as cfg
from tidemark.sources import landing as land

# Extract times at which a sync batch ends; the last batch is open.
CUTS = (datetime(2024, 1, 11), datetime(2024, 1, 21))
END = datetime(2024, 3, 1)


def land_rows(rows: DataFrame, root: str, feed: str) -> None:
    """Append rows that are dealt in order of time: a day's rows lie in few tasks already, before they are wide."""
    rows.write.mode("append").partitionBy(land.PARTITION).parquet(land.landing_path(root, feed))


def slices(spark: SparkSession, sf: str, feed: str):
    """The three batches of a feed by extract time, with the time of each run."""
    for since, until in zip((None, *CUTS), (*CUTS, None)):
        yield until or END, d.landing(spark, sf, feed, since, until, in_order=True)


def load(spark: SparkSession, sf: str, feeds: tuple[str, ...], models: tuple[str, ...], replay: bool = False, last=END) -> Warehouse:
    """Append each batch to landing and refresh the models after it."""
    house = Warehouse(spark, scratch_dir(spark, "incremental"))
    batches = {feed: list(slices(spark, sf, feed)) for feed in feeds}
    for i in range(len(CUTS) + 1):
        for feed in feeds:
            land_rows(batches[feed][i][1], house.root, feed)
        as_of = min(batches[feeds[0]][i][0], last)
        for model in models:
            house.refresh(model, as_of)
            if replay:
                house.refresh(model, as_of)
    return house


def final(house: Warehouse, model: str, like: DataFrame) -> DataFrame:
    return house.table(model).select(*like.columns)


@query("incr_hourly", model_sql("int_city_hourly_weather"))
def incr_hourly(spark, sf):
    house = load(spark, sf, ("current_weather",), ("int_city_hourly_weather",))
    return final(house, "int_city_hourly_weather", MODELS["int_city_hourly_weather"](spark, sf))


@query("incr_replay", model_sql("int_city_hourly_pollution"))
def incr_replay(spark, sf):
    """Every run is repeated; a repeated batch adds nothing."""
    house = load(spark, sf, ("air_pollution",), ("int_city_hourly_pollution",), replay=True)
    return final(house, "int_city_hourly_pollution", MODELS["int_city_hourly_pollution"](spark, sf))


@query("incr_issuance", model_sql("int_city_weather_forecast"))
def incr_issuance(spark, sf):
    house = load(spark, sf, ("weather_forecast",), ("int_city_weather_forecast",))
    return final(house, "int_city_weather_forecast", MODELS["int_city_weather_forecast"](spark, sf))


@query("incr_accuracy", model_sql("fct_forecast_accuracy"), nullable("fct_forecast_accuracy"))
def incr_accuracy(spark, sf):
    house = load(
        spark, sf, ("weather_forecast", "current_weather"),
        ("int_city_weather_forecast", "int_city_hourly_weather", "fct_forecast_accuracy"), last=d.AS_OF,
    )
    return final(house, "fct_forecast_accuracy", MODELS["fct_forecast_accuracy"](spark, sf))


@query("incr_daily", model_sql("fct_weather_daily"))
def incr_daily(spark, sf):
    house = load(spark, sf, ("current_weather",), ("int_city_hourly_weather", "fct_weather_daily"))
    return final(house, "fct_weather_daily", MODELS["fct_weather_daily"](spark, sf))


@query("incr_traffic_daily", model_sql("fct_traffic_daily"))
def incr_traffic_daily(spark, sf):
    house = load(
        spark, sf, ("traffic_flow", "traffic_incidents"),
        ("int_city_hourly_traffic_flow", "int_city_hourly_traffic_incidents", "fct_traffic_daily"),
    )
    return final(house, "fct_traffic_daily", MODELS["fct_traffic_daily"](spark, sf))


@query("incr_alerts", model_sql("mart_pollution_alerts"))
def incr_alerts(spark, sf):
    house = load(
        spark, sf, ("air_pollution",), ("int_city_hourly_pollution", "fct_pollution_hourly", "mart_pollution_alerts")
    )
    return final(house, "mart_pollution_alerts", MODELS["mart_pollution_alerts"](spark, sf))


@query("expire_snapshot", model_sql("mart_forecast_latest"), nullable("mart_forecast_latest"))
def expire_snapshot(spark, sf):
    """A snapshot that was stored days before is rebuilt: what has expired since is gone."""
    house = load(spark, sf, ("weather_forecast",), ("int_city_weather_forecast",))
    for as_of in (d.AS_OF - timedelta(days=5), d.AS_OF):
        house.rebuild("mart_forecast_latest", as_of)
    return final(house, "mart_forecast_latest", MODELS["mart_forecast_latest"](spark, sf))


@query("hourly_run", model_sql("mart_city_daily"), nullable("mart_city_daily"))
def hourly_run(spark, sf):
    """The whole run over all five feeds, after each of three arrivals: gate and audit, models, schema tests.

    The rules of the seed suit real weather, so here they warn instead of blocking.
    """
    house = Warehouse(spark, scratch_dir(spark, "hourly"), calendar_start=date(2024, 1, 1))
    config = cfg.seed_config(spark)
    config["validation_rules"] = config["validation_rules"].withColumn("severity", F.lit("warn"))
    batches = {feed: list(slices(spark, sf, feed)) for feed in d.BUILDERS}
    for i, as_of in enumerate((*CUTS, END)):
        for feed, parts in batches.items():
            land_rows(parts[i][1], house.root, feed)
        house.run(as_of, config, run_id=f"arrival-{i}")
    return final(house, "mart_city_daily", MODELS["mart_city_daily"](spark, sf))


FIXED_DAY = date(2024, 1, 5)


def _fix_day(house: Warehouse) -> None:
    """A correction of one old day of the weather facts: readings were five degrees low."""
    table = INCREMENTAL["fct_weather_daily"].table
    day = house.table(table.name).filter(F.col("date_utc") == F.lit(FIXED_DAY))
    fixed = stored(day.withColumn("avg_temp_celsius", (F.col("avg_temp_celsius") + 5).cast(day.schema["avg_temp_celsius"].dataType)), "fixed-day")
    house.written[table.name] = delete_insert(house.spark, house.root, table, fixed)


def _fixed_sql(name: str) -> str:
    """The mart over the corrected facts."""
    fixed = (
        "fct_weather_daily_fixed AS (SELECT * REPLACE (avg_temp_celsius + CASE WHEN date_utc = DATE "
        f"'{FIXED_DAY}' THEN 5 ELSE 0 END AS avg_temp_celsius) FROM fct_weather_daily)"
    )
    last = list(CTES)[list(CTES).index("_obt") - 1] if name == "mart_city_daily" else "fct_weather_daily"
    parts = ["_obt", "_obt_scored", "_obt_trend", name] if name == "mart_city_daily" else ["_trend", name]
    rest = ", ".join(f"{p} AS ({CTES[p].replace('fct_weather_daily', 'fct_weather_daily_fixed')})" for p in parts)
    (decimals, dates), (integers, flags) = OUTPUT_CASTS[name], NULLABLE.get(name, ("", ""))
    return f"{chain(last)}, {fixed}, {rest} " + select_portable(name, f"{decimals} {integers}", f"{dates} {flags}")


@query("incr_trends", _fixed_sql("mart_temperature_trends"))
def incr_trends(spark, sf):
    """Rolling means stay those of a full rebuild, after every arrival and after an old day was corrected."""
    house = Warehouse(spark, scratch_dir(spark, "trends"))
    for as_of, rows in slices(spark, sf, "current_weather"):
        land_rows(rows, house.root, "current_weather")
        for model in ("int_city_hourly_weather", "fct_weather_daily"):
            house.refresh(model, as_of)
        house.refresh_rolling("mart_temperature_trends", as_of)
    _fix_day(house)
    house.refresh_rolling("mart_temperature_trends", END)
    return final(house, "mart_temperature_trends", MODELS["mart_temperature_trends"](spark, sf))


@query("incr_city_daily", _fixed_sql("mart_city_daily"), nullable("mart_city_daily"))
def incr_city_daily(spark, sf):
    """The wide table by touched rows: three facts, a lent country, and the corrected day."""
    house = Warehouse(spark, scratch_dir(spark, "wide"))
    feeds = ("current_weather", "air_pollution", "traffic_flow", "traffic_incidents")
    hourly = ("int_city_hourly_weather", "int_city_hourly_pollution", "int_city_hourly_traffic_flow", "int_city_hourly_traffic_incidents")
    batches = {feed: list(slices(spark, sf, feed)) for feed in feeds}
    for i, as_of in enumerate((*CUTS, END)):
        for feed in feeds:
            land_rows(batches[feed][i][1], house.root, feed)
        for model in (*hourly, "fct_weather_daily", "fct_pollution_daily", "fct_traffic_daily"):
            house.refresh(model, as_of)
        house.rebuild("dim_city", as_of)
        house.refresh_rolling("mart_city_daily", as_of)
    for untouched in ("fct_pollution_daily", "fct_traffic_daily"):
        house.written[untouched] = []
    _fix_day(house)
    house.refresh_rolling("mart_city_daily", END)
    return final(house, "mart_city_daily", MODELS["mart_city_daily"](spark, sf))


PRUNE_AT = datetime(2024, 1, 20, 9, 30)


@query(
    "prune_landing",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, city, extracted_at FROM syncs WHERE extracted_at >= TIMESTAMP '{PRUNE_AT}' - INTERVAL 1 DAY",
)
def prune_landing(spark, sf):
    """Old extract days are dropped as folders, the boundary day is rewritten."""
    root = scratch_dir(spark, "prune")
    land_rows(d.landing(spark, sf, "current_weather", in_order=True), root, "current_weather")
    land.prune(spark, root, "current_weather", PRUNE_AT)
    return land.read_landing(spark, root, "current_weather").select("raw_id", "city", "extracted_at")


@query("backfill_keys", model_sql("int_city_hourly_weather"))
def restored_keys(spark, sf):
    """Keys are scrambled, then recomputed from the stored columns."""
    scrambled = MODELS["int_city_hourly_weather"](spark, sf).withColumn("city_hour_key", F.md5("city_hour_key"))
    return backfill_keys(scrambled, "city_hour_key", m.city_hour_key())


@query(
    "append_snapshot",
    f"WITH {d.SYNCS_SQL} SELECT city, extracted_at, count(*) AS rows_landed, count(DISTINCT raw_id) AS ids FROM syncs GROUP BY city, extracted_at",
)
def append_snapshot(spark, sf):
    """Two syncs append whole snapshots; every landed row has its own id."""
    root = scratch_dir(spark, "append")
    rows = d.landing(spark, sf, "current_weather").drop("raw_id", land.PARTITION)
    rows = rows.withColumnRenamed("extracted_at", "_stamp").withColumn("_sync", F.substring(F.col("_stamp").cast("string"), 1, 10))
    edge = F.lit("2024-01-16")
    for half in (rows.filter(F.col("_sync") < edge), rows.filter(F.col("_sync") >= edge)):
        land.append_snapshot(half, root, "current_weather", F.col("_stamp"))
    landed = land.read_landing(spark, root, "current_weather")
    return landed.groupBy("city", "extracted_at").agg(
        F.count(F.lit(1)).alias("rows_landed"), F.countDistinct("raw_id").alias("ids")
    )


@query(
    "surrogate_key_nulls",
    f"WITH {d.SYNCS_SQL} SELECT raw_id, md5(coalesce(CASE WHEN k < 90 THEN event_type END, '_dbt_utils_surrogate_key_null_') || '-' || user_id) AS row_key FROM syncs",
)
def surrogate_key_nulls(spark, sf):
    return d.syncs(spark, sf).select("raw_id", surrogate_key(F.when(F.col("k") < 90, F.col("event_type")), "user_id").alias("row_key"))
