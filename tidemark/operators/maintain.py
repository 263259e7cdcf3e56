"""Keyed maintenance of config-like tables: upsert, insert-if-absent, cascade, toggle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import ntz


def _null_safe(keys: Sequence[str]) -> Column:
    """Null-safe key match between the aliases ``t`` and ``s``; Spark still treats it as an equi-join."""
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    now: datetime | None = None,
    touched: str = "updated_at",
) -> DataFrame:
    """Insert new rows and update the named columns of existing ones; other columns stay.

    Keys match null-safely. With ``now``, the ``touched`` column is set on inserted rows and on
    rows that a source row updates.
    """
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    both = t.join(s, _null_safe(keys), "full_outer")
    old, new = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()

    def value(c: str) -> Column:
        if c == touched and now is not None:
            return F.when(new, ntz(now).cast(target.schema[c].dataType)).otherwise(F.col(f"t.{c}"))
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c in update:
            return F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        return F.when(old, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))

    return both.select(*[value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key the target lacks."""
    fresh = source.alias("s").join(target.select(*keys).alias("t"), _null_safe(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def cascade_delete(parent: DataFrame, links: DataFrame, gone: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Remove parents and the links that point at them."""
    return parent.join(gone.select(key), key, "left_anti"), links.join(gone.select(key), key, "left_anti")


def toggle_active(df: DataFrame, match: Column, active: bool, now: datetime | None = None) -> DataFrame:
    """Set ``is_active`` where the condition holds, and the change time if the table has one."""
    hit = F.coalesce(match, F.lit(False))
    changes = {"is_active": F.when(hit, active).otherwise(F.col("is_active"))}
    if now is not None and "updated_at" in df.columns:
        changes["updated_at"] = F.when(hit, ntz(now).cast("timestamp")).otherwise(F.col("updated_at"))
    return df.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in df.columns])


def set_city_active(config: dict[str, DataFrame], city: str, active: bool, now: datetime | None = None) -> dict[str, DataFrame]:
    """Pause or resume a city and its source links."""
    ids = [r["location_id"] for r in config["locations"].filter(F.col("city") == city).select("location_id").collect()]
    return {
        **config,
        "locations": toggle_active(config["locations"], F.col("city") == city, active, now),
        "source_locations": toggle_active(config["source_locations"], F.col("location_id").isin(ids), active, now),
    }


def remove_city(config: dict[str, DataFrame], city: str) -> dict[str, DataFrame]:
    """Delete a city and its source links."""
    gone = config["locations"].filter(F.col("city") == city)
    locations, links = cascade_delete(config["locations"], config["source_locations"], gone, "location_id")
    return {**config, "locations": locations, "source_locations": links}


def add_city(
    config: dict[str, DataFrame],
    city: str,
    latitude: str,
    longitude: str,
    box: tuple[str, str, str, str] | None = None,
    now: datetime | None = None,
) -> dict[str, DataFrame]:
    """Add or move a city and link it to the weather source; with a box also to the traffic source."""
    spark = config["locations"].sparkSession
    known = config["locations"].filter(F.col("city") == city).select("location_id").first()
    top = config["locations"].agg(F.max("location_id").alias("m")).first()["m"] or 0
    loc_id = known["location_id"] if known else top + 1
    row = spark.range(1).select(
        F.lit(loc_id).cast("int").alias("location_id"),
        F.lit(city).alias("city"),
        F.lit(latitude).cast("decimal(18,6)").alias("latitude"),
        F.lit(longitude).cast("decimal(18,6)").alias("longitude"),
        F.lit(True).alias("is_active"),
        (ntz(now) if now else F.lit(None)).cast("timestamp").alias("updated_at"),
    )
    locations = upsert(config["locations"], row, ["city"], ["latitude", "longitude"], now)

    corners = ("min_lat", "min_lon", "max_lat", "max_lon")

    def link(source: str, values) -> DataFrame:
        return config["sources"].filter(F.col("source_name") == source).select(
            "source_id",
            F.lit(loc_id).cast("int").alias("location_id"),
            *[F.lit(v).cast("decimal(18,6)").alias(c) for c, v in zip(corners, values)],
            F.lit(True).alias("is_active"),
            (ntz(now) if now else F.lit(None)).cast("timestamp").alias("updated_at"),
        )

    key = ["source_id", "location_id"]
    links = insert_if_absent(config["source_locations"], link("openweather", (None,) * 4), key)
    if box is not None:
        links = upsert(links, link("tomtom", box), key, corners, now)
    return {**config, "locations": locations, "source_locations": links}


def reseed(stored: dict[str, DataFrame], seed: dict[str, DataFrame], now: datetime) -> dict[str, DataFrame]:
    """Refresh definitions from the seed; operators' switches (active, required) survive."""
    plan = {
        "sources": (["source_name"], ["connector_name", "api_key_env", "api_key_field", "schedule_cron"]),
        "streams": (["source_id", "stream_name"], ["target_schema", "target_table", "sync_mode"]),
        "locations": (["city"], ["latitude", "longitude"]),
        "source_locations": (["source_id", "location_id"], ["min_lat", "min_lon", "max_lat", "max_lon"]),
        "field_mappings": (["stream_id", "target_column"], ["source_expr", "data_type", "ordinal", "description"]),
        "validation_rules": (["stream_id", "target_column", "rule_type"], ["rule_value", "severity", "description"]),
    }
    return {
        **stored,
        **{name: upsert(stored[name], seed[name], keys, cols, now) for name, (keys, cols) in plan.items()},
    }
