"""The library's functions for plain SQL: scalar and table functions of the session, inlined by the optimizer.

``register_scalars`` gives keys, labels and lead times; ``register_log`` and ``register_config`` give table functions over views that
the caller names, so that failures are listed and resolved, and cities paused, from a SQL prompt. Table functions return
the table as it would be afterwards; storing it is up to the caller (``INSERT OVERWRITE`` or ``operators.contract``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.keys import NULL_MARKER
from tidemark.functions.labels import (
    AQI_NAMES,
    COMFORT_FLOORS,
    COMFORT_REST,
    CONGESTION_CEILINGS,
    CONGESTION_REST,
    DELAY_NAMES,
    NO_DATA,
)
from tidemark.operators.contract import OPEN_STATUSES


def _create(spark: SparkSession, signature: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def _named(values: dict[int, str], arg: str) -> str:
    return f"CASE {arg} {' '.join(f'WHEN {k} THEN {v!r}' for k, v in values.items())} END"


def _stepped(steps: list[tuple[str, str]], sign: str, rest: str, arg: str) -> str:
    whens = " ".join(f"WHEN {arg} {sign} {bound} THEN {name!r}" for bound, name in steps)
    return f"CASE WHEN {arg} IS NULL THEN {NO_DATA!r} {whens} ELSE {rest!r} END"


def register_scalars(spark: SparkSession, prefix: str = "feed_") -> None:
    """``surrogate_key(array)``, ``date_key``, ``aqi_label``, ``delay_severity``, ``comfort_label``, ``congestion_label``, ``lead_time_hours``."""
    scalars = {
        "surrogate_key(parts ARRAY<STRING>) RETURNS STRING": f"md5(array_join(parts, '-', '{NULL_MARKER}'))",
        "date_key(d DATE) RETURNS INT": "year(d) * 10000 + month(d) * 100 + dayofmonth(d)",
        "aqi_label(aqi INT) RETURNS STRING": _named(AQI_NAMES, "aqi"),
        "delay_severity(magnitude INT) RETURNS STRING": _named(DELAY_NAMES, "magnitude"),
        "comfort_label(value DECIMAL(18,6)) RETURNS STRING": _stepped(COMFORT_FLOORS, ">=", COMFORT_REST, "value"),
        "congestion_label(value DECIMAL(18,6)) RETURNS STRING": _stepped(CONGESTION_CEILINGS, "<", CONGESTION_REST, "value"),
        "lead_time_hours(target TIMESTAMP_NTZ, issued TIMESTAMP_NTZ) RETURNS INT":
            "CAST(round(CAST(timestampdiff(MICROSECOND, issued, target) AS DECIMAL(20,0)) / CAST(3600000000 AS DECIMAL(10,0)), 0) AS INT)",
    }
    for signature, body in scalars.items():
        _create(spark, prefix + signature, body)


def _columns(spark: SparkSession, view: str, arguments: set[str]) -> tuple[list[str], str]:
    fields = spark.table(view).schema.fields
    taken = arguments & {f.name.lower() for f in fields}
    if taken:  # a column hides an argument of its name
        raise ValueError(f"{view} has columns named like arguments: {sorted(taken)}")
    return [f.name for f in fields], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _changed(columns: list[str], changes: dict[str, str]) -> str:
    return ", ".join(f"{changes[c]} AS `{c}`" if c in changes else f"`{c}`" for c in columns)


def register_log(spark: SparkSession, view: str, prefix: str = "feed_") -> None:
    """Over an audit log: ``open_failures()``, ``resolve_run(id, at, note)``, ``resolve_stream(stream, at, note)``."""
    columns, ddl = _columns(spark, view, {"done_run", "done_stream", "done_at", "done_note"})
    is_open = f"NOT resolved AND status IN ({', '.join(map(repr, OPEN_STATUSES))})"
    _create(spark, f"{prefix}open_failures() RETURNS TABLE ({ddl})", f"SELECT * FROM {view} WHERE {is_open}")

    def resolving(hit: str) -> str:
        changes = {
            "resolved": f"CASE WHEN {hit} THEN true ELSE resolved END",
            "resolved_at": f"CASE WHEN {hit} THEN CAST(done_at AS TIMESTAMP) ELSE resolved_at END",
            "resolved_note": f"CASE WHEN {hit} THEN done_note ELSE resolved_note END",
        }
        return f"SELECT {_changed(columns, changes)} FROM {view}"

    how = f"done_at TIMESTAMP_NTZ, done_note STRING DEFAULT NULL) RETURNS TABLE ({ddl})"
    _create(spark, f"{prefix}resolve_run(done_run BIGINT, {how}", resolving("run_id = done_run"))
    _create(spark, f"{prefix}resolve_stream(done_stream STRING, {how}", resolving(f"stream_name = done_stream AND {is_open}"))


def register_config(spark: SparkSession, view: str, key: str, prefix: str = "feed_") -> None:
    """Over a table with ``is_active`` and ``updated_at``: ``toggle_active(key, active, at)``."""
    columns, ddl = _columns(spark, view, {"toggled_key", "toggled_to", "toggled_at"})
    kind = spark.table(view).schema[key].dataType.simpleString()
    hit = f"`{key}` = toggled_key"
    changes = {
        "is_active": f"CASE WHEN {hit} THEN toggled_to ELSE is_active END",
        "updated_at": f"CASE WHEN {hit} THEN CAST(toggled_at AS TIMESTAMP) ELSE updated_at END",
    }
    _create(
        spark,
        f"{prefix}toggle_active(toggled_key {kind}, toggled_to BOOLEAN, toggled_at TIMESTAMP_NTZ) RETURNS TABLE ({ddl})",
        f"SELECT {_changed(columns, changes)} FROM {view}",
    )
