"""Threshold alerts: every rule of a set is tested in one pass over the input."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERE, WARNING = "Severe", "Warning"


@dataclass(frozen=True)
class AlertRule:
    """An alert fires where ``fires`` holds; its severity is Severe where ``severe`` holds.

    ``severe`` may be None (always Warning). ``value`` and ``unit`` describe the trigger.
    """

    alert_type: str
    fires: Callable[[], Column]
    severe: Callable[[], Column] | None
    value: Callable[[], Column]
    unit: Callable[[], Column]


def at_least(column: str, bound: str, severe: str | None, unit: str, name: str) -> AlertRule:
    def reaches(b):
        return F.col(column) >= F.lit(b).cast("decimal(18,6)")

    return AlertRule(
        name,
        lambda: reaches(bound),
        None if severe is None else (lambda: reaches(severe)),
        lambda: F.col(column),
        lambda: F.lit(unit),
    )


def at_most(column: str, bound: str, severe: str, unit: str, name: str) -> AlertRule:
    def falls_to(b):
        return F.col(column) <= F.lit(b).cast("decimal(18,6)")

    return AlertRule(name, lambda: falls_to(bound), lambda: falls_to(severe), lambda: F.col(column), lambda: F.lit(unit))


def one_of(column: str, values: Sequence[str], name: str) -> AlertRule:
    """Always severe; the matching value is reported as the unit."""
    return AlertRule(
        name,
        lambda: F.col(column).isin(*values),
        lambda: F.lit(True),
        lambda: F.lit(None),
        lambda: F.col(column),
    )


def threshold_alerts(df: DataFrame, rules: Sequence[AlertRule], keep: Sequence[str]) -> DataFrame:
    """One row per fired rule, next to the ``keep`` columns of the input row.

    A union of one branch per rule would scan the input once per rule; exploding the fired
    rules of each row scans it once and needs no shuffle, in batch and on a stream alike.
    """
    fired = [
        F.when(
            rule.fires(),
            F.struct(
                F.lit(rule.alert_type).alias("alert_type"),
                (F.lit(WARNING) if rule.severe is None else F.when(rule.severe(), SEVERE).otherwise(WARNING)).alias("severity"),
                rule.value().cast("decimal(18,6)").alias("trigger_value"),
                rule.unit().cast("string").alias("trigger_unit"),
            ),
        )
        for rule in rules
    ]
    alert = F.explode(F.array_compact(F.array(*fired)))
    return df.select(*keep, alert.alias("_alert")).select(*keep, "_alert.*")
