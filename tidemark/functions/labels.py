"""Value-to-label mappings. The label texts and cut-offs in this file are fixed values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AQI_NAMES = {1: "Good", 2: "Fair", 3: "Moderate", 4: "Poor", 5: "Very Poor"}
DELAY_NAMES = {0: "Unknown", 1: "Minor", 2: "Moderate", 3: "Major", 4: "Undefined"}

COMFORT_FLOORS = [("0.75", "Excellent"), ("0.50", "Good"), ("0.25", "Fair")]
COMFORT_REST = "Poor"
CONGESTION_CEILINGS = [("0.2", "Low"), ("0.4", "Moderate"), ("0.6", "High")]
CONGESTION_REST = "Severe"
NO_DATA = "No data"

TREND_MARGIN = "0.02"
TREND_NAMES = ("Improving", "Worsening", "Stable", "Insufficient data")
ANOMALY_MARGIN = 5
ANOMALY_NAMES = ("Hot anomaly", "Cold anomaly", "Normal")
DAY_PARTS = [(5, "Night"), (11, "Morning"), (17, "Afternoon")]
DAY_PART_REST = "Evening"


def _dec(text: str) -> Column:
    return F.lit(Decimal(text))


def floor_label(c: Column, floors: list[tuple[str, str]], rest: str, missing: str) -> Column:
    out = F.when(c.isNull(), missing)
    for bound, name in floors:
        out = out.when(c >= _dec(bound), name)
    return out.otherwise(rest)


def ceiling_label(c: Column, ceilings: list[tuple[str, str]], rest: str, missing: str) -> Column:
    out = F.when(c.isNull(), missing)
    for bound, name in ceilings:
        out = out.when(c < _dec(bound), name)
    return out.otherwise(rest)


def comfort_label(c: Column) -> Column:
    return floor_label(c, COMFORT_FLOORS, COMFORT_REST, NO_DATA)


def congestion_label(c: Column) -> Column:
    return ceiling_label(c, CONGESTION_CEILINGS, CONGESTION_REST, NO_DATA)


def trend_label(recent: Column, prior: Column) -> Column:
    up, down, flat, unknown = TREND_NAMES
    return (
        F.when(prior.isNull(), unknown)
        .when(recent - prior > _dec(TREND_MARGIN), up)
        .when(prior - recent > _dec(TREND_MARGIN), down)
        .otherwise(flat)
    )


def anomaly_label(gap: Column) -> Column:
    hot, cold, normal = ANOMALY_NAMES
    return F.when(gap > ANOMALY_MARGIN, hot).when(gap < -ANOMALY_MARGIN, cold).otherwise(normal)


def day_part(hour: Column) -> Column:
    lower, out = 0, None
    for upper, name in DAY_PARTS:
        inside = hour.between(lower, upper)
        out = F.when(inside, name) if out is None else out.when(inside, name)
        lower = upper + 1
    return out.otherwise(DAY_PART_REST)
