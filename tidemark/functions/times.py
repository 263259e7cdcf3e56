"""Time helpers. Naive timestamps are UTC; the session zone must be UTC (see ``session``)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import _col


def naive_utc(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def hour_of(c: Column | str) -> Column:
    """Start of the clock hour, naive. ``date_trunc`` answers with a zoned timestamp, hence the cast."""
    return F.date_trunc("hour", _col(c)).cast("timestamp_ntz")


def ntz(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def lead_time_hours(target: Column | str, issued: Column | str) -> Column:
    """Whole hours between two naive timestamps, rounded half away from zero."""
    micros = F.timestamp_diff("MICROSECOND", _col(issued), _col(target))
    hours = micros.cast("decimal(20,0)") / F.lit(3_600_000_000).cast("decimal(10,0)")
    return F.round(hours, 0).cast("int")


def lead_time_bucket(target: Column | str, issued: Column | str) -> Column:
    """The four bucket names and their exclusive upper bounds."""
    gap = F.timestamp_diff("MICROSECOND", _col(issued), _col(target))

    def under(**kw):
        return gap < F.lit(int(timedelta(**kw) / timedelta(microseconds=1)))

    return (
        F.when(under(hours=6), "<6h")
        .when(under(hours=24), "6-24h")
        .when(under(days=3), "1-3d")
        .otherwise("3-5d")
    )
