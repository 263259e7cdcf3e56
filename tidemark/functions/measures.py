"""Rounded aggregates over exact decimals, and the derived measures built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import _col

EXACT = "decimal(18,6)"


def exact(c: Column | str) -> Column:
    return _col(c).cast(EXACT)


def rounded(c: Column, digits: int) -> Column:
    """Round half away from zero and keep the value in an 8-byte decimal."""
    return F.round(c, digits).cast(f"decimal(18,{digits})")


def ratio_rounded(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded once.

    (28,6) over (20,0) divides at scale 16, so that a group would need more than 10^9 rows
    before the cut-off digits could move a rounding tie.
    """
    quotient = total.cast("decimal(28,6)") / F.nullif(count.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return rounded(quotient, digits)


def avg_rounded(c: Column | str, digits: int) -> Column:
    return ratio_rounded(F.sum(_col(c)), F.count(_col(c)), digits)


def min_rounded(c: Column | str, digits: int) -> Column:
    return rounded(F.min(_col(c)), digits)


def max_rounded(c: Column | str, digits: int) -> Column:
    return rounded(F.max(_col(c)), digits)


def sum_or_zero(c: Column | str, digits: int) -> Column:
    """Sum that is 0 for a group of NULLs. Kept wide: a total grows with the data."""
    total = F.coalesce(F.sum(_col(c)).cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))
    return F.round(total, digits)


def share_rounded(predicate: Column, digits: int) -> Column:
    return ratio_rounded(F.count_if(predicate), F.count(F.lit(1)), digits)


def most_frequent(c: Column | str) -> Column:
    """Most frequent non-NULL value of a group, ties to the smallest."""
    return F.mode(_col(c), deterministic=True)


def clamp_unit(c: Column) -> Column:
    """Clamp to 0..1; ``greatest`` skips NULL, so that NULL becomes 0."""
    zero, one = F.lit(0).cast("decimal(10,6)"), F.lit(1).cast("decimal(10,6)")
    return F.least(F.greatest(c, zero), one)


def comfort_parts(temp: Column, aqi: Column, congestion: Column) -> tuple[Column, Column, Column]:
    """Temperature over 30, AQI mapped from 1..5 to 0..1, and free-flow share (0.5 when unknown)."""
    wide = "decimal(24,12)"
    return (
        clamp_unit(temp.cast(wide) / F.lit(30).cast("decimal(4,0)")),
        (aqi.cast(wide) - F.lit(1)) / F.lit(4).cast("decimal(2,0)"),
        F.lit(1).cast("decimal(10,6)") - F.coalesce(congestion.cast("decimal(10,6)"), F.lit(0.5).cast("decimal(10,6)")),
    )


def comfort_index(norm_temp: Column, norm_aqi: Column, norm_traffic: Column) -> Column:
    """Fixed weights: 40 % temperature, 40 % clean air, 20 % traffic."""

    def weight(tenths: str) -> Column:
        return F.lit(tenths).cast("decimal(2,1)")

    part = "decimal(22,14)"
    return rounded(
        weight("0.4") * norm_temp.cast(part)
        + weight("0.4") * (F.lit(1) - norm_aqi).cast(part)
        + weight("0.2") * norm_traffic.cast(part),
        3,
    )
