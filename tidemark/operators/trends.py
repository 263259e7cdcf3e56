"""Row-based rolling averages and lags over one row per entity and day.

Frames count rows, not days: with missing days, "7" means seven observed days. A window holds
one entity's days, so that a group is bounded by the calendar whatever the raw volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidemark.functions.measures import rounded


def timeline(by: Sequence[str], at: str):
    return Window.partitionBy(*by).orderBy(at)


def rolling_avg(c: str, rows: int, digits: int, by: Sequence[str], at: str) -> Column:
    """Average of the current and the previous ``rows - 1`` rows."""
    return rounded(F.avg(c).over(timeline(by, at).rowsBetween(1 - rows, 0)), digits)


def prior_avg(c: str, rows: int, digits: int, by: Sequence[str], at: str) -> Column:
    """Average of the ``rows`` rows before the current ``rows``-row frame; NULL when there are none."""
    return rounded(F.avg(c).over(timeline(by, at).rowsBetween(1 - 2 * rows, -rows)), digits)


def previous(c: str, rows: int, by: Sequence[str], at: str) -> Column:
    return F.lag(c, rows).over(timeline(by, at))
