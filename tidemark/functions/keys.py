"""Surrogate and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the null marker of the public surrogate-key definition.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the dash-joined text of the columns; NULL is written as a marker."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer, by arithmetic so that it stays inside generated code."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
