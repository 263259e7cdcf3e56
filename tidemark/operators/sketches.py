"""Distinct counts that add up over days: a sketch per group and day is stored once, a range is a union of sketches.

Exact distinct counts of days cannot be summed, so an exact count of a range reads all its rows again. A sketch is a few
kilobytes whatever a day holds, and the union of sketches is the sketch of the union, so a range reads one small row
per group and day. The exact form stays ``rollup.distinct_counts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.partitions import finish_replacement, replace_partitions

#: Two to this many cells a sketch.
PRECISION = 14


def relative_error(sigmas: float = 1.0) -> float:
    """Standard error of an estimate over ``2 ** PRECISION`` cells, times ``sigmas``."""
    return sigmas * 1.04 / 2 ** (PRECISION / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], items: dict[str, Column]) -> DataFrame:
    """A sketch per group and item. Map tasks send one sketch a group, so a hot group costs no more than others.

    A NULL item is not counted; an item under a condition is ``when(condition, item)``.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c, PRECISION).alias(name) for name, c in items.items()])


def refresh_sketches(spark: SparkSession, path: str, rows: DataFrame, by: Sequence[str], day: str, items: dict[str, Column]) -> None:
    """Store the sketches of the days that ``rows`` holds whole; other days stay. A sketch cannot forget, so days are replaced."""
    finish_replacement(spark, path, day)
    replace_partitions(spark, distinct_sketches(rows, [*by, day], items), path, day)


def merged_counts(stored: DataFrame, by: Sequence[str], items: Sequence[str]) -> DataFrame:
    """Estimated distinct counts over the union of the stored sketches of each group."""
    return stored.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(i)).alias(i) for i in items])
