"""Aggregates that need more than one built-in function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import ratio_rounded


def distinct_counts(
    df: DataFrame, by: Sequence[str], item: str, major: Column, weight: str, digits: int, names: tuple[str, str, str]
) -> DataFrame:
    """Distinct items, distinct items that ever match ``major``, and the mean of ``weight`` over all rows.

    Two grouped steps instead of two ``count(distinct)``: those would make Spark expand every
    row once per distinct set. The first step spreads a hot group over its items.
    """
    per_item = df.groupBy(*by, item).agg(
        F.max(F.when(major, 1).otherwise(0)).alias("_major"),
        F.sum(weight).alias("_sum"),
        F.count(weight).alias("_n"),
    )
    total, matching, mean = names
    return per_item.groupBy(*by).agg(
        F.count(item).alias(total),
        F.count_if((F.col("_major") == 1) & F.col(item).isNotNull()).alias(matching),
        ratio_rounded(F.sum("_sum"), F.sum("_n"), digits).alias(mean),
    )


def mode_and_means(
    df: DataFrame, by: Sequence[str], mode: tuple[str, str], means: dict[str, tuple[str, int]]
) -> DataFrame:
    """Most frequent value (ties to the smallest) and rounded means, for groups of any size.

    ``mode()`` holds every distinct value of a group in one buffer; counting per value first
    keeps the state to one row per value, spread over the cluster.
    """
    source, target = mode
    sums = [F.sum(c).alias(f"_sum_{name}") for name, (c, _) in means.items()]
    counts = [F.count(c).alias(f"_n_{name}") for name, (c, _) in means.items()]
    per_value = df.groupBy(*by, source).agg(F.count(F.lit(1)).alias("_rows"), *sums, *counts)
    candidate = F.when(F.col(source).isNotNull(), F.struct((-F.col("_rows")).alias("n"), F.col(source).alias("v")))
    return per_value.groupBy(*by).agg(
        F.min(candidate)["v"].alias(target),
        *[ratio_rounded(F.sum(f"_sum_{name}"), F.sum(f"_n_{name}"), digits).alias(name) for name, (_, digits) in means.items()],
    )
