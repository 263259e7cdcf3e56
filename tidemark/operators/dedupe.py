"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ranking:
    """Which row of a key wins: newest ``order`` first, then ``tie_break`` highest first.

    ``total`` says that the input holds no two rows of a key with the same order, so that no row
    hash is needed to decide and columns that nobody reads stay out of the scan.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    total: bool = False


def keep_latest(df: DataFrame, ranking: Ranking, ignore: Sequence[str] = ()) -> DataFrame:
    """One row per key.

    The last tie-break is a hash of the row itself (without ``ignore``), so that the winner
    does not depend on file or task order and a re-run picks the same row. Filtering on
    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, which
    also flattens a hot key.
    """
    content = [] if ranking.total else [c for c in df.columns if c not in ignore]
    best_first = Window.partitionBy(*ranking.keys).orderBy(
        *[F.desc_nulls_first(c) for c in ranking.order],
        *[F.desc_nulls_last(c) for c in ranking.tie_break],
        *([F.xxhash64(*content).desc()] if content else []),
    )
    return df.withColumn("_rn", F.row_number().over(best_first)).filter("_rn = 1").drop("_rn")


def latest_reading(df: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """Newest row of each group."""
    return keep_latest(df, Ranking(tuple(by), (at,)))
