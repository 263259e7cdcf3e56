"""Schema tests: each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys that the parent lacks, with their row count; NULL keys pass.

    Both sides are reduced to one row per key before the join. An outer join with a marker keeps it so: an
    anti join would be pushed below the count, and every child row would go into it.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    marked = keys.join(known.withColumn("_known", F.lit(True)), column, "left")
    return marked.filter(F.col("_known").isNull()).drop("_known")


def outside_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is not in the list; NULL passes."""
    return df.filter(~F.col(column).isin(*values))


@dataclass(frozen=True)
class TableTests:
    """The schema tests of one table."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    relationships: tuple[tuple[str, str, str], ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()


def _result(counts: DataFrame, table: str, column: str, test: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def run_tests(
    tables: dict[str, DataFrame],
    suite: dict[str, TableTests],
    duplicates: Callable[[str, str], DataFrame | None] = lambda table, column: None,
) -> DataFrame:
    """One row per test with its number of violations.

    All NULL and value tests of a table share one aggregate, hence one scan. ``duplicates`` may know a better way to
    find the repeated keys of a table and column.
    """
    out: list[DataFrame] = []
    for name, tests in suite.items():
        df = tables[name]
        measures = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in tests.not_null]
        measures += [(c, "accepted_values", F.count_if(~F.col(c).isin(*vals))) for c, vals in tests.accepted]
        if measures:
            row = df.agg(*[m.alias(f"m{i}") for i, (_, _, m) in enumerate(measures)])
            lines = [
                F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), F.col(f"m{i}").alias("violations"))
                for i, (c, t, _) in enumerate(measures)
            ]
            out.append(
                row.select(F.explode(F.array(*lines)).alias("t")).select(
                    F.lit(name).alias("table_name"), "t.column_name", "t.test", "t.violations"
                )
            )
        for c in tests.unique:
            repeated = duplicates(name, c)
            repeated = duplicate_keys(df, c) if repeated is None else repeated
            counts = repeated.agg(F.count(F.lit(1)).alias("violations"))
            out.append(_result(counts, name, c, "unique"))
        for c, parent, parent_column in tests.relationships:
            counts = orphans(df, c, tables[parent], parent_column)
            counts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            out.append(_result(counts, name, c, "relationships"))
    return reduce(DataFrame.unionByName, out)
