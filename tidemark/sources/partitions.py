"""Writing date-partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import paths

READY, READY_ALL = "_READY", "_READY_ALL"


def write_days(df: DataFrame, path: str, partition: str) -> None:
    """Write one folder per date.

    The rebalance hint gathers each date before the write: without it every shuffle task would
    leave one small file per date. Adaptive execution splits a hot date over several tasks.
    """
    df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def swap_path(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_swap/{name}"


def replace_table(spark: SparkSession, df: DataFrame, path: str, partition: str) -> None:
    """Replace a whole table; the old one stays until the new one is complete."""
    _replace(spark, df, path, partition, READY_ALL)


def replace_whole(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace a table without partitions; the old one stays until the new one is complete."""
    swap = swap_path(path)
    df.hint("rebalance").write.mode("overwrite").parquet(swap)
    paths.move(spark, swap, path)


def replace_partitions(
    spark: SparkSession, df: DataFrame | None, path: str, partition: str, moved: dict[str, str] | None = None
) -> None:
    """Replace the partitions that ``df`` holds; it may read the table it replaces.

    ``moved`` names folders of other partitions that are complete already and are moved in with them.
    """
    _replace(spark, df, path, partition, READY, moved)


def _replace(
    spark: SparkSession, df: DataFrame | None, path: str, partition: str, marker: str, moved: dict[str, str] | None = None
) -> None:
    """Write next to the table, mark the result complete, then move it in.

    A run that dies in between is completed by the next one, so stored rows are never lost to a
    half-done replacement.
    """
    swap = swap_path(path)
    paths.remove(spark, swap)
    if df is not None:
        write_days(df, swap, partition)
    for value, folder in (moved or {}).items():
        paths.move(spark, folder, f"{swap}/{partition}={value}")
    paths.touch(spark, f"{swap}/{marker}")
    finish_replacement(spark, path, partition)


def finish_replacement(spark: SparkSession, path: str, partition: str) -> None:
    """Move a complete replacement in; drop an incomplete one."""
    swap = swap_path(path)
    if paths.exists(spark, f"{swap}/{READY_ALL}"):
        paths.move(spark, swap, path)
        return
    if paths.exists(spark, f"{swap}/{READY}"):
        for value in paths.partition_values(spark, swap, partition):
            paths.move(spark, f"{swap}/{partition}={value}", f"{path}/{partition}={value}")
    paths.remove(spark, swap)
