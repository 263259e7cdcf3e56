"""Folder-level helpers over the Hadoop file system API: existence, partition listing, removal."""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Fixed value: how Spark names the folder of rows whose partition column is NULL.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """True when a Parquet dataset was committed here (a written, possibly empty, table)."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p)
    )


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a one-level partition column, from the folder names alone."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(unquote(n[len(prefix):]) for n in names if n.startswith(prefix))


def on_days(column: Column, days: list[str]) -> Column:
    """Whether a date column has one of these partition values, NULL among them."""
    hit = column.isin([date.fromisoformat(d) for d in days if d != NULL_VALUE])
    hit = F.coalesce(hit, F.lit(False))
    return hit | column.isNull() if NULL_VALUE in days else hit


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    remove(spark, f"{path}/{column}={value}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()
