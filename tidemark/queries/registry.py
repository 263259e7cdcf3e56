"""Registered queries: a Spark plan over the given tables and, where SQL can say it, its oracle."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir, use_utc

Plan = Callable[[SparkSession, str], DataFrame]

#: Tasks for each core of the session among which narrow rows are dealt.
DEALS = 2
#: The same where each task keeps a range of them, whose wide rows it writes itself.
RANGES = 4


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame, nullable: Sequence[str] = ()) -> DataFrame:
    """Output types that both engines print alike.

    Decimals become doubles, dates text, times naive. Integers and booleans that can be NULL are
    named in ``nullable``: they become doubles and text, as neither has a common NULL form.
    """

    def out(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) or (f.name in nullable and isinstance(f.dataType, T.IntegralType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType) or f.name in nullable:
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(f.name)
        return c

    return df.select(*[out(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, nullable: Sequence[str] = ()) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return portable(plan(spark, sf_dir), nullable)

        run.__name__ = plan.__name__
        run.__doc__ = plan.__doc__
        REGISTRY[name] = Query(run, sql)
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt over the session's cores by a hash of ``by``, before each of them becomes several wide ones.

    A table with few row groups is read by as few tasks, however large it is; what follows the scan would stay in them.
    """
    return df.repartition(DEALS * df.sparkSession.sparkContext.defaultParallelism, *by)


def dealt_in_order(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt over the session's cores by ranges of ``by``, so that what is written by day needs no second deal when wide."""
    return df.repartitionByRange(RANGES * df.sparkSession.sparkContext.defaultParallelism, *by)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result that several branches read to shared scratch space, and read it back.

    Without it each branch would repeat the scan and the dedupe; the file also cuts the lineage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
