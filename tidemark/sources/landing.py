"""Raw landing tables: append-only Parquet, partitioned by extract date."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import ntz
from tidemark.sources import paths
from tidemark.sources.feeds import FEEDS, Feed
from tidemark.sources.partitions import finish_replacement, replace_partitions

PARTITION = "extracted_date"


def landing_path(root: str, feed: str) -> str:
    return f"{root}/staging/{feed}"


def read_landing(spark: SparkSession, root: str, feed: str) -> DataFrame:
    return spark.read.schema(FEEDS[feed].landing_schema).parquet(landing_path(root, feed))


def stream_landing(spark: SparkSession, root: str, feed: str, **options: str) -> DataFrame:
    reader = spark.readStream.schema(FEEDS[feed].landing_schema)
    return reader.options(**options).parquet(landing_path(root, feed))


def _wrapped_ddl(feed: Feed) -> str:
    inner = f"struct<{feed.schema.simpleString()[len('struct<'):-1]}>"
    if feed.records_are_array:
        inner = f"array<{inner}>"
    for name in reversed(feed.record_path):
        inner = f"struct<{name}:{inner}>"
    return inner


def extract_records(payloads: DataFrame, feed: str, payload: str = "payload", mode: str = "FAILFAST") -> DataFrame:
    """Response bodies to records: one row per array element, or the (nested) object itself.

    Other columns of ``payloads`` are kept. A missing key reads as NULL, a body without the record gives no
    row; a value of the wrong type fails the run, as a failing cast would.
    """
    spec = FEEDS[feed]
    kept = [c for c in payloads.columns if c != payload]
    parsed = payloads.select(*kept, F.from_json(F.col(payload), _wrapped_ddl(spec), {"mode": mode}).alias("_body"))
    record = F.col(".".join(("_body", *spec.record_path)))
    record = F.explode(record) if spec.records_are_array else record
    found = parsed.select(*kept, record.alias("_record")).filter(F.col("_record").isNotNull())
    return found.select(*kept, "_record.*")


def tag_partition(records: DataFrame, locations: DataFrame, on: str = "location_id") -> DataFrame:
    """Add the city of the request to each record; a record of an unknown location keeps a NULL city.

    No broadcast hint: a location table of known small size is broadcast by its own
    statistics, and a large one falls back to a shuffle join.
    """
    city = locations.select(on, "city")
    return records.join(city, on, "left").drop(on)


def with_header(records: DataFrame, extracted_at: Column) -> DataFrame:
    """Fixed landing header: a row id and the extract time."""
    stamp = extracted_at.cast("timestamp")
    return records.select(
        F.uuid().alias("raw_id"), stamp.alias("extracted_at"), "*", stamp.cast("date").alias(PARTITION)
    )


def append_snapshot(records: DataFrame, root: str, feed: str, extracted_at: datetime | Column) -> None:
    """Append one sync as a whole new snapshot; repeats of earlier syncs are expected.

    A map-only job: the row ids are drawn while the files are written, so that a retried
    task replaces its own output and ids never differ between two readers.
    """
    stamp = extracted_at if isinstance(extracted_at, Column) else ntz(extracted_at)
    columns = FEEDS[feed].landing_schema.fieldNames()
    rows = with_header(records, stamp).select(*columns)
    rows.write.mode("append").partitionBy(PARTITION).parquet(landing_path(root, feed))


def newest_days(spark: SparkSession, root: str, feed: str, minutes: int = 5) -> DataFrame:
    """Landing rows of the extract days that can hold the latest batch, found by folder name.

    The newest extract lies on the newest day, so a window of ``minutes`` reaches back over as many days
    as it touches at most.
    """
    present = [d for d in paths.partition_values(spark, landing_path(root, feed), PARTITION) if d != paths.NULL_VALUE]
    landing = read_landing(spark, root, feed)
    if not present:
        return landing
    first = date.fromisoformat(present[-1]) - timedelta(days=-(-minutes // 1440))
    return landing.filter(F.col(PARTITION) >= F.lit(first))


def newest_extract(landing: DataFrame):
    """Time of the newest extract, or None; reads one column."""
    return landing.agg(F.max("extracted_at").cast("timestamp_ntz").alias("m")).first()["m"]


def batch_filter(newest, minutes: int = 5) -> Column:
    return F.col("extracted_at") >= ntz(newest - timedelta(minutes=minutes)).cast("timestamp")


def latest_batch(landing: DataFrame, minutes: int = 5) -> DataFrame:
    """Rows within a few minutes of the newest extract, so that repeats of older syncs are left out."""
    newest = newest_extract(landing)
    return landing.limit(0) if newest is None else landing.filter(batch_filter(newest, minutes))


def keep_recent(landing: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return landing.filter(F.col("extracted_at") >= ntz(as_of - timedelta(days=days)).cast("timestamp"))


def prune(spark: SparkSession, root: str, feed: str, as_of: datetime, days: int | None = None) -> None:
    """Delete raw rows older than the retention of the feed.

    Whole days are dropped as folders; only the day the cut-off falls into is rewritten.
    """
    days = FEEDS[feed].retention_days if days is None else days
    path = landing_path(root, feed)
    finish_replacement(spark, path, PARTITION)
    boundary = (as_of - timedelta(days=days)).date().isoformat()
    present = paths.partition_values(spark, path, PARTITION)
    if boundary in present:
        day = read_landing(spark, root, feed).filter(F.col(PARTITION) == F.lit(boundary).cast("date"))
        kept = keep_recent(day, as_of, days)
        if kept.isEmpty():
            paths.remove_partition(spark, path, PARTITION, boundary)
        else:
            replace_partitions(spark, kept, path, PARTITION)
    for value in present:
        if value < boundary:
            paths.remove_partition(spark, path, PARTITION, value)
