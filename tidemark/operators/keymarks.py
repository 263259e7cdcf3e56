"""Uniqueness over all history without reading all history: a stored bitmap of key hashes per partition.

Each partition keeps one bit per hash slot, in buckets of 32,768 bits. New keys are first tested against the bits of all
partitions OR-ed together; a key whose bit is unset is proven new. The few others are tested per partition, and only
partitions with a set bit are read to compare the keys themselves. Hash collisions cost reads, never a wrong answer.

With ``n`` keys a partition and ``slots`` bits, a fresh key hits a partition by chance with probability below ``n / slots``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.sources.partitions import finish_replacement, replace_partitions, replace_table

BUCKET_BITS = 32768
#: Bits a partition; a multiple of ``BUCKET_BITS``. Buckets without a key take no space. About 100 bits for each key keep needless
#: reads near 1 %; fewer cost reads only. Marks of different ``slots`` must not be mixed.
SLOTS = 128 * BUCKET_BITS


def _slot(key: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)) + 1  # the bitmap functions count from 1


def _marked(keys: DataFrame, key: str, slots: int) -> DataFrame:
    slot = _slot(key, slots)
    return keys.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_bit": F.bitmap_bit_position(slot)})


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.substr(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1


def key_marks(df: DataFrame, key: str, part: str, slots: int = SLOTS) -> DataFrame:
    """(part, bucket, bits) of the non-NULL keys of each partition, combined in the map tasks."""
    keys = _marked(df.filter(F.col(key).isNotNull()).select(part, key), key, slots)
    return keys.groupBy(part, F.col("_bucket").alias("bucket")).agg(F.bitmap_construct_agg("_bit").alias("bits"))


def refresh_marks(
    spark: SparkSession, path: str, rows: DataFrame, key: str, part: str, slots: int = SLOTS, whole: bool = False
) -> None:
    """Store the marks of the partitions that ``rows`` holds whole; with ``whole`` those of all partitions, others go."""
    finish_replacement(spark, path, part)
    replace = replace_table if whole else replace_partitions
    replace(spark, key_marks(rows, key, part, slots), path, part)


def stored_marks(spark: SparkSession, path: str, part: str, kind: str = "date") -> DataFrame:
    return spark.read.schema(f"bucket bigint, bits binary, {part} {kind}").parquet(path)


def suspects(fresh: DataFrame, marks: DataFrame, key: str, part: str, slots: int = SLOTS) -> DataFrame:
    """(key, part): stored partitions that may hold a key of ``fresh``. Keys that no partition can hold are absent."""
    probes = _marked(fresh.select(key).distinct(), key, slots)
    union = marks.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    seen = probes.join(union, F.col("_bucket") == F.col("bucket")).filter(_is_set(F.col("bits"), F.col("_bit")))
    seen = seen.select(key, "_bucket", "_bit")
    each = seen.join(marks, F.col("_bucket") == F.col("bucket")).filter(_is_set(F.col("bits"), F.col("_bit")))
    return each.select(key, part)


def duplicate_new_keys(
    spark: SparkSession, fresh: DataFrame, history: DataFrame, marks: DataFrame, key: str, part: str, slots: int = SLOTS
) -> DataFrame:
    """Non-NULL keys of ``fresh`` that occur more than once in ``fresh`` and ``history`` together, with their count.

    ``history`` is stored by ``part`` and ``marks`` are its marks; neither may hold the rows of ``fresh``. The verdict is that of
    counting all rows. Of ``history`` only the partitions are read in which a bit of a new key is set.
    """
    counted = fresh.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    path = scratch_dir(spark, "suspects")
    maybe = suspects(counted, marks, key, part, slots)
    maybe.write.parquet(path)
    maybe = spark.read.schema(maybe.schema).parquet(path)
    hit = [r[0] for r in maybe.select(part).distinct().collect()]  # at most one value a partition
    at = F.col(part)
    in_hit = F.coalesce(at.isin([v for v in hit if v is not None]), F.lit(None in hit))
    old = history.filter(in_hit).select(key).join(maybe.select(key).distinct(), key, "left_semi")
    old = old.groupBy(key).agg(F.count(F.lit(1)).alias("_old"))
    total = F.col("n") + F.coalesce("_old", F.lit(0))
    return counted.join(old, key, "left").select(key, total.alias("n")).filter("n > 1")
