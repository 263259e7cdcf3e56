"""Response bodies that may be broken: good records land, the rest goes to a dead-letter table with its reason.

Bodies are parsed as VARIANT, which never fails, and records are read from it by the feed's schema. A record is
dead when a value it holds cannot be read as the type of its field; the other records of its body still land.

Reasons: ``no_body`` (NULL), ``not_json``, ``no_record`` (nothing at the record's place), ``bad_record`` (no object),
``bad_value`` (with the path of the first such value). A missing key or a JSON null reads as NULL, a body with an
empty record list gives nothing at all; a number in quotes counts as the number, one with a fraction is no integer.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import ntz
from tidemark.session import scratch_dir
from tidemark.sources.feeds import FEEDS, Feed
from tidemark.sources.landing import PARTITION, append_snapshot

DEAD_COLUMNS = ("position", "reason", "path")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    A nested expression would be computed again at each use, and the code generated for all of them becomes a method
    that is too long to be compiled.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(value: Column, kind: T.StructType) -> Column:
    """The raw values of an object's fields; NULL if it is no object."""
    return F.try_variant_get(value, "$", "struct<" + ",".join(f"`{f.name}`:variant" for f in kind.fields) + ">")


def _is_given(raw: Column) -> Column:
    return raw.isNotNull() & ~F.is_variant_null(raw)


def _fault(raw: Column, read: Column, kind: T.DataType, path: str) -> Column:
    """Path of the first value below ``raw`` that ``read`` lost, or NULL."""
    lost = _is_given(raw) & read.isNull()
    if isinstance(kind, T.IntegralType):
        lost = lost | (F.try_variant_get(raw, "$", "double") != read.cast("double"))
    here = F.when(lost, F.lit(path))
    if isinstance(kind, T.StructType):
        return F.coalesce(here, _once(_parts(raw, kind), lambda parts: _first_fault(parts, read, kind, path)))
    if isinstance(kind, T.ArrayType):
        pairs = F.zip_with(
            F.try_variant_get(raw, "$", "array<variant>"), read, lambda r, t: _fault(r, t, kind.elementType, f"{path}[]")
        )
        return F.coalesce(here, F.get(F.filter(pairs, lambda p: p.isNotNull()), F.lit(0)))
    return here


def _first_fault(parts: Column, read: Column, kind: T.StructType, path: str) -> Column:
    return F.coalesce(*[_fault(parts[f.name], read[f.name], f.dataType, f"{path}.{f.name}") for f in kind.fields])


def _item(position: Column, record: Column, reason: Column, path: Column) -> Column:
    return F.struct(
        position.cast("int").alias("position"), record.alias("record"), reason.cast("string").alias("reason"), path.cast("string").alias("path")
    )


def _items(body: Column, payload: Column, feed: Feed) -> Column:
    """The records of a body with their places, or one item that says why it has none."""
    none = F.lit(None)
    no_record = F.lit(None).cast("variant")
    place = "$" + "".join(f'["{p}"]' for p in feed.record_path)

    def items(found: Column, listed: Column) -> Column:
        dead = (
            F.when(payload.isNull(), "no_body")
            .when(body.isNull(), "not_json")
            .when(~F.coalesce(_is_given(found), F.lit(False)), "no_record")
            .when(listed.isNull(), "bad_value")
        )
        path = F.when(dead == "bad_value", place)
        return F.when(dead.isNotNull(), F.array(_item(none, no_record, dead, path))).otherwise(
            F.transform(listed, lambda r, i: _item(i if feed.records_are_array else none, r, none, none))
        )

    def listed(found: Column) -> Column:
        return F.try_variant_get(found, "$", "array<variant>") if feed.records_are_array else F.array(found)

    return _once(F.try_variant_get(body, place, "variant"), lambda found: _once(listed(found), lambda rows: items(found, rows)))


def read_bodies(payloads: DataFrame, feed: str, payload: str = "payload") -> DataFrame:
    """One row per record or fault: the columns of ``payloads``, ``position``, ``reason``, ``path`` and the typed ``record``."""
    spec, kept = FEEDS[feed], payloads.columns
    clash = sorted({*DEAD_COLUMNS, "record"} & set(kept))
    if clash:
        raise ValueError(f"columns {clash} have a meaning here")
    parsed = payloads.select(F.struct(*kept).alias("_row"), F.try_parse_json(payload).alias("_body"))
    items = parsed.select("_row", F.explode(_items(F.col("_body"), F.col(f"_row.{payload}"), spec)).alias("_item"))
    schema = spec.schema
    item = F.col("_item")
    read = items.select("_row", "_item", F.try_variant_get(item["record"], "$", schema.simpleString()).alias("_read"))
    is_object = _parts(item["record"], schema).isNotNull()
    reason, path = item["reason"], item["path"]
    typed = read.select("_row", "_item", "_read", _fault(item["record"], F.col("_read"), schema, "$").alias("_path"))
    typed = typed.withColumn(
        "_reason",
        F.coalesce(reason, F.when(~is_object, "bad_record").when(F.col("_path").isNotNull(), "bad_value")),
    )
    bad_path = F.when(F.col("_reason") == "bad_value", F.coalesce(path, F.col("_path")))
    return typed.select(
        "_row.*", item["position"].alias("position"), F.col("_reason").alias("reason"), bad_path.alias("path"), F.col("_read").alias("record")
    )


def good_records(read: DataFrame, payload: str = "payload") -> DataFrame:
    """The records that land: other columns of the payloads, then the fields."""
    kept = [c for c in read.columns if c not in (*DEAD_COLUMNS, "record", payload)]
    return read.filter(F.col("reason").isNull()).select(*kept, "record.*")


def dead_letters(read: DataFrame) -> DataFrame:
    """What does not land: the raw body with reason, path and the record's position in the body."""
    return read.filter(F.col("reason").isNotNull()).drop("record")


def dead_letter_path(root: str, feed: str) -> str:
    return f"{root}/dead_letters/{feed}"


def land_bodies(payloads: DataFrame, root: str, feed: str, extracted_at: datetime | Column, payload: str = "payload") -> None:
    """Parse one sync once, append its records to landing and its dead letters next to it.

    ``payloads`` has the city of the request; ``extracted_at`` may be one of its columns under another name.
    """
    spark = payloads.sparkSession
    clash = sorted({"extracted_at", PARTITION} & set(payloads.columns))
    if clash:
        raise ValueError(f"columns {clash} are written by the landing")
    stamp = extracted_at if isinstance(extracted_at, Column) else ntz(extracted_at)
    staged = read_bodies(payloads.withColumn("_stamp", stamp.cast("timestamp")), feed, payload)
    path = scratch_dir(spark, "bodies")
    staged.write.parquet(path)
    read = spark.read.schema(staged.schema).parquet(path)
    append_snapshot(good_records(read, payload), root, feed, F.col("_stamp"))
    dead = dead_letters(read).withColumnRenamed("_stamp", "extracted_at").withColumn(PARTITION, F.col("extracted_at").cast("date"))
    dead.write.mode("append").partitionBy(PARTITION).parquet(dead_letter_path(root, feed))


def read_dead_letters(spark: SparkSession, root: str, feed: str) -> DataFrame:
    return spark.read.parquet(dead_letter_path(root, feed))
