"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: Words of the normalised word model: runs of letters, digits and any code point from U+0080 on.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words that are separated by ASCII white space only.
TOKEN = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_ASCII = str.maketrans(_UPPER, _LOWER)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else (no locale or Unicode case rules)."""
    return F.translate(text, _UPPER, _LOWER)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def returned() -> None:
    """Give the system back the memory that nothing uses; an allocator keeps it for this process otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidy(step: Step) -> Step:
    """A step of mapInArrow that leaves a small worker: those that wait for other tasks count for their executor's memory, too."""

    @wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        returned()

    return run


#: While an intermediate table is written: its shuffle files go at once, not when the driver happens to collect its
#: garbage; rows with long values (packed shingles, texts) reach Python in batches of few bytes.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def written(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared scratch folder and read it back.

    Later steps read files instead of repeating the work, also after an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = {key: spark.conf.get(key) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)
