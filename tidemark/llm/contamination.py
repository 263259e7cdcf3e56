"""Benchmark decontamination: windows of normalised words, probed against a broadcast set of test windows.

Only DataFrame functions are used. The benchmark's windows become (1) a bitmap of fixed size over their
hashes, with which a document's windows are sifted inside the row, and (2) a table of the windows
themselves. Windows that pass the sieve are joined with that table by their words, which verifies them
exactly. The table is broadcast if its measured size is below BROADCAST_BYTES, else joined by shuffle; a
full bitmap only lets more windows through to the join.

Defined results: a null or wordless text has no windows and is clean; benchmark items without words have
none either; an item shorter than a window is one window of its own length; repeated documents and equal
ids are judged row by row, repeated items count once; columns of any name pass through ``drop_contaminated``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lower_ascii

WINDOW = 10
#: Bits of the sieve (a power of two): 128 KB in the plan, whatever the benchmark's size.
BITS = 1 << 20
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def _joined(found: Column, at: Column, length: Column) -> Column:
    return F.array_join(F.slice(found, at, length), " ")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """window (words joined by spaces), length, hash, items (sorted distinct ids as text); one row per window."""
    item = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    item = item.where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    places = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    each = item.withColumn("hashes", _hashes(F.col("words"))).select(
        "item",
        "length",
        F.explode(
            F.transform(
                places,
                lambda i: F.struct(
                    _joined(F.col("words"), i, F.col("length")).alias("window"),
                    F.xxhash64(F.slice("hashes", i, F.col("length"))).alias("hash"),
                ),
            )
        ).alias("w"),
    )
    return each.groupBy("w.window", "length", "w.hash").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _sieve(windows: DataFrame) -> tuple[Column, list[int], int]:
    """The bitmap as a constant, the lengths that occur, and the bytes of the table."""
    place = F.col("hash").bitwiseAND(F.lit(BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    cells = windows.groupBy((place / 64).cast("int").alias("cell")).agg(F.bit_or(bit).alias("bits")).collect()
    measured = windows.agg(
        F.collect_set("length").alias("lengths"),
        F.sum(F.length("window") + 12 * F.size("items") + 40).alias("bytes"),
    ).first()
    bitmap = [0] * (BITS // 64)
    for row in cells:  # at most BITS / 64 rows
        bitmap[row["cell"]] = row["bits"]
    return F.from_json(F.lit(json.dumps(bitmap)), "array<bigint>"), sorted(measured["lengths"]), measured["bytes"] or 0


def row_key(docs: DataFrame) -> list[Column]:
    """Two independent hashes of id and text: a key of a row's content."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("doc_id", "text")]
    return [F.xxhash64(*parts), F.xxhash64(*reversed(parts))]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, key_a, key_b, n_words, hits (place and length, words from 1), items."""
    table = benchmark_windows(benchmark, window)
    bitmap, lengths, size = _sieve(table)

    def passing(length: int) -> Column:
        """Windows of one length whose hash is in the sieve, with their words."""

        def sifted(i: Column) -> Column:
            place = F.xxhash64(F.slice("hashes", i, length)).bitwiseAND(F.lit(BITS - 1))
            cell = F.get(bitmap, F.call_function("shiftrightunsigned", place, F.lit(6)).cast("int"))
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
            return cell.bitwiseAND(bit) != 0

        places = F.filter(F.sequence(F.lit(1), F.size("words") - length + 1), sifted)
        taken = F.transform(
            places,
            lambda i: F.struct(
                i.alias("place"), F.lit(length).alias("length"), _joined(F.col("words"), i, F.lit(length)).alias("window")
            ),
        )
        return F.when(F.size("words") >= length, taken)

    # the row of a document itself; where rows are spread by window it has one of its own, which no item holds
    own = "null" if size <= BROADCAST_BYTES else "key_a"
    none = F.expr(f"array(named_struct('place', 0, 'length', 0, 'window', cast({own} as string)))")
    empty = F.expr("cast(array() as array<struct<place:int,length:int,window:string>>)")
    a, b = row_key(docs)
    prepared = docs.select("doc_id", a.alias("key_a"), b.alias("key_b"), words(F.col("text")).alias("words"))
    prepared = prepared.withColumn("hashes", _hashes(F.col("words")))
    probes = prepared.select(
        "doc_id", "key_a", "key_b", F.size("words").cast("bigint").alias("n_words"),
        F.explode(F.concat(none, *[F.coalesce(passing(n), empty) for n in lengths])).alias("probe"),
    ).select("doc_id", "key_a", "key_b", "n_words", "probe.*")
    table = table.select("window", "length", "items")
    joined = probes.join(F.broadcast(table) if size <= BROADCAST_BYTES else table, ["window", "length"], "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("place", "length"))
    grouped = (
        joined.where("place = 0 or items is not null")
        .groupBy("doc_id", "key_a", "key_b", "n_words")
        .agg(
            F.count_if(F.col("place") == 0).alias("copies"),
            F.collect_set(hit).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")


def hit_words(hits: Column) -> Column:
    """Distinct places of words inside hits, sorted (words from 1)."""
    return F.array_sort(
        F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["place"], h["place"] + h["length"] - 1))))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, unchanged."""
    found = scan(docs, benchmark, window).where(F.size("hits") > 0).select("key_a", "key_b").distinct()
    a, b = row_key(docs)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), a.alias("key_a"), b.alias("key_b"))
    return packed.join(found, ["key_a", "key_b"], "left_anti").select("row.*")
