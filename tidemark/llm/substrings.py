"""Substring deduplication: words of passages that documents with smaller ids have too.

A window is ``length`` consecutive words. Every window has an anchor, the smallest hash of the short grams
inside it, so equal windows have equal anchors and few anchors stand for many windows.

1. Prefilter: each partition counts its documents' anchors in a count-min sketch (two rows of bits for "one"
   and "two or more"); the merged sketch only ever overestimates in how many documents a window occurs.
2. Anchors that it estimates repeated are grouped exactly, which leaves those of two or more documents.
3. Windows with such anchors, and only they, are grouped exactly by 128-bit hashes of their words.
4. Each document loses the words covered by windows whose smallest document is another, smaller one.

Documents whose text is equal to that of a smaller id are settled before: all their windows start there.

Defined results: null text has no words; fewer words than ``length`` make no window; a null id is larger than
any other; rows with equal ids are no smaller than each other and keep what only they share; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

LENGTH = 50
#: Words of a gram; a window of 50 words holds 43 of them.
GRAM = 8
#: The sketch: ROWS rows of WIDTH cells (a power of two), two bits each: 8 MB, whatever the corpus size.
ROWS, WIDTH = 2, 1 << 24
#: Cells of a part in which sketches are merged.
PART = 1 << 16
#: Partial sketches of a part are merged in so many groups first.
FAN = 64
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _runs(hashes: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """A polynomial hash of every run of ``size`` hashes, from running sums (arithmetic modulo 2**64)."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(_inverse(int(base)), n), dtype=np.uint64, out=sums[1:])
    return _mixed((sums[size:] - sums[:-size]) * _powers(int(base), n - size + 1))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "replace").split()


def _hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _anchors(hashes: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every window."""
    gram = min(GRAM, length)
    least, width, span = _runs(hashes, gram, _P), 1, length - gram + 1
    while width < span:  # minima of runs of grams, twice as long each time
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def anchors(text: str | None, length: int) -> np.ndarray:
    """Distinct anchors of a text's windows."""
    found = words(text)
    return np.unique(_anchors(_hashes(found), length)) if len(found) >= length else np.empty(0, np.uint64)


def windows(text: str | None, length: int, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, two hashes) of the windows whose anchor is in ``kept`` (sorted)."""
    hashes = _hashes(words(text))
    at = np.flatnonzero(np.isin(_anchors(hashes, length), kept)) if len(hashes) >= length else np.empty(0, np.int64)
    if not at.size:
        return at, np.empty(0, np.uint64), np.empty(0, np.uint64)
    return at, _runs(hashes, length, _P)[at], _runs(_mixed(hashes ^ _Q), length, _Q)[at]


def _cells(found: np.ndarray, row: int, width: int) -> np.ndarray:
    salt = np.uint64((row + 1) * int(_Q) & ((1 << 64) - 1))
    return (_mixed(found + salt) >> np.uint64(8)) & np.uint64(width - 1)


class Sketch:
    """Count-min cells that tell none, one and more apart, as two planes of bits for each row."""

    def __init__(self, width: int = WIDTH) -> None:
        self.counts = np.zeros((ROWS, width), np.uint8)

    def add(self, found: np.ndarray) -> None:
        """Counts the anchors of one document: once in each cell that they meet."""
        for row, width in enumerate([self.counts.shape[1]] * ROWS):
            cells = np.unique(_cells(found, row, width))
            self.counts[row][cells] = np.minimum(self.counts[row][cells] + 1, 2)

    def parts(self) -> Iterator[tuple[int, bytes, bytes]]:
        flat = self.counts.reshape(-1, PART)
        for part in np.flatnonzero(flat.any(axis=1)):
            yield int(part), np.packbits(flat[part] >= 1).tobytes(), np.packbits(flat[part] >= 2).tobytes()


_PARTS = "part int, one binary, two binary"


def _merge(table: pa.Table) -> pa.Table:
    """Adds partial sketches of one part."""
    one = two = np.zeros(PART // 8, np.uint8)
    for a, b in zip(table.column("one"), table.column("two")):
        a, b = np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8)
        two, one = two | b | (one & a), one | a
    return pa.table(
        {"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "one": [one.tobytes()], "two": [two.tobytes()]}
    )


def repeated_cells(anchored: DataFrame, width: int = WIDTH) -> np.ndarray:
    """The merged sketch of the column ``anchors``: packed bits of the cells with two or more, ROWS x width / 8 bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketch(width)
        for batch in batches:
            for found in batch.column("anchors"):
                own.add(found.values.to_numpy(zero_copy_only=False).view(np.uint64))
        rows = list(own.parts())
        for at in range(0, len(rows), 64):
            part, one, two = zip(*rows[at : at + 64])
            yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "one": list(one), "two": list(two)})

    partial = anchored.select("anchors").mapInArrow(count, _PARTS)
    fanned = partial.withColumn("fan", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    merged = fanned.groupBy("part", "fan").applyInArrow(lambda t: _merge(t), _PARTS)
    planes = np.zeros((ROWS * width // PART, PART // 8), np.uint8)
    for row in merged.groupBy("part").applyInArrow(lambda t: _merge(t), _PARTS).select("part", "two").toLocalIterator():
        planes[row["part"]] = np.frombuffer(row["two"], np.uint8)
    return planes.reshape(ROWS, width // 8)


def maybe_repeated(found: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Which anchors the sketch estimates in two or more documents."""
    kept = np.ones(found.size, bool)
    for row in range(ROWS):
        cells = _cells(found, row, planes.shape[1] * 8).astype(np.int64)
        kept &= (planes[row][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    return kept


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _kept(found: list[bytes], digest: bool) -> str:
    joined = b" ".join(found)
    return hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace")


def deduplicate(docs: DataFrame, length: int = LENGTH, digest: bool = False, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept: one row per document.

    kept: the words that stay, joined by one space, or with ``digest`` their SHA-256 in hexadecimal, which
    spares the intermediate tables the texts of documents that are settled early. width: cells of a row of the
    sketch (a power of two, PART at least); a crowded sketch only lets more anchors through to the exact step.
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    keyed = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(text, F.lit(1)).alias("t2"),
        text.alias("text"),
    )
    key = ["id", "t1", "t2"]

    def to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(t.as_py(), length).view(np.int64) for t in batch.column("text")]
            rest = [batch.column(c) for c in key]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.list_(pa.int64()))], names=[*key, "anchors"])

    schema = "id bigint, t1 bigint, t2 bigint, anchors array<bigint>"
    every = written(keyed.select(*key, "text").mapInArrow(to_anchors, schema), "substrings-anchors")
    firsts = every.groupBy("t1", "t2").agg(F.min("id").alias("first"))
    marked = written(
        every.join(firsts, ["t1", "t2"]).select(*key, (F.col("id") > F.col("first")).alias("is_copy"), "anchors"),
        "substrings-marked",
    )
    originals = marked.where("not is_copy")
    planes = spark.sparkContext.broadcast(repeated_cells(originals, width))  # ROWS x width bits

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("anchors")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            kept = maybe_repeated(flat, planes.value)
            row = np.repeat(np.arange(batch.num_rows), sizes)[kept]
            taken = batch.select(key).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, _signed(flat[kept])], names=[*key, "anchor"])

    probable = originals.select(*key, "anchors").mapInArrow(sift, "id bigint, t1 bigint, t2 bigint, anchor bigint")
    probable = written(probable, "substrings-probable")
    shared = probable.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor")
    owned = probable.join(shared, "anchor").select(*key, F.lit(None).cast("boolean").alias("is_copy"), "anchor")
    state = (
        marked.select(*key, "is_copy", F.lit(None).cast("bigint").alias("anchor"))
        .unionByName(owned)
        .groupBy(*key)
        .agg(F.max("is_copy").alias("is_copy"), F.array_sort(F.collect_set("anchor")).alias("anchors"))
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What needs no window is settled here; the others' texts go on."""
        for batch in batches:
            n_words, removed, kept, texts = [], [], [], []
            for t, is_copy, some in zip(batch.column("text"), batch.column("is_copy"), batch.column("anchors")):
                found = words(t.as_py())
                gone = is_copy.as_py() and len(found) >= length
                n_words.append(len(found))
                removed.append(len(found) if gone else 0)
                open_ = len(some) > 0 and not gone
                kept.append(None if open_ else _kept([] if gone else found, digest))
                texts.append(t.as_py() if open_ else None)
            columns = [pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), *(pa.array(x, pa.string()) for x in (kept, texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("id"), *columns, batch.column("anchors")],
                names=["doc_id", "id", "n_words", "n_removed", "kept", "text", "anchors"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    settled_schema = (
        f"doc_id {id_type}, id bigint, n_words bigint, n_removed bigint, kept string, text string, anchors array<bigint>"
    )
    joined = keyed.join(state, key).select("doc_id", "id", "text", "is_copy", "anchors")
    settled = joined.mapInArrow(settle, settled_schema).withColumn("row", F.monotonically_increasing_id())
    settled = written(settled, "substrings-settled")
    pending = settled.where("text is not null")

    def to_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h1, h2, at = (np.concatenate(x) for x in list(zip(*held))[:3])
            same = [np.repeat(np.array(x, np.int64), [h[2].size for h in held]) for x in list(zip(*held))[3:]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [_signed(h1), _signed(h2), *map(pa.array, same), pa.array(at.astype(np.int32))],
                names=["h1", "h2", "id", "row", "place"],
            )

        for batch in batches:
            for text, some, doc, row in zip(*(batch.column(c) for c in ("text", "anchors", "id", "row"))):
                kept = np.sort(some.values.to_numpy(zero_copy_only=False).view(np.uint64))
                at, h1, h2 = windows(text.as_py(), length, kept)
                if at.size:
                    held.append((h1, h2, at, doc.as_py(), row.as_py()))
                    size += at.size
                if size > 100_000:
                    size = 0
                    yield flush()
        if held:
            yield flush()

    window_schema = "h1 bigint, h2 bigint, id bigint, row bigint, place int"
    places = pending.select("id", "row", "text", "anchors").mapInArrow(to_windows, window_schema)
    repeated = places.groupBy("h1", "h2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    gone = (
        places.join(repeated.select("h1", "h2", "lo"), ["h1", "h2"])
        .where("id > lo")
        .groupBy("row")
        .agg(F.collect_list("place").alias("places"))
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for t, at in zip(batch.column("text"), batch.column("places")):
                found = words(t.as_py())
                step = np.zeros(len(found) + 1, np.int64)
                if at.is_valid:
                    starts = at.values.to_numpy(zero_copy_only=False)
                    np.add.at(step, starts, 1)
                    np.add.at(step, starts + length, -1)
                covered = np.cumsum(step)[:-1] > 0
                removed.append(int(covered.sum()))
                kept.append(_kept([w for w, c in zip(found, covered) if not c], digest))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    cut = (
        pending.join(gone, "row", "left")
        .select("doc_id", "n_words", "text", "places")
        .mapInArrow(remove, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string")
    )
    return settled.where("text is null").select("doc_id", "n_words", "n_removed", "kept").unionByName(cut)
