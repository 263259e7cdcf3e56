"""Phrase collocations, counted in depth-truncated suffix subtrees that are built group by group.

The work follows the vertical partitioning of suffix trees that do not fit in memory:

1. Every place of a word starts a suffix, cut off after ``depth`` words and at the end of its piece of text.
   Prefixes of one word are counted in CELLS hash cells. A cell with more than ``budget`` suffixes is extended:
   its suffixes are counted again by their first two words, then three, until the cells are small enough.
   Cells in order are filled into groups of about ``budget`` suffixes, so a group's subtree fits in memory.
2. A scan writes, for every stretch of text and group, the distinct suffixes of that stretch with their counts, words
   numbered within the row. One shuffle brings each group together. Suffixes whose cell is still too
   large at full depth (one phrase that holds a large share of the corpus) are spread over tasks instead.
3. Every group's subtree is built on its own: suffixes are sorted, the totals of the leaves below a node are its count.
   Nodes above a group's prefix depth (the first word of an extended cell) are summed over groups.

The cell table is the only thing that is sent to tasks: at most CELLS numbers for each depth. Suffixes of
a first word whose whole cell is rarer than ``least`` are left out, as no phrase with them can be frequent.

Defined results: a null language counts as ``und``, a null or empty text has no words; texts of any length are read in stretches
of SLAB bytes that overlap by ``depth`` - 1 words; repeated rows count each time; an empty table gives no phrases;
columns other than the named two are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

DEPTH, LEAST, TOP = 4, 30, 2000
#: Hash cells of prefixes at each depth.
CELL_BITS = 16
CELLS = 1 << CELL_BITS
#: Suffixes a group should hold (it may hold twice as many): bounds a task's memory.
BUDGET = 800_000
#: Bytes of text that a task turns into suffixes at a time.
SLAB = 5_000_000
#: Tasks among which the rows of a phrase that cannot be split are spread.
SPREAD = 512
_EXTEND, _RARE = -1, -2
_LEFT_OUT = -SPREAD - 1
#: A-Z to a-z, piece ends to a full stop, tab to space: none of these bytes occurs inside a UTF-8 sequence.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
_END = b"."  # no word holds one, so it can stand for the end of a piece
_ENDED = _END.join((b" ", b" "))


def _plain(text: str) -> bytes:
    return text.encode().translate(_PLAIN).replace(_END, _ENDED)


def _slabs(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[str, list[bytes], int]]:
    """(group name, tokens, how many of them start a suffix) for stretches of about SLAB bytes."""
    waiting: dict[str, list[bytes]] = {}
    held = 0
    for batch in batches:
        for by, text in zip(batch.column(0), batch.column(1)):
            name, data = by.as_py(), _plain(text.as_py())
            if len(data) > SLAB:
                yield from ((name, tokens, own) for tokens, own in _stretches(data, depth))
                continue
            waiting.setdefault(name, []).append(data)
            held += len(data)
            if held >= SLAB:
                yield from ((n, tokens, len(tokens)) for n, parts in waiting.items() for tokens in [_ENDED.join(parts).split()])
                waiting, held = {}, 0
    yield from ((n, tokens, len(tokens)) for n, parts in waiting.items() for tokens in [_ENDED.join(parts).split()])


def _stretches(data: bytes, depth: int) -> Iterator[tuple[list[bytes], int]]:
    """A long text in parts, each with the next ``depth`` - 1 words behind its own."""
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + SLAB)
        end = len(data) if end < 0 else end
        own, ahead, stop = data[begin:end].split(), [], end
        while stop < len(data) and len(ahead) < depth - 1:
            nearest = data.find(b" ", stop + 1)
            nearest = len(data) if nearest < 0 else nearest
            ahead += data[stop:nearest].split()
            stop = nearest
        yield own + ahead, len(own)
        begin = end


def _suffixes(ids: np.ndarray, own: int, depth: int) -> list[np.ndarray]:
    """Columns of word numbers, 0 after the end of a piece; one row for each of the first ``own`` words."""
    padded = np.concatenate([ids, np.zeros(depth, ids.dtype)])
    columns = [ids]
    for step in range(1, depth):
        columns.append(np.where(columns[-1] == 0, 0, padded[step : step + len(ids)]))
    starts = np.flatnonzero(ids[:own])
    return [c[starts] for c in columns]


def _sort_key(columns: list[np.ndarray], size: int) -> np.ndarray:
    """One number a row that sorts like the columns, whose values are below ``size``."""
    key, most = columns[0].astype(np.int64), size
    for column in columns[1:]:
        if most * size >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            most = len(distinct)
        key, most = key * size + column, most * size
    return key


def _numbered(tokens: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Words as numbers in order of first places; 0 is the end of a piece."""
    known = {_END: 0}
    ids = np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int32, len(tokens))
    return ids, list(known)


def _hashes(name: str, words: list[bytes]) -> np.ndarray:
    seed = name.encode() + b"\0"
    return np.array([xxhash.xxh3_64_intdigest(seed + w) for w in words], np.uint64)


def _extended(hashes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash of a prefix from that of the prefix one word shorter and that of its last word."""
    return ((hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + more) * np.uint64(0xBF58476D1CE4E5B9)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _descend(columns: list[np.ndarray], by_word: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """What the tables say of every suffix, the rows whose cells are extended to the end, and their next prefix hashes."""
    place, rows, hashes = np.full(len(columns[0]), _EXTEND), np.arange(len(columns[0])), by_word[columns[0]]
    for table, following in zip(tables, [*columns[1:], None]):
        place[rows] = table[_cells(hashes)]
        more = place[rows] == _EXTEND
        rows, hashes = rows[more], hashes[more]
        if following is not None:
            hashes = _extended(hashes, by_word[following[rows]])
    return place, rows, hashes


def _scan_cells(tables: list[np.ndarray], depth: int):
    """Counts suffixes in the cells of their first len(tables) + 1 words, where shorter cells are to be extended."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words = np.zeros(CELLS, np.int64), Counter()
        for name, tokens, own in _slabs(batches, depth):
            if not tables:  # single words need no suffixes
                found = Counter(tokens[:own])
                found.pop(_END, None)
                words[name] += found.total()
                np.add.at(counts, _cells(_hashes(name, list(found))), np.fromiter(found.values(), np.int64, len(found)))
                continue
            ids, known = _numbered(tokens)
            hashes = _descend(_suffixes(ids, own, len(tables) + 1), _hashes(name, known), tables)[2]
            counts += np.bincount(_cells(hashes), minlength=CELLS)
        used = np.flatnonzero(counts)
        yield pa.record_batch(
            [
                pa.array([*words, *[None] * len(used)], pa.string()),
                pa.array([*[-1] * len(words), *used.tolist()], pa.int32()),
                pa.array([*words.values(), *counts[used].tolist()], pa.int64()),
            ],
            ["name", "cell", "n"],
        )

    return scan


def _partition(texts: DataFrame, depth: int, least: int, budget: int) -> tuple[list[np.ndarray], list[int], DataFrame]:
    """Cell tables (group, extend or rare), the first group of every depth, and all words counted by name."""
    tables: list[np.ndarray] = []
    firsts, group, totals = [], 0, None
    while len(tables) < depth:
        scanned = texts.mapInArrow(_scan_cells(tables, depth), "name string, cell int, n bigint")
        counted = written(scanned.groupBy("name", "cell").agg(F.sum("n").alias("n")), "phrase-cells")
        if totals is None:
            totals = counted.where("cell < 0").select("name", "n")
        cells = counted.where("cell >= 0").select("cell", "n").toArrow()  # at most CELLS rows
        counts = np.zeros(CELLS, np.int64)
        counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        small = counts <= budget
        table = np.where(small, group + (np.cumsum(np.where(small, counts, 0)) - 1).clip(0) // budget, _EXTEND)
        if not tables:
            table[counts < least] = _RARE
        tables.append(table)
        firsts.append(group)
        group = int(table.max(initial=group)) + 1
        if small.all():
            break
    return tables, firsts, totals


def _scan_suffixes(tables: list[np.ndarray], depth: int):
    """The distinct suffixes of every stretch of text by group, with their counts."""

    def packed(group: int, name: str, columns: list[np.ndarray], counts: np.ndarray, known: list[bytes]) -> dict:
        used, numbers = np.unique(np.concatenate(columns), return_inverse=True)
        if not len(used) or used[0]:  # 0 stays 0
            used, numbers = np.concatenate([[0], used]), numbers + 1
        wide = np.uint16 if len(used) < 1 << 16 else np.uint32
        words = b" ".join(known[i] for i in used[1:])
        return {
            "group": group,
            "name": name,
            "words": words,
            "suffixes": numbers.astype(wide).tobytes(),
            "counts": counts.astype(np.uint32).tobytes(),
        }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (name, tokens, own) in enumerate(_slabs(batches, depth)):
            ids, known = _numbered(tokens)
            columns = _suffixes(ids, own, depth)
            if not len(columns[0]):
                continue
            _, first, counts = np.unique(_sort_key(columns, len(known)), return_index=True, return_counts=True)
            columns = [c[first] for c in columns]
            place = _descend(columns, _hashes(name, known), tables)[0]
            place[place == _RARE] = _LEFT_OUT
            place[place == _EXTEND] = -1 - (31 * number + len(known)) % SPREAD
            order = np.argsort(place, kind="stable")
            bounds = np.flatnonzero(np.diff(place[order])) + 1
            rows = []
            for part in np.split(order, bounds):
                group = int(place[part[0]])
                if group != _LEFT_OUT:
                    rows.append(packed(group, name, [c[part] for c in columns], counts[part], known))
            yield pa.RecordBatch.from_pylist(rows, _PACKED)

    return scan


_PACKED = pa.schema([
    ("group", pa.int64()), ("name", pa.string()), ("words", pa.binary()), ("suffixes", pa.binary()), ("counts", pa.binary()),
])


def _subtree(rows: list[tuple], depth: int, prefix: int, least: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """Phrases and counts of the nodes of one group, depth by depth.

    Nodes from depth ``prefix`` on lie in this group alone, so rare ones go; those above are parts of a sum.
    """
    known: dict[bytes, int] = {}
    parts, weights = [], []
    for words, suffixes, counts in rows:
        listed = words.split(b" ") if words else []
        numbers = np.array([0, *[known.setdefault(w, len(known) + 1) for w in listed]], np.int32)
        n = len(counts) // 4
        wide = np.uint16 if len(suffixes) == 2 * depth * n else np.uint32
        parts.append(numbers[np.frombuffer(suffixes, wide).reshape(depth, n)])
        weights.append(np.frombuffer(counts, np.uint32))
    columns, weight = np.concatenate(parts, axis=1), np.concatenate(weights).astype(np.int64)
    parts.clear()
    order = np.argsort(_sort_key(list(columns), len(known) + 1), kind="stable")
    columns, weight = columns[:, order], weight[order]
    names = [b"", *known]
    new = np.zeros(len(weight), bool)
    new[0] = True
    for at in range(depth):
        new[1:] |= columns[at, 1:] != columns[at, :-1]
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(weight, starts)  # the leaves below a node lie side by side
        keep = columns[at, starts] > 0
        if at + 1 >= prefix:
            keep &= totals >= least
        nodes = columns[: at + 1, starts[keep]].T
        yield [b" ".join(names[i] for i in node).decode() for node in nodes], totals[keep]


def _build(firsts: list[int], depth: int, least: int):
    """Subtrees of all groups of a partition that is sorted by group and name."""
    bounds = np.array(firsts)

    def nodes(key: tuple[int, str], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        group, name = key
        prefix = int(np.searchsorted(bounds, group, side="right")) if group >= 0 else depth + 1
        for phrases, totals in _subtree(rows, depth, prefix, least):
            yield pa.record_batch(
                [pa.array([name] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(totals, pa.int64())],
                ["name", "phrase", "f"],
            )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for group, name, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and ((group, name) != key or group < 0):
                    yield from nodes(key, rows)
                    rows = []
                key = (group, name)
                rows.append(row)
        if rows:
            yield from nodes(key, rows)

    return build


def _texts(docs: DataFrame, text: str, by: str) -> DataFrame:
    return docs.select(
        F.coalesce(docs[by].cast("string"), F.lit("und")).alias("name"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")
    )


def frequent_phrases(
    docs: DataFrame, depth: int = DEPTH, least: int = LEAST, budget: int = BUDGET, text: str = "text", by: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """(name, phrase, f) of all phrases of up to ``depth`` words that occur ``least`` times, and (name, n) of all words.

    Phrases are joined by one space; ``name`` is the value of the column ``by``.
    """
    texts = _texts(docs, text, by)
    tables, firsts, totals = _partition(texts, depth, least, budget)
    packed = "group bigint, name string, words binary, suffixes binary, counts binary"
    suffixes = texts.mapInArrow(_scan_suffixes(tables, depth), packed)
    grouped = suffixes.repartition("group").sortWithinPartitions("group", "name")
    nodes = grouped.mapInArrow(_build(firsts, depth, least), "name string, phrase string, f bigint")
    counted = nodes.groupBy("name", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return written(counted, "phrases"), totals


def _exact(number: Column) -> Column:
    return number.cast("decimal(19,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two and more words with the cut that scores lowest: words, a, l, r, score.

    score = floor(2000000 * a / (l + r)) in decimals; ties go to the earliest cut.
    """
    split = phrases.select("name", "phrase", F.split("phrase", " ").alias("words"), F.col("f").alias("a")).where(F.size("words") > 1)
    cuts = split.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "name",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"),
    )
    left = phrases.select("name", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("name", F.col("phrase").alias("right"), F.col("f").alias("r"))
    found = cuts.join(left, ["name", "left"]).join(right, ["name", "right"])  # parts are at least as frequent
    score = F.call_function("div", _exact(F.col("a")) * F.lit(2000000), _exact(F.col("l")) + _exact(F.col("r")))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (
        found.groupBy("name", "phrase", "a").agg(lowest.alias("cut"))
        .select("name", "phrase", F.size(F.split("phrase", " ")).alias("words"), "a", "cut.l", "cut.r", "cut.score")
    )


def without_parts(candidates: DataFrame, percent: int = 80) -> DataFrame:
    """Candidates that do not lie inside a longer one with at least ``percent`` of their count."""
    words = F.split("phrase", " ")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size(words) - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
            ),
        )
    )
    longer = candidates.where(F.col("words") > 2).select("name", F.explode(spans).alias("phrase"), F.col("a").alias("f"))
    most = longer.groupBy("name", "phrase").agg(F.max("f").alias("f"))
    inside = _exact(F.col("f")) * 100 >= _exact(F.col("a")) * percent
    return candidates.join(most, ["name", "phrase"], "left").where(~F.coalesce(inside, F.lit(False))).drop("f")


def collocations(
    docs: DataFrame, depth: int = DEPTH, least: int = LEAST, top: int | None = TOP, budget: int = BUDGET, text: str = "text", by: str = "lang"
) -> DataFrame:
    """(name, rank, phrase, a, l, r, n, score): each name's best phrases, or all of them with ``top`` None."""
    phrases, totals = frequent_phrases(docs, depth, least, budget, text, by)
    kept = without_parts(written(scored(phrases), "phrase-scores"))
    order = Window.partitionBy("name").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)  # each task keeps only its best rows before the shuffle
    return ranked.join(totals, "name").select("name", "rank", "phrase", "a", "l", "r", "n", "score")
