"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

1. A document is its set of distinct word shingles, hashed. Equal sets become one node.
2. Links need common shingles: a set that links at p percent has at least p percent of its shingles in other
   sets too. Shingles are counted over all distinct sets, and sets with fewer shared ones are settled: they link
   with nothing. So documents that have only passages in common go no further, however long the passages.
   A part of all shingles, by their hash, is counted first: a set lacks at most 100 - p percent of its size there as
   well, so most sets are settled by that part, and the rest of the shingles is counted among the other sets only.
3. Candidates among the rest: sets that link differ in few shingles, so if the shingles are dealt into more
   segments than that number, some segment is equal in both. Each set gives a key for each of its segments, for
   the size class it is in and the one below. Connected components of nodes with common keys are the clusters
   outside which no link exists.
4. Within a cluster, blocks of nodes are multiplied pairwise: overlaps are accumulated over the common
   n-grams, pairs below the bound that their two sizes give are discarded, and each product returns a
   spanning forest of its links and every node's number of links, never the pairs themselves.
5. Connected components of the links are the classes. Where rows of one id have different sets, the id ties them.

The dealing is lossless. Sets of sizes a <= b with similarity at least p / 100 differ in D <= a (100 - p) / p
shingles. Of D + 1 + e segments at least 1 + e are equal in both. If one of the sets has at most e empty
segments, an equal segment is not empty, and both give its key; sets with more empty segments give keys of their
empty segments too, so two such sets also meet. e follows from the expected number of empty segments of the
smallest set of a class, so that it is hardly ever exceeded.

Defined results: documents without words, or with null text, have an empty set, no links, and are a class of
their own; fewer words than a shingle are one shingle; rows with one id and any words are one document for classes; rows
with a null id are told apart by their sets and never lend their id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import returned, tidy, written
from tidemark.llm.components import components, forest
from tidemark.llm.contamination import row_key

SHINGLE, PERCENT = 3, 90
#: Nodes of a block: a product reads two blocks at most.
BLOCK = 256
#: Keys that a task combines at a time before they are shuffled.
CHUNK = 1_000_000
#: Shingles of distinct sets that a task packs at a time.
PACKED = 400_000
#: Shingles that are counted together: bounds a task's memory.
COUNTED = 1_000_000
#: Of these, how many are compared at a time.
STRETCH = 100_000
#: Distinct sets whose credits are summed together, and the fewest groups of them.
SUMMED, SUMS = 1_000_000, 64
#: Nodes that may link, whose table of four numbers each is broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Nodes without an id are numbered from here.
NO_ID = 1 << 62
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: words between ASCII white space, A-Z lower-cased."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(found) - size + 1
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled = _mixed(rolled * _A + hashes[i : i + n])
    return np.unique(rolled)


@cache
def _classes(percent: int) -> list[int]:
    """Smallest sizes of the classes: a set links with sets of its own and of the two neighbouring classes only."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return bounds


@cache
def _spare(percent: int, c: int) -> int:
    """e of class c: more than the empty segments of its smallest sets by four standard deviations."""
    bounds = _classes(percent)
    differing, spare = (bounds[c + 1] - 1) * (100 - percent) // percent, 2
    while True:
        segments = differing + 1 + spare
        empty = segments * exp(-bounds[c] / segments)
        if empty + 4 * sqrt(empty) + 1 <= spare or spare > 4 * differing + 50:  # then most segments hold one shingle
            return spare
        spare += 1 + spare // 32


def keys(found: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The segment keys of a set (see the module's text)."""
    bounds, out = _classes(percent), []
    own = int(np.searchsorted(bounds, found.size, side="right")) - 1
    for c in (own - 1, own):
        differing = (bounds[c + 1] - 1) * (100 - percent) // percent if c >= 0 else 0
        if not differing:
            continue  # only equal sets link
        spare = _spare(percent, c)
        segments = differing + 1 + spare
        salts = np.array([c], np.uint64) * np.array([_B, _C])
        salted = _mixed(found + salts[1])
        segment = (salted % np.uint64(segments)).astype(np.int64)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, segment, _mixed(salted ^ _B))
        filled = np.bincount(segment, minlength=segments) > 0
        used = np.arange(segments, dtype=np.uint64)
        if segments - filled.sum() <= spare:
            used = used[filled]
        out.append(_mixed(sums[used.astype(np.int64)] + _mixed(used * _A + salts[0])))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _by_set(sids: np.ndarray, credit: np.ndarray, groups: int) -> Iterator[dict]:
    """Packed rows of credits, one for each group of sets."""
    group = (sids.view(np.uint64) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if at.size:
            yield {"part": int(group[at[0]]), "sids": sids[at].tobytes(), "owners": credit[at].astype(np.uint32).tobytes(), "rest": None}


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """(part, its rows' buffers) of rows sorted by part; a part is bounded."""
    part, rows = None, []
    for batch in batches:
        numbers = batch.column("part").to_pylist()
        columns = [batch.column(c) for c in batch.schema.names[1:]]
        for i, number in enumerate(numbers):
            if rows and number != part:
                yield part, rows
                rows = []
            part = number
            rows.append([c[i].as_buffer() if c[i].is_valid else b"" for c in columns])
    if rows:
        yield part, rows


def _first_bits(percent: int) -> int:
    """Shingles whose hash begins with so many zero bits are counted first: a share that is 2.5 times what a set may lack, at least."""
    bits = 0
    while bits < 4 and 5 * (100 - percent) << bits + 1 <= 200:
        bits += 1
    return bits


def _early(found: np.ndarray, first_bits: int) -> int:
    """How many of a set's shingles are among those counted first."""
    return int(np.searchsorted(found, np.uint64(1 << 64 - first_bits))) if first_bits else found.size


def _scan_shared(shingle: int, bits: int, groups: int, first_bits: int = 0, first: bool = True):
    """Shingles by part (their first ``bits`` bits) for every PACKED of them, packed, each with the set it is in.

    Of each set those that begin with ``first_bits`` zero bits (which are cut off), or if not ``first`` all others.

    A shingle of several sets in hand is sent once, marked; what it credits to those sets leaves in rows of part < 0,
    one for each of ``groups`` groups of sets.
    """

    def flush(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        sids, sets = np.array(list(held), np.int64), list(held.values())
        owner = np.repeat(np.arange(1, len(sets) + 1, dtype=np.uint32), [x.size for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        sizes = np.diff(np.append(starts, flat.size))
        credit = np.bincount(owner[np.repeat(sizes > 1, sizes)], minlength=sids.size + 1)[1:]
        flat, owner = flat[starts], np.where(sizes > 1, np.uint32(0), owner[starts])
        part = (flat >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(flat.size, np.int64)
        rest = (flat >> np.uint64(32 - bits)).astype(np.uint32)
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        rows = [row | {"part": -1 - row["part"]} for row in _by_set(sids[credit > 0], credit[credit > 0], groups)]
        for low, high in zip(edges[:-1], edges[1:]):
            used, local = np.unique(owner[low:high], return_inverse=True)
            if used[0]:
                used, local = np.concatenate([[0], used]), local + 1
            packed = local.astype(np.uint16 if used.size <= 1 << 16 else np.uint32)
            rows.append({
                "part": int(part[low]), "sids": sids[used[1:].astype(np.int64) - 1].tobytes(), "owners": packed.tobytes(),
                "rest": rest[low:high].tobytes(),
            })
        return pa.RecordBatch.from_pylist(rows, _PACKED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for text in batch.column("text"):
                found = shingles(text.as_py(), shingle)
                edge = _early(found, first_bits)
                part = found[:edge] << np.uint64(first_bits) if first else found[edge:]
                if part.size:
                    sid = int(_mixed(found ^ _A).sum().view(np.int64))
                    size += 0 if sid in held else part.size
                    held[sid] = part
                if size > PACKED:
                    yield flush(held)
                    held, size = {}, 0
        if held:
            yield flush(held)

    return scan


_PACKED = pa.schema([("part", pa.int64()), ("sids", pa.binary()), ("owners", pa.binary()), ("rest", pa.binary())])


def _stretches(held: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted shingles in stretches of about STRETCH, so that what is derived from them is small; equal ones stay together."""
    low = 0
    while low < held.size:
        high = held.size
        if low + STRETCH < held.size:
            first = held[low + STRETCH] & ~np.uint64(0xFFFFFFFF)
            high = int(np.searchsorted(held, first))
            if high <= low:  # one shingle fills the stretch
                high = int(np.searchsorted(held, first | np.uint64(0xFFFFFFFF), side="right"))
        yield held[low:high]
        low = high


def _credit(groups: int):
    """How many shingles of a set other sets have too, by part of the shingles: packed by groups of sets."""

    def credited(blocks: list[list]) -> list[dict]:
        # A shingle is 8 bytes, sorted in place: its 32 bits, then the place of its set among all in hand (0: marked).
        sids, place = np.unique(np.concatenate([np.frombuffer(names, np.int64) for names, _, _ in blocks]), return_inverse=True)
        place = np.concatenate([[0], place + 1]).astype(np.uint64)
        held, done, named = np.empty(sum(len(rest) // 4 for _, _, rest in blocks), np.uint64), 0, 0
        for names, owners, rest in blocks:
            local = np.frombuffer(owners, np.uint16 if len(rest) == 2 * len(owners) else np.uint32)
            own = place[named : named + len(names) // 8 + 1].copy()
            own[0] = 0
            part = held[done : done + local.size]
            part[:] = np.frombuffer(rest, np.uint32)
            part <<= np.uint64(32)
            part |= own[local]
            done, named = done + local.size, named + len(names) // 8
        held.sort()
        credit = np.zeros(sids.size + 1, np.int64)
        for some in _stretches(held):
            owner, key = some.astype(np.uint32), (some >> np.uint64(32)).astype(np.uint32)
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, key.size))
            least = owner[starts]
            shared = (least == 0) | (least != owner[starts + sizes - 1])
            places, counts = np.unique(owner[np.repeat(shared, sizes)], return_counts=True)
            credit[places] += counts
        credit = credit[1:]
        return list(_by_set(sids[credit > 0], credit[credit > 0], groups))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _grouped(batches):
            if part >= 0:
                found = credited(rows)
            else:
                found = [{"part": -1 - part, "sids": bytes(s), "owners": bytes(c), "rest": None} for s, c, _ in rows]
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("part", "sids", "owners")} for r in found], _CREDITS)

    return count


_CREDITS = pa.schema([("part", pa.int64()), ("sids", pa.binary()), ("owners", pa.binary())])


def _sum_credits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, credit) once for every set, from packed rows sorted by group."""
    for _, rows in _grouped(batches):
        sids, place = np.unique(np.concatenate([np.frombuffer(s, np.int64) for s, _ in rows]), return_inverse=True)
        credit = np.bincount(place, np.concatenate([np.frombuffer(c, np.uint32) for _, c in rows]), sids.size)
        yield pa.record_batch([pa.array(sids), pa.array(credit.astype(np.int64))], ["sid", "credit"])


def _credits(texts: DataFrame, total: int, different: int, shingle: int, first_bits: int = 0, first: bool = True) -> DataFrame:
    """(s1, credit): how many shingles of a set are in other sets of ``texts`` too; sets without any are left out.

    Shingles are compared by their part and 32 bits more, so a few may be taken for shared that are not.
    """
    bits, groups = min(28, (total // COUNTED).bit_length()), max(SUMS, different // SUMMED)
    rows = "part bigint, sids binary, owners binary"

    def dealt(packed: DataFrame) -> DataFrame:
        return packed.repartition("part").sortWithinPartitions("part")

    packed = texts.select("text").mapInArrow(tidy(_scan_shared(shingle, bits, groups, first_bits, first)), f"{rows}, rest binary")
    credits = dealt(packed).mapInArrow(tidy(_credit(groups)), rows)
    return dealt(credits).mapInArrow(tidy(_sum_credits), "sid bigint, credit bigint").withColumnRenamed("sid", "s1")


def texts_of(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose keys are in ``rows``, with its columns."""
    few = rows.count() <= BROADCAST_ROWS
    return texts.select("key_a", "key_b", "text").join(F.broadcast(rows) if few else rows, ["key_a", "key_b"])


def _may_link(texts: DataFrame, nodes: DataFrame, shingle: int, percent: int, first_bits: int = 0) -> DataFrame:
    """The nodes at least ``percent`` of whose shingles are in other sets too; no other node has a link.

    With ``first_bits`` the shingles that begin with so many zero bits, of which a node has ``early``, are counted first. A
    set that lacks too many of them is settled; the others are counted in the sets that are left.
    """
    early, credit = F.col("early" if first_bits else "n"), F.coalesce("credit", F.lit(0))
    total, different = nodes.agg(F.coalesce(F.sum(early), F.lit(0)), F.count("*")).first()
    counted = nodes.join(_credits(texts, total, different, shingle, first_bits), "s1", "left")
    counted = counted.withColumn("seen", credit).drop("credit").where((early - F.col("seen")) * 100 <= F.col("n") * (100 - percent))
    if not first_bits:
        return counted
    counted = written(counted, "jaccard-early")
    total, different = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rest = _credits(texts_of(texts, counted.select("key_a", "key_b")), total, different, shingle, first_bits, first=False)
    return counted.join(rest, "s1", "left").where((F.col("seen") + credit) * 100 >= F.col("n") * percent)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat))


def _tied(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys with their smallest nodes' places, and for every row the place of its key's first row."""
    order = np.lexsort((node, key))
    new = np.ones(order.size, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    first = order[new]
    return order, first, first[np.cumsum(new) - 1]


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) rows with one node for each key in hand, and forests (node, other) of what shared a key.

    The last key in hand stays there, so rows sorted by key are tied whole, however many chunks they take.
    """
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        key, node, a, b = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order, first, lead = _tied(key, node)
        if key.size:
            held.append((key[-1:], node[key == key[-1]].min(keepdims=True), np.empty(0, np.int64), np.empty(0, np.int64)))
        one, other = forest(np.concatenate([a, node[order]]), np.concatenate([b, node[lead]]))
        others = pa.concat_arrays([pa.nulls(first.size, pa.int64()), pa.array(other)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([key[first], one])), pa.array(np.concatenate([node[first], one])), others],
            names=["key", "node", "other"],
        )

    size = 0
    for batch in batches:
        node = batch.column("node").to_numpy()
        empty = np.empty(0, np.int64)
        if "keys" in batch.schema.names:
            lists = batch.column("keys")
            held.append((lists.flatten().to_numpy(), np.repeat(node, np.diff(lists.offsets.to_numpy())), empty, empty))
        else:
            other = batch.column("other")
            edge = other.is_valid().to_numpy(zero_copy_only=False)
            key = batch.column("key").to_numpy()
            held.append((key[~edge], node[~edge], node[edge], other.filter(other.is_valid()).to_numpy()))
        size += held[-1][0].size + held[-1][2].size
        if size > CHUNK:
            size = 0
            yield flush()
    if held:
        yield flush()


def product(
    node: np.ndarray, side: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], two: bool, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, node, links): links among the nodes of one block, or with ``two`` between nodes whose side differs.

    a, b: a spanning forest of the links; links: with how many documents each node links here.
    """
    order = np.argsort([s.size for s in sets], kind="stable")
    node, side, copies, sets = node[order], side[order], copies[order], [sets[i] for i in order]
    sizes = np.array([s.size for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    _, columns = np.unique(np.concatenate(sets), return_inverse=True)
    last = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    row = np.zeros(columns.max() + 1, np.int32)
    links = np.zeros(node.size, np.int64)
    left, right = [], []
    for i in range(node.size):
        if last[i] <= i + 1:
            continue
        own = columns[starts[i] : starts[i + 1]]
        row[own] = 1
        overlap = np.add.reduceat(row[columns[starts[i + 1] : starts[last[i]]]], starts[i + 1 : last[i]] - starts[i + 1])
        row[own] = 0
        other = slice(i + 1, last[i])
        linked = overlap * (100 + percent) >= percent * (sizes[i] + sizes[other])
        if two:
            linked &= side[other] != side[i]
        j = np.flatnonzero(linked) + i + 1
        if j.size:
            left.append(np.full(j.size, node[i]))
            right.append(node[j])
            links[i] += copies[j].sum()
            links[j] += copies[i]
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64), node, links
    return *forest(np.concatenate(left), np.concatenate(right)), node, links


def classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, key_a, key_b, node, n_shingles, key_set, component, n_links: one row per row of ``docs``.

    key_set: hash of the document's set; component: the smallest node of the class (a document's node is the smallest id with its set); n_links:
    linked documents, those with the same set included.
    """
    first_bits = _first_bits(percent)
    a, b = row_key(docs)
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), a.alias("key_a"), b.alias("key_b"), F.col("text").cast("string").alias("text")
    )

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, early = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            s1, s2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column("text")):  # one set is held at a time
                found = shingles(text.as_py(), shingle)
                n[i], early[i] = found.size, _early(found, first_bits)
                s1[i], s2[i] = _mixed(found ^ _A).sum(), _mixed(found ^ _B).sum()
            ids = batch.column("id").fill_null(-1).to_numpy()
            missing = batch.column("id").is_null().to_numpy(zero_copy_only=False)
            node = np.where(missing, NO_ID + (s1 >> np.uint64(3)).astype(np.int64), ids)
            numbers = map(pa.array, (node, n, early, s1.view(np.int64), s2.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key_a"), batch.column("key_b"), *numbers],
                names=["doc_id", "key_a", "key_b", "node", "n", "early", "s1", "s2"],
            )

    columns = "doc_id bigint, key_a bigint, key_b bigint, node bigint, n bigint, early bigint, s1 bigint, s2 bigint"
    every = written(keyed.mapInArrow(tidy(to_sets), columns), "jaccard-sets")
    filled = every.where("n > 0")
    nodes = filled.groupBy("s1", "s2").agg(
        F.min(F.struct("node", "key_a", "key_b")).alias("r"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("early").alias("early"),
    )
    nodes = written(nodes.select("s1", "s2", "r.*", "copies", "n", "early"), "jaccard-nodes")
    alive = written(_may_link(keyed, nodes, shingle, percent, first_bits).select("key_a", "key_b", "node", "copies"), "jaccard-alive")
    chosen = texts_of(keyed, alive).dropDuplicates(["key_a", "key_b"])  # repeated rows

    def to_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle) for t in batch.column("text")]
            lists = [_lists(found), _lists([keys(x, percent) for x in found])]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("copies"), *lists], names=["node", "copies", "found", "keys"])

    sets = chosen.select("node", "copies", "text").mapInArrow(
        tidy(to_members), "node bigint, copies bigint, found array<bigint>, keys array<bigint>"
    )
    sets = written(sets, "jaccard-alive-sets")
    combined = "key bigint, node bigint, other bigint"
    ties = sets.select("node", "keys").mapInArrow(tidy(_combine), combined)
    ties = ties.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_combine), combined)
    clusters = components(ties.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))

    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sets = sets.drop("keys").join(clusters.join(sizes, "component"), "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(F.col("side"), j).alias("x"), F.greatest(F.col("side"), j).alias("y")),
    )
    blocked = sets.withColumn("side", block).withColumn("pair", F.explode(pairs))

    def multiply(table: pa.Table) -> pa.Table:
        found = [np.asarray(x.values.to_numpy(zero_copy_only=False)).view(np.uint64) for x in table.column("found")]
        pair = table.column("pair")[0].as_py()
        columns = (table.column(c).to_numpy() for c in ("node", "side", "copies"))
        one, other, node, links = product(*columns, found, pair["x"] != pair["y"], percent)
        some = links > 0
        del found
        returned()
        return pa.table({
            "a": np.concatenate([one, node[some]]),
            "b": pa.concat_arrays([pa.array(other), pa.nulls(int(some.sum()), pa.int64())]),
            "links": np.concatenate([np.zeros(one.size, np.int64), links[some]]),
        })

    found = written(
        blocked.groupBy("component", "pair").applyInArrow(multiply, "a bigint, b bigint, links bigint"), "jaccard-links"
    )
    ids = filled.where("doc_id is not null").groupBy(F.col("node").alias("id"))
    several = ids.agg((F.min("s1") != F.max("s1")).alias("several")).where("several").select("id")
    sames = filled.join(several, F.col("node") == F.col("id"), "left_semi").select(F.col("node").alias("a"), "s1", "s2")
    sames = sames.join(nodes.select("s1", "s2", F.col("node").alias("b")), ["s1", "s2"]).where("a <> b").select("a", "b")
    linked = components(found.where("b is not null").select("a", "b").unionByName(sames))
    counted = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    classed = (
        nodes.select("s1", "s2", "node", "copies")
        .join(linked, "node", "left")
        .join(counted.withColumnRenamed("a", "node"), "node", "left")
        .select(
            "s1", "s2", F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    base = every.select("doc_id", "key_a", "key_b", "node", F.col("n").alias("n_shingles"), "s1", "s2", F.col("s1").alias("key_set"))
    placed = base.where("n_shingles > 0").join(classed, ["s1", "s2"]).drop("s1", "s2")
    alone = base.where("n_shingles = 0").drop("s1", "s2")
    alone = alone.withColumn("component", F.col("node")).withColumn("n_links", F.lit(0).cast("bigint"))
    return placed.unionByName(alone)


def component_id(component: Column) -> Column:
    """The class as an id of a document; null if no member has an id."""
    return F.when(component < NO_ID, component)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each class, unchanged: the one with the smallest id (of repeated rows, one).

    Rows without words link with nothing, so each different one stays. Where several different sets have one
    id, they cannot be told apart by class; they all stay, one row of each set.
    """
    found = classes(docs, shingle, percent)
    several = found.groupBy("node").agg((F.min("key_set") != F.max("key_set")).alias("several"))
    found = found.join(several, "node")
    empty = F.col("n_shingles") == 0
    chosen = found.where((F.col("node") == F.col("component")) | empty | F.col("several"))
    row = F.struct("key_a", "key_b")
    kept = chosen.groupBy("node", "key_set", F.when(empty, row).alias("own")).agg(F.min(row).alias("k"))
    kept = kept.select("k.*")
    a, b = row_key(docs)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), a.alias("key_a"), b.alias("key_b"))
    return packed.join(kept, ["key_a", "key_b"], "left_semi").dropDuplicates(["key_a", "key_b"]).select("row.*")
