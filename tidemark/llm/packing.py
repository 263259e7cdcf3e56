"""Best-fit packing of documents into sequences, after a Martello-Toth dominance reduction.

Pieces of equal length are interchangeable, so the instance is its histogram of lengths: at most
``capacity`` numbers, whatever the corpus size. The driver plans on that histogram, in runs of alike
sequences; every piece then finds its place from its rank among the pieces of its length.

Reduction: a pair {j, k}, k the longest piece that still fits beside j, dominates every set with j if no
two or more other pieces sum to more than k and still fit; a piece that nothing fits beside dominates
alone. Such sets are fixed for good. What remains goes best-fit decreasing.

Defined results: a null or empty text is the end token alone; repeated rows are packed once each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from tidemark.llm.common import tidy, written

CAPACITY, END = 4096, 1
#: Token ids of words that a task remembers before it starts over: bounds a task's memory.
REMEMBERED = 250_000


#: ASCII marks but the apostrophe, which may belong to the letters after it.
_MARKS = string.punctuation.replace("'", "").encode()
#: A word between others, to tell their ids apart where many are encoded in one call.
_BETWEEN = "\u2605"


@cache
def _tokenizer(path: str) -> tuple[Tokenizer, dict[bytes, bytes], list[int]]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    return tokenizer, {}, tokenizer.encode(_BETWEEN, add_special_tokens=False).ids


@cache
def _letters(path: str) -> tuple[Tokenizer, np.ndarray] | None:
    """For words of lower-case Latin letters: the same merges on plain lines, and which ids end a word.

    Such a word is one unit that normalization leaves alone, and its last token alone has the suffix, if the
    tokenizer splits as below; None for any other tokenizer.
    """
    spec = json.loads(_tokenizer(path)[0].to_str())
    model, split = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    suffix = model.get("end_of_word_suffix")
    alike = (
        (spec["normalizer"] or {}).get("normalizers") == _NORMALIZERS
        and [x.get("type") for x in split] == ["Split", "ByteLevel"]
        and (split[0]["pattern"], split[0]["behavior"], split[0]["invert"]) == ({"Regex": _UNITS}, "Removed", True)
        and not (split[1]["add_prefix_space"] or split[1]["use_regex"])
        and model.get("type") == "BPE" and suffix and not model["continuing_subword_prefix"] and not model["dropout"]
        and all(re.search(r"[^\w\s]", x["content"]) for x in spec["added_tokens"])
    )
    if not alike:
        return None
    light = Tokenizer.from_file(path)
    light.normalizer = None
    light.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    last = np.zeros(max(model["vocab"].values()) + 1, bool)
    last[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
    return light, last


#: The settings that ``_letters`` knows.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Beyond ASCII, letters up to here are the same in all versions of Unicode and compose with none of each other.
_LATIN = "\u024f"


def _of_letters(word: bytes) -> str | None:
    """The lower-cased word, if it is all Latin letters and not all ASCII."""
    lowered = "" if word.isascii() else word.decode().lower()
    return lowered if lowered.isalpha() and max(lowered) <= _LATIN else None


def _learn(fresh: set[bytes], path: str) -> None:
    """Encodes words: those of Latin letters in plain lines, most others between two marks whose id is their own.

    A line that does not fall into as many parts as it has words is encoded word by word.
    """
    tokenizer, known, between = _tokenizer(path)
    letters, plain, odd = _letters(path), [], []
    if letters:
        spelt = [(w, w.decode()) for w in fresh if w.isalpha() and w.islower()]  # of bytes: ASCII letters
        spelt += [(w, s) for w in fresh if (s := _of_letters(w))]
        for begin in range(0, len(spelt), 20_000):
            words, texts = zip(*spelt[begin : begin + 20_000])
            lines = [" ".join(texts[i : i + 100]) for i in range(0, len(texts), 100)]
            encoded = letters[0].encode_batch_fast(lines, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in encoded), "<u4")
            ends = (4 * (np.flatnonzero(letters[1][ids]) + 1)).tolist()
            if len(ends) == len(words):
                raw = ids.tobytes()
                known.update((w, raw[a:b]) for w, a, b in zip(words, (0, *ends), ends))
        fresh = {w for w in fresh if w not in known}
    for w in fresh:
        simple = w.isascii() and b"<|" not in w and b"\0" not in w or w.decode().isalpha()
        (plain if simple and len(between) == 1 else odd).append(w)
    space = f" {_BETWEEN} ".encode()
    for begin in range(0, len(plain), 20_000):
        some = plain[begin : begin + 20_000]
        lines = [some[i : i + 100] for i in range(0, len(some), 100)]
        encoded = tokenizer.encode_batch_fast([space.join(x).decode() for x in lines], add_special_tokens=False)
        for line, e in zip(lines, encoded):
            ids = np.asarray(e.ids, "<u4")
            cuts = np.flatnonzero(ids == between[0])
            if len(cuts) + 1 != len(line):
                odd += line
                continue
            known.update(zip(line, (part.tobytes() for part in _parts(ids, cuts))))
    for begin in range(0, len(odd), 1000):
        some = odd[begin : begin + 1000]
        encoded = tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
        known.update((w, np.asarray(e.ids, "<u4").tobytes()) for w, e in zip(some, encoded))


def _parts(ids: np.ndarray, cuts: np.ndarray) -> Iterator[np.ndarray]:
    begin = 0
    for cut in (*cuts, len(ids)):
        yield ids[begin:cut]
        begin = cut + 1


def _encode(texts: list[str], path: str) -> Iterator[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit numbers.

    The tokenizer never joins across ASCII white space and lower-cases what is not a special token, so the
    ids of a text are those of its words in turn. Words are encoded once while a task remembers them; marks
    after a letter are units of their own, so such words are put together from two.
    """
    _, known, _ = _tokenizer(path)
    if len(known) > REMEMBERED:
        known.clear()
    split, fresh = [], set()
    for text in texts:
        raw = text.encode("utf-8", "replace")
        words = (raw if b"<|" in raw else raw.lower()).split()
        ids = list(map(known.get, words))
        split.append((words, ids))
        if None in ids:
            fresh.update([w for w, x in zip(words, ids) if x is None])
    ended = []
    for w in fresh:
        if w[-1] in _MARKS and b"<|" not in w:
            stem = w.rstrip(_MARKS)
            if stem and 97 <= stem[-1] <= 122:
                ended.append((w, stem, w[len(stem) :]))
    fresh.difference_update([w for w, _, _ in ended])
    fresh.update(x for _, *both in ended for x in both if x not in known)
    _learn(fresh, path)
    known.update((w, known[stem] + known[marks]) for w, stem, marks in ended)
    for words, ids in split:
        yield b"".join([known[w] if x is None else x for w, x in zip(words, ids)] if None in ids else ids)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end token, cut at ``capacity``.

    ``tokenizer`` is the path of a tokenizers JSON file that every executor can open.
    """
    id_type = docs.schema["doc_id"].dataType
    out = T.StructType(
        [
            T.StructField("doc_id", id_type),
            *[T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()))],
        ]
    )
    end = np.asarray([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows: list[list] = [[], [], [], [], []]
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _encode(texts, tokenizer)):
                    ids += end
                    for n, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[begin : begin + 4 * capacity]
                        for column, value in zip(rows, (doc_id, n, begin // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                kinds = (batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=out.names)

    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(tidy(cut), out)


class Plan:
    """Where the pieces of each length go: rows of (length, first rank, first sequence, sequences, offset).

    The piece of rank first + t lies in sequence ``first sequence + t % sequences`` at
    ``offset + length * (t // sequences)``.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self._next = dict.fromkeys(counts, 0)
        left = {length: n for length, n in counts.items() if n}
        self.fixed = self._reduce(left)
        self._best_fit(left)
        self.rows.sort()
        self._key = np.array([(r[0] << 44) + r[1] for r in self.rows], np.int64)
        self._at = np.array(self.rows, np.int64).reshape(-1, 5)

    def _put(self, length: int, sequence: int, sequences: int, offset: int, each: int = 1) -> None:
        self.rows.append((length, self._next[length], sequence, sequences, offset))
        self._next[length] += sequences * each

    def _open(self, sequences: int) -> int:
        self.sequences += sequences
        return self.sequences - sequences

    def _reduce(self, left: dict[int, int]) -> int:
        """Fixes dominating sets; returns how many sequences are settled."""
        one, many = 0, 0  # bit s: some one piece, or some two or more, sum to s
        top = (1 << (self.capacity + 1)) - 1
        for length in sorted(left):
            for _ in range(min(left[length], self.capacity // length)):
                many |= ((many | one) << length) & top
                one |= 1 << length
        lengths = sorted(left)
        for j in reversed(lengths):
            while left.get(j):
                room = self.capacity - j
                at = bisect_left(lengths, room + 1) - 1
                while at >= 0 and left.get(lengths[at], 0) < 1 + (lengths[at] == j):
                    at -= 1
                k = lengths[at] if at >= 0 else None
                if k is None:
                    n = left.pop(j)
                    self._put(j, self._open(n), n, 0)
                elif (many >> (k + 1)) & ((1 << (room - k)) - 1):
                    break
                else:
                    n = left[j] // 2 if j == k else min(left[j], left[k])
                    first = self._open(n)
                    for length, offset in ((j, 0), (k, j)):
                        self._put(length, first, n, offset)
                        left[length] -= n
        for length in [x for x, n in left.items() if not n]:
            del left[length]
        return self.sequences

    def _best_fit(self, left: dict[int, int]) -> None:
        """Best-fit decreasing over runs of alike sequences: room -> [(first sequence, how many)]."""
        runs: dict[int, list[tuple[int, int]]] = {}
        rooms: list[int] = []

        def keep(room: int, first: int, n: int) -> None:
            if n and room:
                if room not in runs:
                    runs[room] = []
                    rooms.insert(bisect_left(rooms, room), room)
                runs[room].append((first, n))

        for length in sorted(left, reverse=True):
            n = left[length]
            while n:
                at = bisect_left(rooms, length)
                if at < len(rooms):
                    room = rooms[at]
                    first, many = runs[room].pop()
                    if not runs[room]:
                        del runs[room], rooms[at]
                else:
                    room = self.capacity
                    many = -(-n // (room // length))
                    first = self._open(many)
                each = room // length
                whole = min(many, n // each)
                if whole:
                    self._put(length, first, whole, self.capacity - room, each)
                    keep(room - each * length, first, whole)
                    n -= whole * each
                rest = many - whole
                if rest and n:  # fewer than fill one more sequence
                    self._put(length, first + whole, 1, self.capacity - room, n)
                    keep(room - n * length, first + whole, 1)
                    keep(room, first + whole + 1, rest - 1)
                    n = 0
                else:
                    keep(room, first + whole, rest)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self._at[np.searchsorted(self._key, (length << 44) + rank, side="right") - 1]
        t = rank - row[:, 1]
        return row[:, 2] + t % row[:, 3], row[:, 4] + length * (t // row[:, 3])


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to ``capacity``).

    ``parts`` is read several times and should be stored. Ranks within a length are counted in as many
    shares as there are shuffle partitions, so that a length with most of the rows is not one task's.
    """
    spark = parts.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in parts.columns if c not in ("doc_id", "piece", "length")]
    dealt = parts.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares)).cast("int"))
    shared = dealt.groupBy("length", "_share").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in shared.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan(counts, capacity))  # grows with the capacity, not the rows
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    begun = shared.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begun"))
    order = Window.partitionBy("length", "_share").orderBy("doc_id", "piece", *others)
    ranked = dealt.withColumn("_rank", F.row_number().over(order)).join(begun, ["length", "_share"])

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def placed(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = plan.value.place(length.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    at = placed(F.col("length").cast("bigint"), (F.col("_begun") + F.col("_rank") - 1).cast("bigint"))
    out = ranked.withColumn("_at", at)
    return out.select(*parts.columns, F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenizes once, stores the pieces and packs them."""
    return pack(written(pieces(docs, tokenizer, capacity), "packing-pieces"), capacity)
