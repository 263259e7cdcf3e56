"""Periodic run detection: stretches of words that repeat with a period, by block convolution.

A run is a stretch of consecutive words with smallest period q and length >= max(min_length, min_exponent * q)
that no neighbouring word extends keeping period q. Documents are laid one after the other, a mark between
them, and cut into aligned blocks of B words at the dyadic scales B = 1, 2, 4, ... Scale B finds the periods
q with B <= q < 2 B: a run of exponent 3 or more holds a whole block that occurs again q words later.

* An exact integer number theoretic transform gives, for every block and every distance d in [B, 2 B), the sum of
  squared differences between the block and the words d later, modulo as many primes as exceed the largest
  possible sum together. So the sum is zero (no mismatch) exactly where it is zero modulo each of them.
* Every such distance is a seed, which is extended to both sides while words d apart are identical.
* Only blocks whose every word occurs again less than 2 B words later are transformed: no other block can occur
  again at such a distance. Nothing is looked for inside a run of a smaller period q' <= B either: a block of B >= q'
  words that occurs again inside it does so at a multiple of q', and the stretch seeded by it has period q' throughout.

Defined results: null and empty texts have no words and no runs; texts of any length are read whole (memory grows
with the longest text of a task); repeated rows give equal results; an empty table gives an empty table; other columns,
whatever their names, pass through untouched, but the name of the new column must be free.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Documents are searched together until they have so many words; a longer document is searched alone.
TOGETHER = 1 << 16
#: Blocks are transformed so many numbers at a time: bounds a task's memory beside the words themselves.
AT_ONCE = 1 << 18
#: Primes k * 2^25 + 1 below 2^31 with a generator of their multiplicative group.
PRIMES = ((2013265921, 31), (469762049, 3), (1811939329, 13), (2113929217, 5))
_FAR = np.iinfo(np.int64).max

SCHEMA = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


@functools.lru_cache(maxsize=256)
def _powers(p: int, generator: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half modulo p."""
    root = pow(generator, (p - 1) // (2 * half), p)
    root = pow(root, p - 2, p) if inverse else root
    out = np.ones(half, np.uint64)
    size = 1
    while size < half:  # doubling: the next powers are the first ones times root^size
        out[size : 2 * size] = out[:size] * np.uint64(pow(root, size, p)) % np.uint64(p)
        size *= 2
    return out


def _forward(x: np.ndarray, p: int, generator: int) -> np.ndarray:
    """Transform of every row; frequencies stay in bit-reversed order."""
    rows, size = x.shape
    q, half = np.uint64(p), size // 2
    while half:
        v = x.reshape(rows, -1, 2, half)
        low, high = v[:, :, 0], v[:, :, 1]
        x = np.stack([(low + high) % q, (low + q - high) * _powers(p, generator, half, False) % q], axis=2).reshape(rows, size)
        half //= 2
    return x


def _backward(x: np.ndarray, p: int, generator: int) -> np.ndarray:
    """Inverse of ``_forward``."""
    rows, size = x.shape
    q, half = np.uint64(p), 1
    while half < size:
        v = x.reshape(rows, -1, 2, half)
        low, high = v[:, :, 0], v[:, :, 1] * _powers(p, generator, half, True) % q
        x = np.stack([(low + high) % q, (low + q - high) % q], axis=2).reshape(rows, size)
        half *= 2
    return x * np.uint64(pow(size, p - 2, p)) % q


def squared_differences(blocks: np.ndarray, windows: np.ndarray, p: int, generator: int) -> np.ndarray:
    """Modulo p: sums of (block - window from t)^2 for t in [0, B); blocks are B wide, windows 2 B."""
    width, q = blocks.shape[1], np.uint64(p)
    b, w = blocks.astype(np.uint64) % q, windows.astype(np.uint64) % q
    mirrored = np.zeros_like(w)
    mirrored[:, 0] = b[:, 0]
    mirrored[:, width + 1 :] = b[:, :0:-1]
    product = _backward(_forward(mirrored, p, generator) * _forward(w, p, generator) % q, p, generator)[:, :width]
    sums = np.concatenate([np.zeros((len(w), 1), np.uint64), np.cumsum(w * w % q, axis=1)], axis=1)
    own = (b * b % q).sum(axis=1, keepdims=True)
    return (own + (sums[:, width : 2 * width] - sums[:, :width]) + np.uint64(2) * (q - product)) % q


def matches(x: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(block starts, distances in [width, 2 width)) at which the block occurs again without a mismatch."""
    most, chosen, product = width * int(x.max()) ** 2, [], 1
    for prime in PRIMES:
        if product <= most:
            chosen.append(prime)
            product *= prime[0]
    if product <= most:
        raise ValueError("too many different words in one text")
    at, distance = [], []
    rows = max(1, AT_ONCE // (2 * width))
    for begin in range(0, len(starts), rows):
        s = starts[begin : begin + rows, None]
        blocks, windows = x[s + np.arange(width)], x[s + width + np.arange(2 * width)]
        zero = np.ones(blocks.shape, bool)
        for p, generator in chosen:
            zero &= squared_differences(blocks, windows, p, generator) == 0
        i, t = np.nonzero(zero)
        at.append(s[i, 0])
        distance.append(t + width)
    return (np.concatenate(at), np.concatenate(distance)) if at else (np.empty(0, int), np.empty(0, int))


def _same_until(x: np.ndarray, at: int, distance: int, step: int) -> int:
    """How far from ``at`` (in direction ``step``) words that are ``distance`` apart stay identical.

    The marks around every document end this: a word is never equal to a mark, and a mark counts as equal to none,
    else equal documents side by side would count as one stretch.
    """
    done, size = 0, 64
    while True:
        if step > 0:
            a = x[at + done : at + done + size]
            b = x[at + done + distance : at + done + distance + size]
            a = a[: len(b)]
        else:
            low = max(0, at - done - size)
            a, b = x[low : at - done][::-1], x[low + distance : at - done + distance][::-1]
        differs = np.flatnonzero((a != b) | (a == 0))
        if differs.size:
            return done + int(differs[0])
        done, size = done + len(a), size * 2


def _inside(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of [low, high) lie inside one of the runs [starts, ends); starts ascend, ends are their running maxima."""
    if not starts.size:
        return np.zeros(low.shape, bool)
    i = np.searchsorted(starts, low, side="right") - 1
    return (i >= 0) & (ends[np.maximum(i, 0)] >= high)


def _search(x: np.ndarray, longest: int, min_exponent: int, min_length: int) -> list[tuple[int, int, int]]:
    """Runs (place, length, period) of words x, where 0 is a mark between documents, and at both ends."""
    order = np.argsort(x, kind="stable")
    again = np.full(len(x), _FAR)
    following = order[1:][x[order[1:]] == x[order[:-1]]]
    again[order[:-1][x[order[1:]] == x[order[:-1]]]] = following
    again -= np.arange(len(x))
    again[x == 0] = _FAR
    found: list[tuple[int, int, int]] = []
    starts, ends = np.empty(0, np.int64), np.empty(0, np.int64)
    width, farthest = 1, again
    padded = np.concatenate([x, np.zeros(2 * longest + 4, x.dtype)])
    while width * min_exponent <= longest:
        s = np.flatnonzero(farthest < 2 * width) * width
        s = s[~_inside(starts, ends, s, s + 3 * width)]
        at, distance = matches(padded, s, width)
        new = ~_inside(starts, ends, at, at + width + distance)
        at, distance = at[new], distance[new]
        order = np.lexsort((at, distance))
        at, distance = at[order], distance[order]
        stretches = []
        for group in np.split(np.arange(len(at)), np.flatnonzero(np.diff(distance)) + 1):
            if not group.size:
                continue
            d, places, next_ = int(distance[group[0]]), at[group], 0
            while next_ < len(places):
                place = int(places[next_])
                low = place - _same_until(x, place, d, -1)
                high = place + _same_until(x, place, d, 1)
                next_ = int(np.searchsorted(places, high))
                if high - low + d >= max(min_length, min_exponent * d):
                    stretches.append((low, high - low + d, d))
        if stretches:
            low = np.array([r[0] for r in stretches])
            smaller = _inside(starts, ends, low, low + [r[1] for r in stretches])
            found += [r for r, inner in zip(stretches, smaller) if not inner]
            by_start = sorted((r[0], r[0] + r[1]) for r in found)
            starts = np.array([r[0] for r in by_start], np.int64)
            ends = np.maximum.accumulate(np.array([r[1] for r in by_start], np.int64)) if by_start else starts
        if len(farthest) % 2:
            farthest = np.append(farthest, _FAR)
        farthest, width = np.maximum(farthest[0::2], farthest[1::2]), width * 2
    return found


def find_runs(
    documents: list[list], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH
) -> list[list[tuple[int, int, int]]]:
    """For every list of words its runs (start, length, period), ordered by start, then period."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    known: dict = {}
    ids, begins = [0], []
    for words in documents:
        begins.append(len(ids))
        ids += [known.setdefault(w, len(known) + 1) for w in words]
        ids.append(0)
    found = _search(np.array(ids, np.int64), max(map(len, documents), default=0), min_exponent, min_length)
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if found:
        owner = np.searchsorted(begins, [r[0] for r in found], side="right") - 1
        for i, (place, length, period) in zip(owner, found):
            out[i].append((place - begins[i], length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def kept_words(words: list, runs: Iterable[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    spans = [(start + period, start + length) for start, length, period in runs]
    if not spans:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, [s[0] for s in spans], 1)
    np.add.at(gone, [s[1] for s in spans], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]


def _rows(documents: list[list[bytes]], min_exponent: int, min_length: int) -> list[dict]:
    out = []
    for words, runs in zip(documents, find_runs(documents, min_exponent, min_length)):
        rows = [{"start": s, "length": n, "period": q} for s, n, q in runs]
        out.append({"n_words": len(words), "runs": rows, "collapsed": b" ".join(kept_words(words, runs)).decode()})
    return out


def periodic_runs(text: Column, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> Column:
    """A struct of the text's word count, its runs and the text without what the runs repeat, single-spaced.

    Words are separated by ASCII white space. Every text is searched inside its task; nothing is shuffled.
    """
    arrow_type = pa.struct([
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ])

    @F.arrow_udf(SCHEMA)
    def search(texts: pa.Array) -> pa.Array:
        chunks, waiting, held = [], [], 0
        for t in texts:
            words = (t.as_py() or "").encode().split()  # bytes are split at exactly the six ASCII white spaces
            if waiting and held + len(words) > TOGETHER:
                chunks.append(pa.array(_rows(waiting, min_exponent, min_length), arrow_type))
                waiting, held = [], 0
            waiting.append(words)
            held += len(words)
        chunks.append(pa.array(_rows(waiting, min_exponent, min_length), arrow_type))
        return pa.concat_arrays(chunks)

    return search(text.cast("string"))


def with_runs(
    docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, text: str = "text", name: str = "periodic"
) -> DataFrame:
    """``docs`` with the column ``name`` of ``periodic_runs``."""
    if name.lower() in map(str.lower, docs.columns):
        raise ValueError(f"column {name!r} exists already")
    return docs.withColumn(name, periodic_runs(docs[text], min_exponent, min_length))
