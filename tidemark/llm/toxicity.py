"""Toxicity: subword-bag embeddings, averaged into a linear softmax and trained with it in numpy.

A word is the mean of the vectors of its character n-grams and of the word itself, all hashed to
BUCKETS; a document is the mean of its distinct words; a linear softmax over the two labels reads that mean.
Vectors and softmax are trained jointly, so an unseen misspelling shares n-gram vectors with words seen.

Defined results: null and empty texts have the score of the bias alone; repeated rows score alike;
with one label only (or none) that label (or 0) is predicted everywhere; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER_ASCII, WORD

BUCKETS = 1 << 16
DIM = 8
GRAMS = (4, 5, 6)
#: At most so many labelled documents of label 0 and 1 are used to fit: a documented bound, not a cut of what is scored.
SAMPLE = {0: 3000, 1: 1500}
STEPS, BATCH, RATE, DECAY, SEED = 288, 128, 0.003, 3e-3, 7
#: The mean is scaled by this before the softmax, so that a few words among hundreds can carry a document.
SCALE = 200.0
#: So many blank words (zero vectors) join every mean, so that one odd word of a very short text decides little.
BLANK = 12
_FIND = re.compile(WORD).findall
#: Words whose contribution a task remembers before it starts over: bounds a task's memory.
REMEMBERED = 400_000


def subwords(word: str) -> list[int]:
    """Buckets of the word and of its n-grams between boundary marks."""
    marked = f"<{word}>"
    grams = [marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))]
    return [xxhash.xxh32_intdigest(g) & (BUCKETS - 1) for g in grams]


def words(text: str | None) -> list[str]:
    """Distinct words of the whole text, in order of their first places."""
    return list(dict.fromkeys(_FIND((text or "").translate(LOWER_ASCII))))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document with their weights in the mean over its distinct and the blank words."""
    found = words(text)
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    ids, weights = [], []
    for w in found:
        s = subwords(w)
        ids += s
        weights += [1 / (len(found) + BLANK) / len(s)] * len(s)
    summed = np.bincount(ids, weights)
    at = np.flatnonzero(summed)
    return at.astype(np.int32), summed[at].astype(np.float32)


def _bags(texts: pa.Array) -> pa.Array:
    pairs = [bag(t.as_py()) for t in texts]
    return pa.StructArray.from_arrays(
        [pa.array([p[0] for p in pairs], pa.list_(pa.int32())), pa.array([p[1] for p in pairs], pa.list_(pa.float32()))],
        ["ids", "weights"],
    )


class Model:
    """value: what a subword adds to the log-odds of label 1; bias: the log-odds without words."""

    def __init__(self, value: np.ndarray, bias: float):
        self.value, self.bias = value, bias

    def word(self, w: str) -> float:
        s = subwords(w)
        return float(self.value[s].mean())


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Adam over mini-batches: embeddings (BUCKETS x DIM) and the softmax (DIM x 2) together."""
    if not len(bags) or labels.min() == labels.max():
        sure = -4.0 if not len(bags) or labels.min() == 0 else 4.0
        return Model(np.zeros(BUCKETS, np.float32), sure)
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (table, out, bias)]
    class_weight = (len(labels) / (2 * np.bincount(labels, minlength=2))).astype(np.float32)
    step, passes = 0, -(-STEPS * BATCH // len(bags))
    for _ in range(passes):
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), BATCH):
            picked = [i for i in order[begin : begin + BATCH] if bags[i][0].size]
            if not picked:
                continue
            y, step = labels[picked], step + 1
            ids = np.concatenate([bags[i][0] for i in picked])
            w = np.concatenate([bags[i][1] for i in picked])[:, None] * np.float32(SCALE)
            sizes = np.array([bags[i][0].size for i in picked])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(table[ids] * w, starts)
            logits = mean @ out + bias
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            delta = e / e.sum(axis=1, keepdims=True)
            delta[np.arange(len(y)), y] -= 1
            delta *= class_weight[y][:, None] / len(y)
            used, where = np.unique(ids, return_inverse=True)
            spread = np.repeat(delta @ out.T, sizes, axis=0) * w
            grad = np.stack([np.bincount(where, spread[:, d], used.size) for d in range(DIM)], axis=1).astype(np.float32)
            for x, g, rows, (m, v) in (
                (table, grad + DECAY * table[used], used, state[0]),
                (out, mean.T @ delta + DECAY * out, slice(None), state[1]),
                (bias, delta.sum(axis=0), slice(None), state[2]),
            ):
                m[rows] = 0.9 * m[rows] + 0.1 * g
                v[rows] = 0.99 * v[rows] + 0.01 * g * g
                x[rows] -= RATE * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-6)
    apart = out[:, 1] - out[:, 0]
    return Model((table @ apart * np.float32(SCALE)).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on docs (doc_id, text) and labels (doc_id, label 0 or 1; a document marked both ways counts as 1).

    Each label gives the SAMPLE texts with the smallest hashes, equal texts once, so the driver holds
    a bounded number of bags. Only ids and hashes are shuffled to choose them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = labels.where(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    hashed = docs.select("doc_id", F.xxhash64(text).alias("hash")).join(marked, "doc_id")
    per_text = hashed.groupBy("label", "hash").agg(F.min("doc_id").alias("doc_id"))
    to_bag = F.arrow_udf(_bags, "struct<ids:array<int>,weights:array<float>>")
    bags, found = [], []
    for label in (0, 1):
        chosen = per_text.where(F.col("label") == label).orderBy("hash").limit(SAMPLE[label])
        rows = (
            docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"))
            .join(F.broadcast(chosen), ["doc_id", "hash"])  # SAMPLE rows of three numbers
            .dropDuplicates(["hash"])
            .orderBy("hash")
            .select(to_bag("text").alias("b"))
            .toArrow()
            .column("b")
        )
        for chunk in rows.chunks:
            for ids, weights in zip(chunk.field("ids"), chunk.field("weights")):
                bags.append((ids.values.to_numpy(), weights.values.to_numpy()))
                found.append(label)
    return train(bags, np.array(found, np.int64))


def score(docs: DataFrame, model: Model, text: str = "text"):
    """A column: the softmax probability of label 1, over the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    known: dict[str, float] = {}

    @F.arrow_udf("double")
    def infer(texts: pa.Array) -> pa.Array:
        m, out = shared.value, []
        for t in texts:
            found = words(t.as_py())
            if len(known) > REMEMBERED:
                known.clear()
            total = 0.0
            for w in found:
                v = known.get(w)
                if v is None:
                    v = known[w] = m.word(w)
                total += v
            z = m.bias + total / (len(found) + BLANK)
            out.append(1 / (1 + np.exp(-np.clip(z, -60, 60))))
        return pa.array(out, pa.float64())

    return infer(F.col(text).cast("string"))
