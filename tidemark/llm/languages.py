"""Language identification: each document is a mixture of languages.

A document's character trigrams are drawn from a mixture of the learned languages' trigram
distributions. Expectation-maximisation estimates the proportions; the set of languages is the one
with the best penalised likelihood among the nested sets ordered by those proportions.

Defined results: null text or no letter gives ``und``, score 0 and no languages; ties between
languages go to the smaller name; repeated rows are scored alike; without any labelled text every
document is ``und``; other columns are neither read nor needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tidy

#: Trigrams are hashed to this many buckets, so a model has languages x BUCKETS numbers whatever the corpus size.
BUCKETS = 1 << 16
#: Iterations of expectation-maximisation at most; it stops earlier once no proportion moves by SETTLED.
ROUNDS, SETTLED = 25, 1e-3
#: A further language must raise the log-likelihood by PENALTY * log(trigrams) plus SLACK per trigram.
PENALTY, SLACK = 4.0, 0.01
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    """Code point -> is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the lower-cased text and how often each occurs; anything but letters is a gap."""
    if not text:
        return np.empty(0, np.int64), np.empty(0)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    kept = letter[1:-1]  # the middle is a letter: every letter counts once, with its neighbours
    mixed = (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35))[kept]
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.bincount(mixed >> np.uint32(16), minlength=1)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.float64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of one partition: at most languages x BUCKETS rows."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            found, counts = trigrams(text.as_py())
            if found.size:
                total.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))[found] += counts.astype(np.int64)
    for lang, counts in total.items():
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * found.size, pa.string()), "bucket": found.astype(np.int32), "n": counts[found]}
        )


class Model:
    """languages: sorted names; probability: BUCKETS x languages."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.1
        self.probability = (smooth / smooth.sum(axis=0)).astype(np.float64) if languages else np.empty((BUCKETS, 0))

    def mixture(self, text: str | None) -> list[tuple[str, float]]:
        """The chosen languages with their proportions, largest first."""
        found, counts = trigrams(text)
        if not found.size or not self.languages:
            return []
        p, n = self.probability[found], counts.sum()
        order = np.argsort(-_proportions(p, counts)[0], kind="stable")
        best, chosen = -np.inf, ([0], np.ones(1))
        for size in range(1, len(order) + 1):
            subset = order[:size]
            share, likelihood = _proportions(p[:, subset], counts)
            score = likelihood - (size - 1) * (PENALTY * np.log(n + 1) + SLACK * n)
            if score <= best:
                break
            best, chosen = score, (subset, share)
        return sorted(((self.languages[i], float(s)) for i, s in zip(*chosen)), key=lambda x: (-x[1], x[0]))


def _proportions(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Maximum-likelihood mixture weights of the columns of p, and the log-likelihood they reach."""
    k, n = p.shape[1], counts.sum()
    share = np.full(k, 1 / k)
    mixed = p @ share
    if k > 1:
        for _ in range(ROUNDS):
            moved = share * ((counts / mixed) @ p) / n
            step = np.abs(moved - share).max()
            share, mixed = moved, p @ moved
            if step < SETTLED:
                break
    return share, float(counts @ np.log(mixed))


def fit(docs: DataFrame) -> Model:
    """Learn from the columns text and lang, over all rows whose lang is not null.

    Only bucket counts reach the driver: languages x BUCKETS rows, whatever the corpus size.
    """
    counts = (
        docs.where("text is not null and lang is not null")
        .select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .mapInArrow(tidy(_count), "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = np.asarray(counts.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names))
    table = np.zeros((BUCKETS, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    table[counts.column("bucket").to_numpy(), [place[x] for x in names]] = counts.column("n").to_numpy()
    return Model(languages, table)


def mixtures(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of array<struct<lang, share>>: the document's languages, largest share first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS doubles

    @F.arrow_udf("array<struct<lang:string,share:double>>")
    def infer(texts: pa.Array) -> pa.Array:
        m = shared.value
        rows = [[{"lang": a, "share": b} for a, b in m.mixture(t.as_py())] for t in texts]
        return pa.array(rows, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))

    return infer(F.col(text).cast("string"))


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, score and languages (name:share, comma-joined); the names must be free."""
    clash = {"lang_pred", "score", "languages"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns already there: {sorted(clash)}")
    mixture = F.col("mixture")
    found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), mixtures(docs, model).alias("mixture"))
    listed = F.transform(mixture, lambda m: F.concat(m["lang"], F.lit(":"), F.round(m["share"], 4).cast("string")))
    return found.select(
        "row.*",
        F.when(F.size(mixture) > 0, mixture[0]["lang"]).otherwise(F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(F.size(mixture) > 0, F.least(mixture[0]["share"], F.lit(1.0))).otherwise(F.lit(0.0)).alias("score"),
        F.array_join(listed, ",").alias("languages"),
    )
