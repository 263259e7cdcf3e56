"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tidy, written

#: Edges that a task contracts at a time.
CHUNK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node that is not its own root; a root is the smallest node it is tied to."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(names.size)
    a, b = flat[: a.size], flat[a.size :]
    while a.size:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(parent, high, low)
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped
    moved = np.flatnonzero(parent != np.arange(names.size))
    return names[moved], names[parent[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("a", "b"))
        held.clear()
        return pa.RecordBatch.from_arrays(list(map(pa.array, forest(a, b))), names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) > CHUNK:
            yield flush()
    if held:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint, not null); component: its smallest node.

    Each round ties every node to its smallest neighbour, follows those ties, and renames the edges, so the
    edges between what is still apart shrink by half at least. Tasks contract what they hold beforehand. Every
    round is stored in the shared scratch folder; only counts reach the driver.
    """
    small = edges.select("a", "b").where("a <> b").mapInArrow(tidy(_contract), "a bigint, b bigint")
    left = written(small.distinct(), "components-edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ties = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("b"))
        ties = written(ties, "components-ties")
        while True:  # follow the ties to their roots: halves the depth each time
            up = ties.select(F.col("a").alias("b"), F.col("b").alias("up"))
            jumped = written(ties.join(up, "b").select("a", F.col("up").alias("b"), (F.col("up") < F.col("b")).alias("moved")), "components-ties")
            ties = jumped.select("a", "b")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = ties
        else:
            up = ties.select(F.col("a").alias("b"), F.col("b").alias("up"))
            labels = labels.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b"))
        from_, to = ties.select("a", F.col("b").alias("x")), ties.select(F.col("a").alias("b"), F.col("b").alias("y"))
        renamed = left.join(from_, "a").join(to, "b").where("x <> y")
        renamed = renamed.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        left = written(renamed, "components-edges")
    if labels is None:
        labels = left
    return written(labels.select(F.col("a").alias("node"), F.col("b").alias("component")), "components")
