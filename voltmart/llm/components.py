"""Connected components of a link table: star contraction, or one task for a small table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.session import cut_lineage

ONE_TASK = 1_000_000  # links that a single task may hold: 16 MB


def _towards_min(pairs: DataFrame) -> DataFrame:
    """(a, b, m): m is the least of a and all its b."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(least, "a")


def smallest_reachable(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest name each node reaches; ``names`` is sorted, links are pairs of positions."""
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # The roots move, and with them all that hangs below.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[label])
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return names[label]
        label = new


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    if not table.num_rows:
        return
    a, b = table["a"].to_numpy(), table["b"].to_numpy()
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    roots = smallest_reachable(names, place[: len(a)], place[len(a) :])
    for at in range(0, len(names), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 10_000]), pa.array(roots[at : at + 10_000])], names=["node", "root"])


def components(links: DataFrame, a: str, b: str, one_task: int = ONE_TASK) -> DataFrame:
    """node, root: every node of a link and the smallest node it can reach.

    Null ends, loops and repeated links are ignored. A table of at most ``one_task`` links is
    settled in one task. A larger one is contracted in rounds: links are moved to the smallest
    neighbour of their ends (first larger ends, then smaller ones) and checkpointed; rounds grow
    with the logarithm of the longest chain. Only counts and a hash of the links reach the
    driver. A node with most of the links is split by the planner's skew join.
    """
    edges = (
        links.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        .where("x IS NOT NULL AND y IS NOT NULL AND a <> b")
        .select("a", "b")
        .distinct()
    )
    edges, mark = cut_lineage(edges), None
    if edges.count() <= one_task:
        return edges.coalesce(1).mapInArrow(_together, "node long, root long")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _towards_min(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _towards_min(large)
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        edges = cut_lineage(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
