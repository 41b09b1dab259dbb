"""Connected components: local contraction in bounded tasks, then large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devfold.llm.common import written
from devfold.llm.trie import Forest

#: Edges that one task contracts to a forest (16 bytes each).
TASK_EDGES = 1_000_000
#: Steps converge in O(log^2 n) rounds; more than this points at a mistake.
MOST_ROUNDS = 60


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: larger neighbours (large) or smaller ones and the node itself (small)."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task as stars on the smallest node of each of its components."""
    pairs = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1) for b in batches]
    if not pairs:
        return
    nodes, ends = np.unique(np.concatenate(pairs), return_inverse=True)
    forest = Forest(len(nodes))
    for a, b in np.unique(ends.reshape(-1, 2), axis=0).tolist():
        forest.union(a, b)
    root = np.fromiter(map(forest.find, range(len(nodes))), np.int64, len(nodes))
    far = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["u", "v"])


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(node, component)`` of every node in ``edges(src, dst)``: the smallest node reachable.

    Rows with a null end and loops are ignored; no edges give no rows. Each round is a
    table in the shared folder. Tasks of at most ``task_edges`` edges first replace theirs by a
    forest of the same components; rounds follow only where there was more than one such task.
    """
    given = written(
        edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    )
    tasks = max(1, -(-given.count() // task_edges))
    current = written(given.coalesce(tasks).mapInArrow(_contract, "u long, v long"))
    mark = None
    for _ in range(MOST_ROUNDS):
        if tasks == 1:
            break
        new = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (new["n"], new["s"]) == mark or not new["n"]:
            break
        mark = (new["n"], new["s"])
        current = written(_step(_step(current, True), False))
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
