"""Connected components of an edge table by contraction.

Each round first contracts the edges a task holds with union-find (as few tasks
as ``TASK_EDGES`` edges each allow), then hooks every vertex to its neighbour
of least priority and rewrites the edges. The priority is the vertex itself in
one round, so the tasks' stars fold at once, and random in the next, so the
expected number of vertices falls by a constant factor whatever the order.
Every intermediate table is staged; nothing is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import join_staged, released, stage


class Forest:
    """Union-find over dense numbers, keeping only the edges that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


EDGE_ROWS = 1 << 20
TASK_EDGES = 1 << 14


def _local(batches):
    """Edges as stars of the components within a task (at most a vertex each)."""
    held, size = [], 0

    def stars():
        e = np.concatenate(held, axis=1)
        ids, at = np.unique(e, return_inverse=True)
        at = at.reshape(e.shape)
        f = Forest(len(ids))
        for a, b in zip(at[0].tolist(), at[1].tolist(), strict=True):
            f.join(a, b)
        root = np.array([f.root(i) for i in range(len(ids))])
        far = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_pydict({"a": ids[root[far]], "b": ids[far]})

    for x in batches:
        held.append(np.stack([x.column(0).to_numpy(), x.column(1).to_numpy()]))
        size += x.num_rows
        if size >= EDGE_ROWS:
            yield stars()
            held, size = [], 0
    if size:
        yield stars()


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges between different vertices, staged, after union-find in each task."""
    e = stage(edges.select("a", "b").filter("a != b").mapInArrow(released(_local), "a long, b long"), "edges")
    tasks = -(-e.count() // TASK_EDGES)
    if 1 <= tasks < e.rdd.getNumPartitions():
        e = stage(e.coalesce(tasks).mapInArrow(released(_local), "a long, b long"), "edges")
    return e


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (long columns a, b), staged.

    ``root`` is one vertex of the component, the same for all of it; a vertex
    without edges does not appear.
    """
    e = _contracted(edges)
    label = stage(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                  .select("node", F.col("node").alias("root")), "nodes")
    step = 0
    while not e.isEmpty():
        rank = (lambda c: F.xxhash64(c, F.lit(step))) if step % 2 else (lambda c: c)
        both = e.union(e.select("b", "a"))
        hook = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("r"), F.col("b").alias("v"))).alias("m"))
        hook = stage(hook.filter(F.col("m.r") < rank(F.col("a"))).select(F.col("a").alias("x"), F.col("m.v").alias("to")), "hook")

        def moved(df: DataFrame, c: str, hook=hook) -> DataFrame:
            return join_staged(df, hook.withColumnRenamed("x", c), c, "left", row_bytes=24) \
                .withColumn(c, F.coalesce("to", c)).drop("to")

        e = _contracted(moved(moved(e, "a"), "b"))
        label = stage(moved(label, "root").select("node", "root"), "label")
        step += 1
    return label
