"""Connected components of a graph given by its edges, by alternating large and small stars.

A large star links every larger neighbour of a node to the smallest node around it; a small star
does so with the smaller neighbours and the node itself. Both keep the components, and repeating
them ends when each component is one star around its smallest node. Rows are edges only: no
neighbourhood is ever gathered. Nodes with a large part of all edges are joined by broadcast.

Before that, tasks of ``TASK_EDGES`` edges on average replace their own edges by a star per component
of theirs, which keeps the components too and leaves at most one edge per node and task. Where one task
has all edges, that is the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.llm.common import join_counted, star
from brambling.session import discard, spill

TASK_EDGES = 1 << 20


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``(u, v)`` from each node to the smallest one that the task's edges connect it with."""
    held = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches if b.num_rows]
    if not held:
        return
    ends = [np.concatenate(x) for x in zip(*held)]
    nodes, places = np.unique(np.concatenate(ends), return_inverse=True)
    root = star(*np.split(places, 2), len(nodes))
    own = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["u", "v"])


def _lowered(edges: DataFrame) -> DataFrame:
    """``edges (u, v)`` with ``m``, the smallest of u and all v of its edges."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    lowest = lowest.select("u", F.least("u", "m").alias("m"), "n")
    return join_counted(edges, lowest, ["u"], "n", edges.count())


def _state(edges: DataFrame) -> tuple[int, int]:
    return edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge to another; the component's smallest node.

    Null ends and edges of a node with itself are no edges. Repeated edges count once.
    """
    spark = edges.sparkSession
    # Held as (larger, smaller).
    oriented = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    given, given_path = spill(oriented.where("_a <> _b").select("u", "v"))
    tasks = max(1, -(-given.count() // TASK_EDGES))
    contracted = given.select(F.col("u").cast("long"), F.col("v").cast("long")).coalesce(tasks).mapInArrow(_contract, "u long, v long")
    now, path = spill(contracted if tasks == 1 else contracted.distinct())
    discard(spark, given_path)
    if tasks == 1:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = _state(now)
    while True:
        both, both_path = spill(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = _lowered(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, large_path = spill(large)
        lowered = _lowered(large)
        small = lowered.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowered.select("u", F.col("m").alias("v")))
        before = path
        now, path = spill(small.where("u <> v").distinct())
        discard(spark, before, both_path, large_path)
        state, last = _state(now), state
        if state == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
