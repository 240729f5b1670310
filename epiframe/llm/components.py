"""Connected components of a graph of any size, by alternating star contractions.

Each round joins edges with the least neighbour of their end, twice, and writes the new edges to the
checkpoint folder; edges never reach the driver. A hub's edges are a plain shuffle join that
adaptive execution may split. Rounds grow with the logarithm of the longest path. A graph that a count
shows to have at most SMALL edges is folded by one task instead of by rounds, in some 100 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


#: Edges that one task folds.
SMALL = 300_000


def _fold(edges: DataFrame) -> DataFrame:
    """(node, component) of a small graph."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := root.setdefault(x, x)) != x:
                root[x] = x = root.setdefault(y, y)
            return x

        for b in batches:
            for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
                u, v = top(u), top(v)
                if u != v:
                    root[max(u, v)] = min(u, v)
        yield pa.RecordBatch.from_arrays([pa.array(list(root), pa.int64()), pa.array([top(x) for x in root], pa.int64())], names=["node", "component"])

    return edges.coalesce(1).mapInArrow(fold, "node long, component long")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, component) for each node of edges (a, b), component its least connected node.

    Loops, repeated edges and edges with a null end count for nothing.
    """
    own = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    own = checkpointed(own.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")))
    mark = _mark(own)
    if mark[0] <= small:
        return _fold(own)
    while True:
        both = own.union(own.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = _mark(new)
        if now == mark:
            break
        own, mark = new, now
    roots = own.select(F.col("v").alias("node")).distinct()
    return own.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
