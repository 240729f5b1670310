"""Links that connect all alike nodes of shared buckets, exactly, without making all pairs of a large group.

A group of copies of one text is a star: each copy is like the text, two copies less so. So first each node
of a bucket is compared with the bucket's hub, the node that meets others in most buckets (what is
edited meets nobody), a candidate for each node. Then rounds compare each node with the one before
it in a shuffled order, new each round. Only nodes that are not connected yet are compared, and
buckets whose nodes are all connected are left out, so groups become components by candidates of
their own size. Then, with no cap, every pair of a bucket's nodes whose components still differ is
compared. Pairs already connected need no comparison, so the components are those of comparing all
pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, small_enough
from .components import components


def _with_components(met: DataFrame, links: DataFrame | None) -> DataFrame:
    """met with c, the component of node, less the buckets that lie within one component."""
    if links is None:
        return met.withColumn("c", F.col("node"))
    found = small_enough(checkpointed(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnsRenamed({"node": "node_", "component": "c_"})))
    rows = met.join(found, F.col("node") == F.col("node_"), "left").withColumn("c", F.coalesce("c_", "node")).drop("node_", "c_")
    mixed = rows.groupBy("k").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("k")
    return checkpointed(rows.join(mixed, "k", "left_semi"))


def _to_hubs(rows: DataFrame, here: Column) -> DataFrame:
    """(p, q): each node of a bucket with the bucket's hub."""
    degrees = rows.groupBy("node").agg(F.count("*").alias("degree_")).withColumnRenamed("node", "node_")
    known = rows.join(degrees, F.col("node") == F.col("node_"))
    hubs = known.groupBy("k").agg(F.max_by(here, F.struct("degree_", F.xxhash64("node"), "node")).alias("q"))
    return rows.select("k", here.alias("p")).join(hubs, "k").where("p.c <> q.c")


def _to_neighbours(rows: DataFrame, here: Column, nth: int) -> DataFrame:
    order = Window.partitionBy("k").orderBy(F.xxhash64("node", F.lit(nth)))
    return rows.select(here.alias("p"), F.lag(here).over(order).alias("q")).where("p.c <> q.c")


def _to_all(rows: DataFrame, here: Column) -> DataFrame:
    return rows.select("k", here.alias("p")).join(rows.select("k", here.alias("q")), "k").where("p.c < q.c")


def links(met: DataFrame, alike: Callable[[DataFrame], DataFrame], *, may: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None, rounds: int = 1) -> DataFrame:
    """Rows of alike that connect all alike nodes which share a bucket.

    met: (k, node: long, ...), written out; alike: from candidates (x, y), x < y and distinct, to those that are
    alike; may: a bound on two rows of a bucket which at least one row pair of alike nodes keeps.
    """
    here = F.struct(*(c for c in met.columns if c != "k"), "c")
    makers = [_to_hubs, *(lambda rows, here, r=r: _to_neighbours(rows, here, r) for r in range(rounds)), _to_all]
    found = None
    for make in makers:
        rows = _with_components(met, found)
        if found is not None and rows.isEmpty():
            break
        met = rows.drop("c")
        both = make(rows, here)
        if may is not None:
            both = both.where(may(lambda c: F.col(f"p.{c}"), lambda c: F.col(f"q.{c}")))
        new = checkpointed(alike(both.select(F.least("p.node", "q.node").alias("x"), F.greatest("p.node", "q.node").alias("y")).distinct()))
        found = new if found is None else found.union(new)
    return found
