"""Connected components of a table of links, by rounds of contraction.

In each round every node points to the first of its neighbours and itself, and the links are rewritten to those parents. Links
inside a tree vanish. For two rounds the smallest comes first: any star, however large, is gone after them. Then the order is drawn anew
for each round by hashing, so that of a chain, in whatever order its ids run, about half the nodes remain each time.
Minima are pre-aggregated before the
shuffle, and rewriting is a join of two written tables, whose skewed partitions adaptive execution can split. Nothing is
collected, and every round's tables lie in the shared checkpoint folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.sources import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``a``, ``b``, one type); component is its smallest node.

    Links with a null end or from a node to itself join nothing. An empty table gives an empty table.
    """
    pairs = links.select("a", "b").where("a <> b")
    edges = materialize(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    found = edges.select(F.col("a").alias("node"), F.col("a").alias("at")).distinct()
    turn = 0
    while not edges.isEmpty():
        turn += 1

        def drawn(c: str, turn: int = turn) -> Column:
            order = F.xxhash64(c, F.lit(turn)) if turn > 2 else F.lit(0).cast("long")
            return F.struct(order.alias("h"), F.col(c).alias("node"))

        first = edges.groupBy("a").agg(F.min(drawn("b")).alias("m"))
        parents = materialize(first.select(F.col("a").alias("node"), F.least(drawn("a"), F.col("m"))["node"].alias("parent")), "parents")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = materialize(moved.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
        step = parents.select(F.col("node").alias("at"), "parent")
        found = found.join(step, "at", "left").select("node", F.coalesce("parent", "at").alias("at"))
        if turn % 4 == 0:  # a plan of bounded depth
            found = materialize(found, "found")
    found = materialize(found, "found")
    smallest = found.groupBy("at").agg(F.min("node").alias("component"))
    return found.join(smallest, "at").select("node", "component")


def local_roots(near: np.ndarray, one: bool) -> tuple[np.ndarray, np.ndarray]:
    """Roots of the rows and of the columns of one block: each is the smallest row index it is connected to.

    ``near`` says which row is linked with which column. With ``one`` rows and columns are the same things;
    else a column without a link has the root ``len(near)`` or more.
    """
    far = np.iinfo(np.int32).max
    mine = np.arange(near.shape[0], dtype=np.int32)
    theirs = mine if one else np.full(near.shape[1], far, dtype=np.int32)
    while True:
        down = np.minimum(theirs, np.where(near, mine[:, None], far).min(axis=0, initial=far))
        up = np.minimum(mine, np.where(near, down[None, :], far).min(axis=1, initial=far))
        if np.array_equal(up, mine) and np.array_equal(down, theirs):
            return mine, theirs
        mine, theirs = up, (up if one else down)
