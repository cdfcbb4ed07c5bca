"""Connected components of a link table, and the folding of links within one batch."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell.sources.shared import stored


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component among nodes 0 to n - 1, for links in memory."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _toward_least(links: DataFrame, larger_only: bool) -> DataFrame:
    """One star step.  Each node's neighbours are linked to the least node about it: the larger
    neighbours (``larger_only``), or, from links to smaller nodes, all of them and the node itself."""
    if larger_only:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        out = links.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b of one orderable type): the smallest node
    reachable.  Alternates large-star and small-star steps until nothing changes, each step written
    to the shared folder, so a lost executor costs one step.  A node with many links is combined
    before its shuffle and split by adaptive execution.  Null ends and self-links are ignored."""
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = stored(pairs, "links")
    while True:
        large = _toward_least(state, True)
        small = stored(_toward_least(large, False), "links")
        # A forest of stars: no node is both a root and a member, and no member has two roots.
        many = small.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        chained = small.select(F.col("b").alias("a")).join(small.select("a"), "a", "left_semi").limit(1)
        state = small
        if not many.unionByName(chained.select("a", F.lit(0).cast("long").alias("n"))).limit(1).count():
            break
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
