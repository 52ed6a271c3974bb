"""Connected components of a table of links, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import written


def components(links: DataFrame) -> DataFrame:
    """From (a, b) long the table (node, component): the smallest node reachable. Nodes without links are absent.

    Each round is two joins with per-node minima, which are partially aggregated; the rounds are few (logarithmic), and each one's links
    are a written table. A hub's links are dealt out by adaptive skew handling, as they are rows of a plain equi-join.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("m_a")).agg(F.min("b").alias("m")).select("m_a", F.least("m", "m_a").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("m_a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy(F.col("a").alias("m_a")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("m_a"))
        small = small.select(F.col("b").alias("x"), F.col("m").alias("y")).filter("x <> y").unionByName(low.select(F.col("m_a").alias("x"), F.col("m").alias("y")))
        edges = written(small.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
        # Stars only, when no node is both a member and a centre: nothing changes any more.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same connections as links of each node to the smallest of its component; for links that fit in memory."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]
