"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def local_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) and each one's label (its component's smallest node)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
        far = label[i] != label[j]
        i, j = i[far], j[far]
    return nodes, nodes[label]


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node to its label: the same components with fewer links."""
    nodes, labels = local_labels(a, b)
    far = nodes != labels
    return nodes[far], labels[far]


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) links of longs -> (node, label): label is the smallest node reachable.

    Large-star and small-star steps alternate until nothing changes.  Each
    step is a grouped minimum (combined map-side, so a hub is no hot task)
    and a join whose hot keys Spark can split; lineage is cut after each
    round.  Nodes without a link to another node are not returned.
    """
    def both(e):
        return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    e = cut(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _signature(e)
    while before[0]:
        sides = both(e)
        low = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u meets u's smallest neighbour
        e = (sides.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u != v").distinct())
        # small star: the smaller neighbours of u, and u, meet the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        joined = e.join(low, "u")
        e = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(e)
        after = _signature(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct())
