"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import work_dir

MAX_ROUNDS = 100


def star_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of some edges, in one task: each node but the smallest of its
    component with that smallest one. At most one edge a node, however many came in."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its
    component. ``edges``: two long columns; order, repeats and loops don't matter.

    Alternates large-star and small-star steps until nothing changes, a number
    of rounds that is logarithmic in practice. A hub's neighbours meet only as
    partial minima and in a join that AQE can split, so no task gathers them.
    Each round is cut off by a checkpoint in the cluster's shared folder.
    """
    work_dir(edges.sparkSession)
    a, b = (F.col(c) for c in edges.columns)
    stars = (edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .distinct().checkpoint())
    state = _state(stars)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = (large.join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).distinct().checkpoint())
        before, state = state, _state(stars)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = stars.select(F.col("v").alias("node")).distinct()
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select("node", F.col("node").alias("root"))))


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
