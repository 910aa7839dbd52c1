"""Connected components of a graph given as links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodplan.session import settle

MAX_ROUNDS = 60


def forest(
    a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all that the pairs (a[i], b[j]) join, at most one for each node."""
    both = np.concatenate([a, b])
    nodes, place = np.unique(both, return_inverse=True)
    i, j = place[i], place[len(a) + j]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = label != np.arange(len(nodes))
    return nodes[member], nodes[label[member]]


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), both long.

    component is the smallest node reachable. Large and small stars alternate until each
    component is one star; the rounds grow with the logarithm of its size. Only minima by
    node are aggregated, so a node with many links is never gathered, and every round is a
    table in the shared folder. Null ends and loops link nothing.
    """
    edges = settle(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        now = _digest(edges)
        if now == before or not now[0]:
            break
        before = now
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
        large = both.filter("v > u").join(lowest, "u").select("v", "low").toDF("a", "b")
        large = settle(large.distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .filter("b <> low")
            .select("b", "low")
            .union(low.select("a", "low"))
            .toDF("a", "b")
        )
        edges = settle(small.distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("b", "b").distinct()
    return edges.union(roots).toDF("node", "component")
