"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``id``, ``component`` (the smallest id reachable) for each id of ``edges`` (``u``, ``v`` long).

    Every round is aggregates and equi-joins over the links, written to the shared folder; nothing but a count and a
    checksum reaches the driver. Self-links and repeated links are harmless, rows with a null end link nothing, an empty
    table gives an empty result.
    """
    links = written(_down(edges.filter("u <> v")), "links")
    seen = _signature(links)
    while seen[0]:
        links = written(_small_star(_large_star(links)), "links")
        now = _signature(links)
        if now == seen:
            break
        seen = now
    members = links.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return members.union(links.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


def _down(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select(F.col("hi").alias("a"), F.col("lo").alias("b")).union(links.select("lo", "hi"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node itself, is linked to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def merge_labels(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite i[k] with j[k] in a local label array, whose entries point at the smallest index of their set."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            further = parent[parent]
            if np.array_equal(further, parent):
                break
            parent[:] = further
