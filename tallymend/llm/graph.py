"""Connected components of a graph given as an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymend.plans.durable import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); ``component`` is its smallest node.

    Large star and small star in turn: every node hands its larger neighbours,
    then its smaller ones, to its smallest neighbour, until all hang on one
    centre. Each step is a grouped minimum, reduced before the shuffle, and a
    join that may be split; no neighbourhood is gathered. The driver sees two
    numbers per round. Rounds grow with the logarithm of the longest path.
    """
    pairs = durable(
        edges.where("u <> v")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )
    seen = None
    while (state := _state(pairs)) != seen:
        seen = state
        pairs = durable(_small_star(_large_star(pairs)))
    # Now every edge leads from a centre to a node.
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    )


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    centre = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = both.where("v > u").join(centre, "u").select(F.col("m").alias("u"), "v")
    return out.where("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """``pairs`` has the smaller node first, so a node's smaller neighbours are its ``u``."""
    centre = pairs.groupBy("v").agg(F.min("u").alias("m"))
    moved = pairs.join(centre, "v").where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return moved.union(centre.select(F.col("m").alias("u"), "v")).distinct()


def local_forest(alike: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """Every linked node to the smallest node of its component within the two tiles."""
    label = {int(n): int(n) for n in (*a, *b)}
    rows, columns = np.nonzero(alike)
    mine, theirs = a.copy(), b.copy()
    while True:
        before = mine.sum() + theirs.sum()
        np.minimum.at(mine, rows, theirs[columns])
        np.minimum.at(theirs, columns, mine[rows])
        if mine.sum() + theirs.sum() == before:
            break
    for nodes, found in ((a, mine), (b, theirs)):
        for n, m in zip(nodes.tolist(), found.tolist(), strict=True):
            label[n] = min(label[n], m)
    return label
