"""Connected components over edge tables, and spanning forests inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, shared_path


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of the edges (a, b) as a star each: every node but the smallest, and that smallest node."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for end in (x, y):
            np.minimum.at(new, root[end], low)
            np.minimum.at(new, end, low)
        while True:
            hop = new[new]
            if (hop == new).all():
                break
            new = hop
        if (new == root).all():
            break
        root = new
    rest = root != np.arange(len(nodes))
    return nodes[rest], nodes[root[rest]]


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the edges (a, b), as few as connect what all of them connect."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label, kept = np.arange(len(nodes)), []
    while len(live := np.flatnonzero(label[x] != label[y])):
        end = np.concatenate([label[x[live]], label[y[live]]])
        _, first = np.unique(end, return_index=True)  # the first edge that leaves each component
        kept.append(np.unique(np.concatenate([live, live])[first]))
        low, root = forest(label[x[kept[-1]]], label[y[kept[-1]]])
        now = np.arange(len(nodes))
        now[low] = root
        label = now[label]
    pick = np.concatenate(kept) if kept else np.zeros(0, int)
    return a[pick], b[pick]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, long) that is not the smallest of its component.

    Alternating large-star and small-star steps: each is an aggregate with map-side combine and an
    equi-join that adaptive execution may split, so a node with very many links is no single task.
    Every round is written to the shared folder, which cuts lineage. Null ends and self links are ignored.
    """
    spark = edges.sparkSession
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    before, old = None, None
    while True:
        both = now.union(now.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        path = shared_path(spark, "stars")
        low.select("hi", F.col("m").alias("lo")).union(small).distinct().write.parquet(path)
        now = spark.read.schema("hi long, lo long").parquet(path)
        state = now.agg(F.count("*"), F.expr("sum(cast(xxhash64(hi, lo) as decimal(20, 0)))")).first()
        if old:
            remove(spark, old)
        if state == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before, old = state, path
