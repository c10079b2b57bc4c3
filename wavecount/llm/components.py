"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import look_up
from wavecount.session import materialise, scratch

#: Links that a task joins at once.
LINKS = 500_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links that is not the least of its component, and that least node."""
    nodes, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not (root[root] == root).all():
            root = root[root]
    leaves = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[leaves], nodes[root[leaves]]


def forests(links: DataFrame, links_at_once: int = LINKS) -> DataFrame:
    """Fewer links (u, v) between the same components: each task joins what it reads; u is greater than v."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(np.concatenate(u), np.concatenate(v))], names=["u", "v"])

        for part in batches:
            u.append(part["u"].to_numpy(zero_copy_only=False))
            v.append(part["v"].to_numpy(zero_copy_only=False))
            held += part.num_rows
            if held >= links_at_once:
                yield batch()
                u, v, held = [], [], 0
        if held:
            yield batch()

    return links.select("u", "v").mapInArrow(joined, "u long, v long")


def in_tasks(rows: DataFrame, n: int) -> DataFrame:
    """About ``n`` short rows in tasks of as many as one joins at once; more tasks only where there are as many cores."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LINKS)))


def _towards_least(pairs: DataFrame, n: int) -> DataFrame:
    """Columns u, v and the least of u and all its v; minima are combined before the shuffle, and a hub's pairs stay where they are."""
    least = materialise(in_tasks(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), n), "least")
    return in_tasks(look_up(pairs, least, "u", "n").withColumn("m", F.least("u", "m")), n)


def _state(edges: DataFrame, n: int) -> tuple[int, bool]:
    """How many links there are, and whether they are stars: each u has one v, which is no u."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("hub")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("hub")))))
    nodes = in_tasks(ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("hub").alias("hub")), n)
    links, far = nodes.agg(F.sum("leaf"), F.max((F.col("leaf") + F.col("hub") > 1) & (F.col("leaf") > 0))).first()
    return links or 0, not far


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node that a link (u, v) touches.

    Tasks join what they read before anything moves. Large-star and small-star steps in
    turn then make stars of all components within a few rounds, logarithmic in their
    size; each round is written to the shared folder.
    """
    spark = links.sparkSession
    with scratch(spark):
        links = materialise(links.select("u", "v"), "links")  # whatever makes them has done with its Python workers
        n = links.count()
        edges = materialise(in_tasks(forests(in_tasks(links, n)).distinct(), n), "links")
        while True:
            n, are_stars = _state(edges, n)
            if are_stars:
                hubs = in_tasks(edges.select("v", "v").distinct(), n)
                stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(hubs)
                return materialise(stars, "components", keep=True)
            both = edges.union(edges.select("v", "u"))
            large = _towards_least(both, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            large = materialise(in_tasks(large, 2 * n), "large")
            small = _towards_least(large, 2 * n)
            stars = small.select("v", "m").union(small.select("u", "m")).toDF("u", "v").where("u <> v")
            edges = materialise(in_tasks(forests(in_tasks(stars, 2 * n)).distinct(), 2 * n), "links")
