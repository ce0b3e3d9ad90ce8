"""Connected components of a distributed edge list.

Alternating large-star and small-star steps; before them every partition
replaces its edges by the stars of its own components, which shortens long
chains at once.  Each step is a grouped minimum joined back, so a node with very
many edges is pre-aggregated and its rows can be split; tables are written
between steps, and nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import written


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, smallest node of its component) by union-find over one partition."""
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    stars = [(node, find(node)) for node in list(parent)]
    stars = [(node, root) for node, root in stars if node != root]
    for start in range(0, len(stars), 8_192):
        part = stars[start:start + 8_192]
        yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in part], pa.binary()),
                                          pa.array([s[1] for s in part], pa.binary())], names=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low"))
    return (both.join(lowest, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("low", "u").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    joined = edges.join(lowest, "u")
    return (joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(lowest.select("u", F.col("low").alias("v"))).filter("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (two binary columns): the
    smallest node reachable.  Without links the result is empty."""
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    edges = written(edges.mapInArrow(_local_stars, "u binary, v binary").distinct(), "components")
    seen = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            break
        seen = now
        edges = written(_small_star(_large_star(edges)), "components")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
