"""Connected components of a link table, wholly in DataFrames."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches

LOCAL_LINKS = 1 << 20


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _in_one_task(edges: DataFrame) -> DataFrame:
    """node, component of a link table of at most ``LOCAL_LINKS`` rows: the
    smallest labels run along the links, by pointer jumping."""
    def run(batches):
        import pyarrow as pa

        columns = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not columns:
            return
        u, v = (np.concatenate(c) for c in zip(*columns, strict=True))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = at[:len(u)], at[len(u):]
        low = np.arange(len(nodes))
        while (low[a] != low[b]).any():
            x, y = low[a], low[b]
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while (low[low] != low).any():
                low = low[low]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[low])], ["node", "component"])

    return map_batches(edges.select("u", "v").coalesce(1), run, "node long, component long")


def connected_components(links: DataFrame, a: str = "a", b: str = "b", name: str = "components",
                         local_links: int = LOCAL_LINKS) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links``.

    Alternating large-star and small-star rounds: every node keeps pointing at
    a smaller one until all point at their smallest, in a number of rounds that
    grows with the logarithm of the longest chain.  Each round is cut, and the
    driver sees only a row count and a checksum of it.  A table of at most
    ``local_links`` distinct links (16 MB) is finished by one task instead, whose
    memory that number bounds; the result is the same.
    """
    edges = cut(links.filter(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name)
    last = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or state[0] == 0:
            break
        if state[0] <= local_links:
            return _in_one_task(edges)
        last = state
        edges = cut(_small_star(_large_star(edges)), name)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
