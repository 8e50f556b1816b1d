"""Connected components of a graph given as pairs, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_table, forget, kept

FEW = 1 << 19


def whole_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The answer for pairs that one task holds: roots are hooked to smaller ones and paths cut short until nothing changes."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    ends = np.concatenate([table.column("v").to_numpy(), table.column("u").to_numpy()])
    nodes, place = np.unique(ends, return_inverse=True)
    p, q = np.split(place, 2)
    root = np.arange(len(nodes))
    while len(p):
        low = np.minimum(root[p], root[q])
        np.minimum.at(root, root[p].copy(), low)
        np.minimum.at(root, root[q].copy(), low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[p] != root[q]
        p, q = p[apart], q[apart]
    schema = pa.schema([("node", pa.int64()), ("component", pa.int64())])
    if len(nodes):
        yield as_table({"node": nodes, "component": nodes[root]}, schema)


def smallest_reachable(pairs: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``pairs`` (columns ``a`` and ``b``, both long), the component being its smallest node.

    Each round ties the larger neighbours of a node to the smallest, then the smaller ones. Only nodes' minima are joined back, and both inputs of a
    join come from stored tables, so that a node with very many links can be split. The rounds end when the pairs form stars; a round's tables are
    deleted when the next one's pairs are written. Up to ``FEW`` pairs (8 MB) are left to one task, which spares the rounds.
    """
    spark = pairs.sparkSession
    edges, path = kept(pairs.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    state = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now[0] <= FEW:
            return edges.coalesce(1).mapInArrow(whole_components, "node long, component long")
        if now == state:
            break
        state, done = now, [path]
        both, path = kept(edges.select("v", "u").unionAll(edges.select(F.col("u").alias("v"), F.col("v").alias("u"))), "both")
        done.append(path)
        least, path = kept(both.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m0")).select("n", F.least("n", "m0").alias("m")), "least")
        done.append(path)
        large = both.join(least, F.col("v") == F.col("n")).filter((F.col("u") > F.col("v")) & (F.col("u") != F.col("m"))).select(F.col("u").alias("v"), F.col("m").alias("u"))
        downward, path = kept(large.unionAll(least.filter(F.col("n") != F.col("m")).select(F.col("n").alias("v"), F.col("m").alias("u"))).distinct(), "large")
        done.append(path)
        least, path = kept(downward.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m")), "least")
        done.append(path)
        small = downward.join(least, F.col("v") == F.col("n")).filter(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges, path = kept(small.unionAll(least.select(F.col("n").alias("v"), F.col("m").alias("u"))).distinct(), "edges")
        for old in done:
            forget(spark, old)
    down = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return down.unionAll(down.select(F.col("component").alias("node"), "component").distinct())
