"""Connected components by alternating large and small stars on DataFrames; few edges are put together in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import lean
from ..store import forget, written

#: So many edges (16 bytes each) are put together in one task: rounds of shuffles cost more than the work, whatever the partitions.
FEW_EDGES = 1 << 18


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges -> (nodes, the least node reachable from each)."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(u):
        # every root goes below the least root next to it, then all nodes below their roots
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(up := root[root], root):
            root = up
        u, v = root[u], root[v]
        u, v = u[u != v], v[u != v]
    return nodes, nodes[root]


def _all_at_once(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edges = [[c.to_numpy() for c in part.columns] for part in rows]
    if edges:
        node, root = roots(*(np.concatenate(x) for x in zip(*edges, strict=True)))
        below = node != root
        yield pa.RecordBatch.from_arrays([pa.array(node[below]), pa.array(root[below])], names=["node", "root"])


def _least(edges: DataFrame) -> DataFrame:
    """For each node u the least of itself and its v; partial sums first, so a hub is no single task."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each a has one b and no b is an a: then the b are the roots."""
    a = edges.groupBy(F.col("a").alias("x")).agg(F.count(F.lit(1)).alias("as_a"), F.lit(0).alias("as_b"))
    b = edges.select(F.col("b").alias("x"), F.lit(0).cast("long").alias("as_a"), F.lit(1).alias("as_b")).distinct()
    nodes = a.unionAll(b).groupBy("x").agg(F.sum("as_a").alias("as_a"), F.max("as_b").alias("as_b"))
    return nodes.where("as_a > 1 or as_a = 1 and as_b = 1").limit(1).count() == 0


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """edges (a, b), any order, loops and repeats allowed -> (node, root): root is the least node reachable.

    Only nodes that occur in an edge between two nodes are returned. A round is
    two aggregations and joins by node; hubs are joined, never grouped. Each round's
    edges and least neighbours are written tables: adaptive execution splits a hub only
    where both sides of its join come straight from an exchange, not from an aggregation.
    At most FEW_EDGES edges take no rounds.
    """
    given = written(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")), name)
    if given.count() <= FEW_EDGES:
        out = written(given.coalesce(1).mapInArrow(lean(_all_at_once), "node long, root long"), name)
        forget(given)
        return out
    now = written(given.distinct(), name)
    forget(given)
    while not _is_forest_of_stars(now):
        both = now.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
        least = written(_least(both), name)
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        again = written(_least(large), name)
        small = large.join(again, "u").select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
        then = written(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        forget(now, least, large, again)
        now = then
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
