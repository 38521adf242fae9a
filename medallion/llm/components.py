"""Connected components of an edge table, by alternating large and small stars.

A star step needs several shuffles however few edges there are. A table of at most LOCAL_EDGES edges, a
fixed bound of a few megabytes, is finished in one task instead, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow, stored

LOCAL_EDGES = 1 << 19


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, which: str) -> tuple[DataFrame, DataFrame]:
    """Each node's chosen neighbours tied to the least of the node and all neighbours; and that least node."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), "a").alias("m"))
    tied = edges.join(least, "a").where(which).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied, least


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges, and the least node of each one's component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        above, below = np.maximum(root[a], root[b]), np.minimum(root[a], root[b])
        apart = above != below
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, above[apart], below[apart])
        while (up := root[root]) is not None and (up != root).any():
            root = up
    return nodes, nodes[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("root", T.LongType())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)) for batch in batches]
        a, b = (np.concatenate([np.empty(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))
        node, root = roots_of(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], schema.names)

    return map_arrow(edges.select("a", "b").coalesce(1), merge, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the least node of its component.

    Edges may repeat, point either way or to the same node; no edges give no rows. Nodes are not null.
    Each step is one aggregation and one join on the node, written to the shared folder; a node with
    very many neighbours is split by the adaptive join.
    """
    found = Observation()
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(ordered.observe(found, *_mark()), "edges")
    mark = found.get
    if mark["n"] <= LOCAL_EDGES:
        return stored(_in_one_task(edges), "roots")
    while True:
        tied, _ = _stars(_both(edges), "b > a")
        large = stored(tied.where("a <> b"), "stars")
        tied, least = _stars(large, "true")
        marks = Observation()
        edges = tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stored(edges.observe(marks, *_mark()), "edges")
        if marks.get == mark:
            break
        mark = marks.get
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _mark() -> tuple:
    """What tells a table of edges from another."""
    return F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")
