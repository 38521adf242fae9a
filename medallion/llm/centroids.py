"""Clusters around centroids, each vector finding its centroid through a vantage-point tree.

Vectors become integers, so distances, sums and ties are exact and no result depends on the order of
rows. Every round builds a vantage-point tree over the centroids and broadcasts it: its size is the
number of centroids times the width, both parameters. A vector descends best-first: the open node with
the least bound comes next, and a node is left only if its bound lies beyond the best distance so far;
bounds equal to it are still searched, as a smaller number may wait there. Leaves hold exact integer
distances. Tasks add their vectors up per centroid, so what is shuffled in a round is one row per
task, centroid and component, however many vectors share a place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.frames import map_arrow, stored

#: Centroids of a leaf, and vectors searched together.
LEAF = 4
BATCH = 8192
#: A distance is a long: components beyond this count as it.
GREATEST = 1 << 27
#: Bounds are compared with this slack, far above the rounding of square roots.
SLACK = 1e-9


@dataclass(frozen=True)
class Rule:
    """``clusters`` centroids of ``width`` components, moved ``rounds`` times; components times ``scale``."""

    width: int = 64
    clusters: int = 40
    rounds: int = 5
    scale: int = 256
    #: The first centroids are the vectors with the least hashes of this text and their id.
    prefix: str = "2:"


@dataclass
class _Node:
    """A vantage point with its nearer and farther child, or a leaf; numbers index the centroids."""

    points: np.ndarray
    children: tuple[int, int] | None = None
    #: Least and greatest distance from the vantage point to a child's centroids.
    reach: tuple[tuple[float, float], tuple[float, float]] | None = None


@dataclass
class VantageTree:
    """Nodes over centroids (number x width, int64); the root is node 0."""

    centroids: np.ndarray
    nodes: list[_Node] = field(default_factory=list)

    def __post_init__(self) -> None:
        if len(self.centroids):
            self._grow(np.arange(len(self.centroids)))

    def _grow(self, points: np.ndarray) -> int:
        place = len(self.nodes)
        self.nodes.append(_Node(points))
        if len(points) <= LEAF:
            return place
        among = _squares(self.centroids[points], self.centroids[points])
        # The vantage point whose distances spread most tells its near and far centroids apart best.
        away = np.sqrt(among.astype(np.float64))
        chosen = int(away.std(axis=1).argmax())
        order = np.argsort(among[chosen], kind="stable")
        order = order[order != chosen]
        near, far = order[: len(order) // 2], order[len(order) // 2 :]
        reach = tuple((float(away[chosen, part].min()), float(away[chosen, part].max())) for part in (near, far))
        children = (self._grow(points[near]), self._grow(points[far]))
        self.nodes[place] = _Node(points[chosen : chosen + 1], children, reach)
        return place

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each vector; the smaller number of equals."""
        rows = len(vectors)
        cluster, best = np.full(rows, len(self.centroids)), np.full(rows, np.iinfo(np.int64).max)
        bound = np.full((rows, len(self.nodes)), np.inf)
        bound[:, 0] = 0
        active = np.arange(rows)
        while len(active):
            chosen = bound[active].argmin(axis=1)
            for place in np.unique(chosen).tolist():
                here = active[chosen == place]
                self._visit(self.nodes[place], vectors, here, cluster, best, bound)
                bound[here, place] = np.inf
            limit = np.sqrt(best[active].astype(np.float64)) * (1 + SLACK) + SLACK
            active = active[bound[active].min(axis=1) <= limit]
        return cluster, best

    def _visit(self, node: _Node, vectors: np.ndarray, here: np.ndarray, cluster: np.ndarray, best: np.ndarray, bound: np.ndarray) -> None:
        found = _squares(vectors[here], self.centroids[node.points])
        numbers = np.broadcast_to(node.points, found.shape)
        least = found.min(axis=1)
        number = np.where(found == least[:, None], numbers, len(self.centroids)).min(axis=1)
        better = (least < best[here]) | ((least == best[here]) & (number < cluster[here]))
        best[here[better]], cluster[here[better]] = least[better], number[better]
        if node.children is None:
            return
        away = np.sqrt(found[:, 0].astype(np.float64))
        for child, (low, high) in zip(node.children, node.reach, strict=True):
            bound[here, child] = np.maximum(np.maximum(low - away, away - high), 0)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to those of ``b``."""
    out = np.empty((len(a), len(b)), np.int64)
    for k, other in enumerate(b):
        apart = a - other
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return out


def usable(embedding: str, width: int) -> Column:
    """Whether a vector has ``width`` components, none of them null or non-finite; false for a null vector."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(embedding) == width) & finite, F.lit(False))


def integers(embeddings: DataFrame, rule: Rule) -> DataFrame:
    """vec_id and the whole-number components ``v`` of the usable vectors of embeddings (vec_id, embedding)."""

    def whole(x: Column) -> Column:
        # floor of a double is a long, and would overflow beyond its range.
        at_most = F.least(F.greatest(x.cast("double") * rule.scale, F.lit(-float(GREATEST))), F.lit(float(GREATEST)))
        return F.floor(at_most).cast("int")

    kept = embeddings.select("vec_id", "embedding").where(usable("embedding", rule.width))
    return kept.select("vec_id", F.transform("embedding", whole).alias("v"))


def first_centroids(vectors: DataFrame, rule: Rule) -> np.ndarray:
    """The vectors that start as centroids, at most ``rule.clusters`` rows; equal ids by their components."""
    named = F.concat(F.lit(rule.prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    ranked = vectors.select(F.sha2(named.cast("binary"), 256).alias("hash"), "v").orderBy("hash", "v")
    rows = [row["v"] for row in ranked.limit(rule.clusters).collect()]
    return np.array(rows, np.int64).reshape(len(rows), rule.width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of the vectors nearest to each centroid; at most one entry per centroid."""
    clusters, width = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("k", T.IntegerType()), T.StructField("total", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last column counts.
        totals = np.zeros((clusters, width + 1), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                v = _matrix(batch.column(0).slice(low, BATCH), width)
                cluster, _ = shared.value.nearest(v)
                for c in np.unique(cluster).tolist():
                    mine = v[cluster == c]
                    totals[c, :width] += mine.sum(axis=0)
                    totals[c, width] += len(mine)
        at = np.flatnonzero(totals[:, width])
        columns = (np.repeat(at, width + 1), np.tile(np.arange(width + 1), len(at)), totals[at].ravel())
        arrays = [pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema.names)

    summed = map_arrow(vectors.select("v"), add, schema).groupBy("cluster", "k")
    found: dict[int, list[int]] = {}
    for row in summed.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found.setdefault(row["cluster"], [0] * (width + 1))[row["k"]] = int(row["total"])
    shared.unpersist()
    return {c: (row[width], row[:width]) for c, row in found.items()}


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Centroids at the floor of their vectors' mean; those without vectors stay."""
    out = centroids.copy()
    for c, (count, total) in sums.items():
        out[c] = [t // count for t in total]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of each row of vectors (vec_id, v)."""
    width = centroids.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                cluster, distance = shared.value.nearest(_matrix(part.column(1), width))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], schema.names)

    return map_arrow(vectors.select("vec_id", "v"), place, schema)


def fit(vectors: DataFrame, rule: Rule) -> np.ndarray:
    """The centroids after all rounds, from stored vectors (vec_id, v)."""
    centroids = first_centroids(vectors, rule)
    if len(centroids):
        for _ in range(rule.rounds):
            centroids = moved(centroids, _sums(vectors, centroids))
    return centroids


def clusters(embeddings: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each usable row of embeddings.

    Rows that are null, have another width, or a null or non-finite component are left out; so are all
    other columns. Repeated rows count as often as they stand. Of fewer vectors than clusters, each is a
    first centroid. No vectors give no rows. A null vec_id is hashed as an empty one. A component beyond
    2^27 counts as 2^27, so that every distance is an exact long; a sum of distances beyond a long is null.
    """
    vectors = stored(integers(embeddings, rule), "vectors")
    centroids = fit(vectors, rule)
    placed = stored(assign(vectors, centroids), "placed")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    hashed = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    rows = [(c, [int(x) for x in centroid]) for c, centroid in enumerate(centroids)]
    named = embeddings.sparkSession.createDataFrame(rows, "cluster int, centroid array<bigint>")
    sums = placed.groupBy("cluster").agg(total.alias("total"))
    # At most one row per centroid on the right side.
    sums = sums.join(F.broadcast(named.select("cluster", hashed.alias("centroid_sha256"))), "cluster")
    whole = placed.agg(total.try_cast("bigint").alias("inertia")).scalar()
    return placed.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", F.col("total").try_cast("bigint").alias("cluster_inertia"),
        whole.alias("inertia"), "centroid_sha256",
    )
