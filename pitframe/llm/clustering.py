"""Centroid clustering on exact integers, with a vantage-point tree over the centroids.

Every round builds the tree on the driver from the k centroids and sends it to the tasks with their code: its size is k x
components, whatever the table's. Each vector searches it best-first: it keeps a lower bound for every node, opens the node with
the lowest one, and stops when that bound lies above its best distance. The radius is inclusive, so a centroid at exactly the best
distance is still seen and the smaller number wins. A node's bounds are square roots in doubles, widened by more than their
rounding error; every distance that decides is an exact 64-bit integer.

A round is one pass: a task adds up its vectors by cluster and sends a row per cluster and component, so nothing that grows with the table is
shuffled or reaches the driver, and a cluster or vector value that holds a third of all rows is spread like any other rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
LEAF = 2
#: Integer components saturate here, so that a distance over COMPONENTS of them fits in 64 bits.
BOUND = 1 << 26
SLACK = 1e-9  # of the sizes involved; the rounding error of a square root is below 1e-15 of them

VECTORS = "vec_id bigint, v array<bigint>"
RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


@dataclass
class Node:
    """A leaf holds centroid numbers; an inner node a vantage centroid and, for each child, the range of its members' distances."""

    members: list[int]
    vantage: int | None = None
    children: tuple[int, ...] = ()
    ranges: tuple[tuple[float, float], ...] = ()


def squared(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = vectors - centre
    return np.einsum("ij,ij->i", d, d)


def build_tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes in an order that has parents before children; node 0 is the root.

    The vantage point is the member farthest from the node's first one; the others are cut at their median distance from it. Equal
    centroids can leave one side empty: such a node becomes a leaf.
    """
    nodes: list[Node] = []

    def grow(members: list[int]) -> int:
        at = len(nodes)
        nodes.append(Node(members))
        if len(members) <= leaf:
            return at
        own = centroids[members]
        vantage = members[int(np.argmax(squared(own, own[0])))]
        others = [m for m in members if m != vantage]
        distance = np.sqrt(squared(centroids[others], centroids[vantage]).astype(float))
        cut = np.median(distance)
        inner = [m for m, d in zip(others, distance) if d <= cut]
        outer = [m for m, d in zip(others, distance) if d > cut]
        if not outer:
            return at
        ranges = tuple((float(d.min()), float(d.max())) for d in (distance[distance <= cut], distance[distance > cut]))
        nodes[at] = Node([], vantage, (grow(inner), grow(outer)), ranges)
        return at

    grow(list(range(len(centroids))))
    return nodes


def nearest(vectors: np.ndarray, centroids: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (of equal ones the smallest number) and its squared distance."""
    n = len(vectors)
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, len(centroids))
    bounds = np.full((n, len(nodes)), np.inf)  # of nodes that are not open to a vector: infinite
    bounds[:, 0] = 0.0

    def see(rows: np.ndarray, c: int) -> np.ndarray:
        d = squared(vectors[rows], centroids[c])
        better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
        best[rows[better]], number[rows[better]] = d[better], c
        return d

    while n:
        chosen = bounds.argmin(axis=1)
        lowest = bounds[np.arange(n), chosen]
        reach = np.sqrt(best.astype(float))
        active = np.isfinite(lowest) & (lowest <= reach * (1 + SLACK))
        if not active.any():
            break
        for at in np.unique(chosen[active]):
            rows = np.flatnonzero(active & (chosen == at))
            node = nodes[at]
            bounds[rows, at] = np.inf
            if node.vantage is None:
                for c in node.members:
                    see(rows, c)
                continue
            d = np.sqrt(see(rows, node.vantage).astype(float))
            for child, (low, high) in zip(node.children, node.ranges):
                gap = np.maximum(d - high, low - d) - SLACK * (d + high)
                bounds[rows, child] = np.maximum(np.maximum(gap, 0.0), lowest[rows])
    return number, best


def kept_vectors(batch: pa.RecordBatch, components: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Identifiers and integer vectors of the rows with exactly ``components`` finite numbers."""
    column = batch.column("embedding")
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = column.filter(pa.array(lengths == components))
    numbers = right.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, components)  # a null number becomes NaN
    finite = np.isfinite(numbers).all(axis=1)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(numbers[finite] * scale), -BOUND, BOUND).astype(np.int64)
    return batch.column("vec_id").filter(pa.array(lengths == components)).filter(pa.array(finite)), whole


def _pieces(batches: Iterator[pa.RecordBatch], components: int, scale: int, rows: int = 4096) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            ids, vectors = kept_vectors(batch.slice(start, rows), components, scale)
            if len(ids):
                yield ids, vectors


def _vectors(components: int, scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in _pieces(batches, components, scale):
            ends = pa.array(np.arange(0, vectors.size + 1, components, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))], ["vec_id", "v"])

    return run


def seeds(vectors: DataFrame, clusters: int = CLUSTERS, components: int = COMPONENTS, scale: int = SCALE, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest digest of ``seed:vec_id``; of equal digests those with the smaller components come first."""
    rows = (vectors.mapInArrow(_vectors(components, scale), VECTORS).where("vec_id IS NOT NULL")
            .orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256), "v").limit(clusters).collect())
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, components)


def _totals(centroids: np.ndarray, components: int, scale: int) -> Callable:
    nodes = build_tree(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(centroids), components + 2), object)  # per cluster: component sums, distance, number; exact whole numbers
        for _, vectors in _pieces(batches, components, scale):
            number, distance = nearest(vectors, centroids, nodes)
            for c in np.unique(number).tolist():
                own = number == c
                totals[c, :components] += vectors[own].sum(axis=0)
                totals[c, components:] += (sum(distance[own].tolist()), int(own.sum()))
        some = np.flatnonzero(totals[:, -1]).tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(some, components + 2), pa.int32()), pa.array(list(range(components + 2)) * len(some), pa.int32()),
            pa.array([int(x) for c in some for x in totals[c]], pa.decimal128(38, 0))], ["cluster", "place", "total"])

    return run


def cluster_totals(vectors: DataFrame, centroids: np.ndarray, components: int = COMPONENTS, scale: int = SCALE) -> dict[int, list[int]]:
    """For each cluster with vectors: its componentwise sums, then its summed distance and number of vectors. A number for each of
    these reaches the driver, k x (components + 2) at most."""
    parts = vectors.mapInArrow(_totals(centroids, components, scale), "cluster int, place int, total decimal(38,0)")
    result: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
        result.setdefault(r["cluster"], [0] * (components + 2))[r["place"]] = int(r["total"])
    return result


def _assigned(centroids: np.ndarray, spreads: dict[int, int], components: int, scale: int) -> Callable:
    nodes = build_tree(centroids)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    most = np.iinfo(np.int64).max
    total = min(sum(spreads.values()), most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in _pieces(batches, components, scale):
            number, distance = nearest(vectors, centroids, nodes)
            of = number.tolist()
            yield pa.RecordBatch.from_arrays([
                ids.cast(pa.int64()), pa.array(number.astype(np.int32)), pa.array(distance), pa.array([min(spreads[c], most) for c in of], pa.int64()),
                pa.array([total] * len(of), pa.int64()), pa.array([digests[c] for c in of], pa.string())],
                ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return run


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A row whose embedding is null, has another length, or holds a null, NaN or infinite number is left out. A component beyond
    2**26 after scaling counts as 2**26, and sums of distances that 64 bits cannot hold are given as the largest number. Repeated
    rows are vectors each; of rows under one vec_id that are among the first, the one with smaller components comes first. A
    null vec_id is assigned but never a seed. With fewer kept vectors than clusters there are as many clusters as vectors; with
    none, or none that can be a seed, the result is empty. Columns other than vec_id and embedding are not read.
    """
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    centroids = seeds(vectors, clusters, components, scale, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], RESULT)
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (*sums, _, n) in cluster_totals(vectors, centroids, components, scale).items():
            moved[c] = [s // n for s in sums]
        centroids = moved
    spreads = {c: spread for c, (*_, spread, _) in cluster_totals(vectors, centroids, components, scale).items()}
    return vectors.mapInArrow(_assigned(centroids, spreads, components, scale), RESULT)


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same by brute force: every vector against every centroid, in long form (row, component)."""
    steps = [f"""kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {components}),
  x AS (SELECT r, unnest(v) AS x, unnest(range({components})) AS i FROM kept),
  c0 AS (SELECT k, unnest(v) AS c, unnest(range({components})) AS i FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR), v) - 1 AS k FROM kept WHERE vec_id IS NOT NULL) WHERE k < {clusters})"""]
    for t in range(rounds + 1):
        steps.append(f"""d{t} AS (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{t} USING (i) GROUP BY r, k),
  a{t} AS (SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS o FROM d{t}) WHERE o = 1)""")
        if t < rounds:
            steps.append(f"""s{t} AS (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{t} JOIN x USING (r) GROUP BY k, i),
  c{t + 1} AS (SELECT c.k, c.i, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c{t} c LEFT JOIN s{t} s ON s.k = c.k AND s.i = c.i)""")
    steps.append(f"h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)")
    return "WITH " + ",\n  ".join(steps) + f"""
SELECT vec_id, k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN h USING (k)"""
