"""Centroid clustering with bounds that geometry keeps tight (Rysavy and Hamerly, 2016).

Vectors hold floor(scale * x) of their components; centroids are whole numbers too, so distances are exact and ties
go to the smaller number.  Each vector keeps an upper bound on the distance to its centroid and a lower bound on that
to all others.  When the centroids have moved, the upper bound grows by its own centroid's drift.  The lower bound is
loosened by what any vector inside its cluster's sphere can have come closer to any other centroid, which is less
than the drift: the points that come closer by at least p * cos(a), p being the drift, lie inside the branch of a hyperbola whose foci are
the old and the new centroid, hence inside the cone of angle a at their midpoint.  The plane through that axis and the
sphere's centre shows which angle the sphere reaches.  A vector whose bounds still tell its centroid is left; of the
rest the own distance is taken, and what stays ambiguous is scanned against all centroids.

State is a stored table, written anew in each round and read by the next.  Tasks add up what has moved, per cluster and
component, and only those sums reach the driver: ``k`` times the number of components.  No vector is shuffled.

Rows with a null vector, another number of components, or a null or non-finite component are left out.  A row without
``vec_id`` is kept, and comes last among the starting centroids.  Repeated rows count each.  Components of more than
2 ** 27 after scaling count as that.  With fewer vectors than ``k`` there are as many clusters; without any, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.vectors import listed, matrix, products, scaled
from tillhouse.session import discard, materialise

SIZE = 64
K = 16
SCALE = 64
ROUNDS = 3
LIMIT = 1 << 27
#: Bounds are kept in floating point; two are told apart only beyond this share of them.
SLACK = 1e-9
#: Distances a task holds at once.
CELLS = 4_000_000

STATE = "vec_id long, vector array<int>, cluster int, was int, distance long, upper double, lower double, scans int"
SUMS = "cluster int, at int, total long, radius double"


def whole_vectors(table: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: the vectors that take part, as whole numbers."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, rows = scaled(batch.column("embedding"), size, scale, LIMIT)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(right)), listed(rows)], ["vec_id", "vector"])

    return table.select(table["vec_id"].cast("long").alias("vec_id"), table["embedding"].alias("embedding")).mapInArrow(kept, "vec_id long, vector array<int>")


def starting_centroids(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of ``1:<vec_id>``."""
    order = [F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), F.col("vector")]
    rows = vectors.orderBy(*order).limit(k).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    return (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * products(x, centroids)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid, its squared distance, and the distance of the next one."""
    k = len(centroids)
    nearest, first, second = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    step = max(1, CELLS // k)
    for lo in range(0, len(x), step):
        d = squared(x[lo:lo + step], centroids)
        rows, best = np.arange(len(d)), d.argmin(axis=1)
        nearest[lo:lo + step], first[lo:lo + step] = best, d[rows, best]
        if k > 1:
            d[rows, best] = np.iinfo(np.int64).max
            second[lo:lo + step] = np.sqrt(d.min(axis=1).astype(np.float64))
    return nearest, first, second


@dataclass
class Move:
    """What a step of the centroids does to the bounds of each cluster's vectors."""

    centroids: np.ndarray
    drift: np.ndarray
    loosened: np.ndarray


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much, at most, a vector of the sphere of cluster i (row) comes closer to centroid j (column)."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    axis, middle = b - a, (a + b) / 2
    drift = np.sqrt((axis * axis).sum(axis=1))
    to = a[:, None, :] - middle[None, :, :]
    reach = np.sqrt((to * to).sum(axis=2))
    away = reach > radius[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        centre = np.arccos(np.clip((to * axis[None, :, :]).sum(axis=2) / (reach * drift[None, :]), -1, 1))
        spread = np.arcsin(np.clip(radius[:, None] / reach, 0, 1))
    angle = np.where(away, np.maximum(centre - spread, 0), 0)
    closer = np.where(drift[None, :] > 0, drift[None, :] * np.cos(np.minimum(angle, np.pi / 2)), 0)
    return np.maximum(closer, 0)


def moved(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Move:
    """The bounds' changes, each a little wider than computed."""
    closer = loosening(old, new, radius)
    np.fill_diagonal(closer, 0)
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1))
    wider = lambda d: np.where(d > 0, d * (1 + SLACK) + SLACK * (1 + radius.max(initial=0)), 0)
    return Move(new, wider(drift), wider(closer.max(axis=1, initial=0)))


def packed(ids: pa.Array, x, cluster, was, distance, upper, lower, scans) -> pa.RecordBatch:
    columns = [ids, listed(x), pa.array(cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(distance, pa.int64()),
               pa.array(upper, pa.float64()), pa.array(lower, pa.float64()), pa.array(scans, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in STATE.split(", ")])


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The first state: every vector scanned."""
    sent, size = vectors.sparkSession.sparkContext.broadcast(centroids), centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), size)
            nearest, first, second = scan(x, sent.value)
            n = len(x)
            yield packed(batch.column("vec_id"), x, nearest, np.full(n, -1), first, np.sqrt(first.astype(np.float64)), second, np.ones(n))

    return vectors.mapInArrow(assign, STATE)


def reassigned(state: DataFrame, move: Move, last: bool = False) -> DataFrame:
    """The state after the centroids have moved; only vectors whose bounds don't tell are scanned.  ``last`` gives all distances."""
    sent, size = state.sparkSession.sparkContext.broadcast(move), move.centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        move = sent.value
        for batch in batches:
            x = matrix(batch.column("vector"), size)
            was, scans = np.asarray(batch.column("cluster")), np.array(batch.column("scans"))
            upper = np.asarray(batch.column("upper")) + move.drift[was]
            lower = np.maximum(np.asarray(batch.column("lower")) - move.loosened[was], 0)
            told = lambda u, l: u * (1 + SLACK) + SLACK < l
            own = np.arange(len(x)) if last else np.flatnonzero(~told(upper, lower))
            apart = x[own] - move.centroids[was[own]]
            distance = np.array(batch.column("distance"))
            distance[own] = (apart * apart).sum(axis=1)
            upper[own] = np.sqrt(distance[own].astype(np.float64))
            open_ = own[~told(upper[own], lower[own])]
            cluster = was.copy()
            if len(open_):
                nearest, first, second = scan(x[open_], move.centroids)
                cluster[open_], distance[open_], upper[open_], lower[open_] = nearest, first, np.sqrt(first.astype(np.float64)), second
                scans[open_] += 1
            yield packed(batch.column("vec_id"), x, cluster, was, distance, upper, lower, scans)

    return state.mapInArrow(assign, STATE)


def changes(state: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What vectors that changed their cluster add to each component's sum and to the counts, and each sphere's radius."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, radius = np.zeros((k, size + 1), np.int64), np.zeros(k)
        for batch in batches:
            cluster, was = np.asarray(batch.column("cluster")), np.asarray(batch.column("was"))
            np.maximum.at(radius, cluster, np.asarray(batch.column("upper")))
            at = np.flatnonzero(cluster != was)
            x = matrix(batch.column("vector").take(pa.array(at)), size)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)  # the last counts
            np.add.at(total, cluster[at], x)
            left = was[at] >= 0
            np.subtract.at(total, was[at][left], x[left])
        cells = np.argwhere((total != 0) | ((radius > 0)[:, None] & (np.arange(size + 1) == size)))
        yield pa.RecordBatch.from_arrays([
            pa.array(cells[:, 0], pa.int32()), pa.array(cells[:, 1], pa.int32()), pa.array(total[cells[:, 0], cells[:, 1]], pa.int64()),
            pa.array(radius[cells[:, 0]], pa.float64()),
        ], ["cluster", "at", "total", "radius"])

    parts = state.select("vector", "cluster", "was", "upper").mapInArrow(add, SUMS)
    rows = parts.groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("radius").alias("radius")).collect()
    sums, counts, radius = np.zeros((k, size), object), np.zeros(k, object), np.zeros(k)
    for r in rows:  # k * (size + 1) at most
        if r["at"] == size:
            counts[r["cluster"]] = int(r["total"])
        else:
            sums[r["cluster"], r["at"]] = int(r["total"])
        radius[r["cluster"]] = max(radius[r["cluster"]], r["radius"])
    return sums, counts, radius


@dataclass
class Clustering:
    """The last state (``vec_id, vector, cluster, distance, scans`` and the bounds) and the final centroids."""

    rows: DataFrame
    centroids: np.ndarray


def clustered(table: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> Clustering:
    """``rounds`` of assigning and moving the centroids to floor(sum / count), then a last assignment."""
    vectors = whole_vectors(table, size, scale)
    centroids = starting_centroids(vectors, k)
    if not len(centroids):
        return Clustering(table.sparkSession.createDataFrame([], STATE), centroids)
    k = len(centroids)
    state = materialise(assigned(vectors, centroids), "clusters")
    sums, counts = np.zeros((k, size), object), np.zeros(k, object)
    for n in range(rounds):
        more, members, radius = changes(state, k, size)
        sums, counts = sums + more, counts + members
        new = np.array([[int(s) // int(m) for s in row] if m else list(old) for row, m, old in zip(sums, counts, centroids)], np.int64)
        move = moved(centroids, new, radius)
        before, state, centroids = state, materialise(reassigned(state, move, n == rounds - 1), "clusters"), new
        discard(before)
    return Clustering(state, centroids)


def cluster_report(table: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    found = clustered(table, k, rounds, size, scale)
    spread = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()  # k rows
    total = sum(int(r["n"]) for r in spread)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    stats = table.sparkSession.createDataFrame(
        [(r["cluster"], int(r["n"]), total, digest[r["cluster"]]) for r in spread], "of int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # A row per cluster: k at most.
    return found.rows.join(F.broadcast(stats), F.col("cluster") == F.col("of")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    )
