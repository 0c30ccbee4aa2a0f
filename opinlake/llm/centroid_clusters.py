"""Centroid clustering in integers, the nearest centroid found by equal-average equal-variance search.

A vector component x becomes the integer floor(`SCALE` * x). Centroids are kept in the order of
their component sums. For a vector the search starts at the centroid whose sum is nearest and goes
outward. With k components, sums S and T of vector and centroid, and R the root of k * (sum of
squares) - S * S (the deviation, times k),

    k * distance >= (S - T)^2                       the mean inequality
    k * distance >= (S - T)^2 + (R - R')^2          mean and deviation

where distance is the squared Euclidean one. The first ends the search, as all centroids further out
have sums that are further off; the second skips a centroid. What is left is compared by its exact
integer distance. A centroid is skipped only where its bound is above the best distance by more than
the rounding of the roots, so ties and results are those of comparing all.

A round is one pass over the vectors with nothing shuffled but sums: each task adds up its vectors by
cluster, and one row for each task and cluster goes on. Sums are exact (decimal(38,0)). The driver
holds the centroids, `k` rows of integers, and nothing else.

Inputs: vectors that are NULL, of another length, or with NULL, NaN or infinite components are left
out. An integer component beyond +-2^24 is an error that names the limit, as products would leave 64
bits. Rows without a vec_id are clustered like others but are no starting centroids. Rows that
repeat a vec_id are all clustered and counted; where they are starting centroids, the order of their
components settles the tie. Fewer vectors than `k` make fewer centroids; no vectors, no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.session import materialize

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
LARGEST = 1 << 24


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether the vector has as many components as asked for, all of them finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and the usable vectors as doubles."""
    doubles = F.col("embedding").cast("array<double>")
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("vector"))
    return slim.where(usable(F.col("vector"), dimensions))


def in_integers(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of integers."""
    held = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    scaled = np.floor(held * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // scale} in size")
    return scaled.astype(np.int64)


@dataclass
class Centroids:
    """Centroids by number, and their order by component sum."""

    rows: np.ndarray

    def __post_init__(self) -> None:
        sums, roots = _profile(self.rows)
        self.order = np.lexsort((np.arange(len(self.rows)), sums))
        self.sums, self.roots = sums[self.order], roots[self.order]
        self.sorted = self.rows[self.order]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, the smaller number on a
        tie, and how many distances were worked out in full."""
        n, (k, dimensions) = len(vectors), self.rows.shape
        sums, roots = _profile(vectors)
        best = np.full(n, np.iinfo(np.int64).max // dimensions)
        found = np.full(n, k)
        # The next candidates below and above in the order.
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        open_, worked = np.arange(n), 0
        while len(open_):
            below, above = low[open_], high[open_]
            down = np.where(below >= 0, sums[open_] - self.sums[np.maximum(below, 0)], np.iinfo(np.int64).max)
            up = np.where(above < k, self.sums[np.minimum(above, k - 1)] - sums[open_], np.iinfo(np.int64).max)
            gap = np.minimum(down, up)
            going = gap != np.iinfo(np.int64).max
            reach = np.minimum(gap, 1 << 31)
            going &= reach * reach <= dimensions * best[open_]
            side = down <= up
            at = np.where(side, below, above)[going]
            open_, gap, side = open_[going], gap[going], side[going]
            low[open_[side]] -= 1
            high[open_[~side]] += 1
            # Less by what the roots may be off.
            spread = np.abs(roots[open_] - self.roots[at])
            spread = np.maximum(0, spread - 1e-12 * (roots[open_] + self.roots[at]) - 1e-6)
            bound = gap.astype(np.float64) ** 2 + spread * spread
            near = bound * (1 - 1e-12) <= dimensions * best[open_].astype(np.float64)
            rows, at = open_[near], at[near]
            apart = vectors[rows] - self.sorted[at]
            distance, number = np.einsum("ij,ij->i", apart, apart), self.order[at]
            worked += len(rows)
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            best[rows[better]], found[rows[better]] = distance[better], number[better]
        return found, best, worked


def _profile(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component sums, and roots of k * (sum of squares) - sum * sum."""
    sums = rows.sum(axis=1)
    squares = np.einsum("ij,ij->i", rows, rows)
    return sums, np.sqrt((rows.shape[1] * squares - sums * sums).astype(np.float64))


def starting_centroids(
    whole: DataFrame, k: int = CLUSTERS, seed: int = SEED, scale: int = SCALE
) -> np.ndarray:
    """The vectors with the smallest SHA-256 of seed and id, `k` rows at most on the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = whole.where("vec_id IS NOT NULL").select(digest.alias("digest"), "vector")
    # Whole numbers before the limit, so that equal digests are in the order of what counts.
    first = first.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("long")))
    rows = first.orderBy("digest", "vector").limit(k).collect()
    made = np.array([r["vector"] for r in rows], np.int64)
    if made.size and np.abs(made).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // scale} in size")
    return made


def assign(whole: DataFrame, centroids: Centroids, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster and distance of every vector."""
    dimensions = centroids.rows.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, best, _ = centroids.nearest(in_integers(batch.column(1), dimensions, scale))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.astype(np.int32)), pa.array(best)],
                ["vec_id", "cluster", "distance"],
            )

    return whole.select("vec_id", "vector").mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(whole: DataFrame, centroids: Centroids, scale: int = SCALE) -> Centroids:
    """The centroids after one round: the floor of the mean of their vectors, componentwise."""
    k, dimensions = centroids.rows.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = in_integers(batch.column(1), dimensions, scale)
            found, _, _ = centroids.nearest(vectors)
            np.add.at(sums, found, vectors)
            counts += np.bincount(found, minlength=k)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    parts = whole.select("vec_id", "vector").mapInArrow(run, "cluster int, n long, total array<long>")
    places = parts.select("cluster", "n", F.posexplode("total").alias("place", "value"))
    summed = places.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    )
    rows = centroids.rows.copy()
    # One number for each cluster and component.
    for row in summed.collect():
        rows[row["cluster"], row["place"]] = int(row["value"]) // row["n"]
    return Centroids(rows)


def fit(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE,
    dimensions: int = DIMENSIONS,
) -> Centroids | None:
    """The centroids after `rounds` rounds, None where there is no vector to start from."""
    whole = whole_vectors(vectors, dimensions)
    start = starting_centroids(whole, k, seed, scale)
    if not len(start):
        return None
    centroids = Centroids(start)
    for _ in range(rounds):
        centroids = moved(whole, centroids, scale)
    return centroids


def clusters(vectors: DataFrame, centroids: Centroids | None, scale: int = SCALE, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, the distances summed over the cluster and over all, and the digest
    of the cluster's centroid."""
    schema = (
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    if centroids is None:
        return vectors.sparkSession.createDataFrame([], schema)
    assigned = materialize(assign(whole_vectors(vectors, dimensions), centroids, scale), "assigned")
    # A row for each cluster.
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    total = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.rows.tolist()]
    named = vectors.sparkSession.createDataFrame(
        [(number, sums.get(number, 0), total, digest) for number, digest in enumerate(digests)],
        "number int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    joined = assigned.join(F.broadcast(named), F.col("cluster") == F.col("number"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
